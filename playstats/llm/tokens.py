"""Token ids of whole texts by the public lower-case word BPE file, inside tasks.

The tokenizer normalises (NFC, white space, lower case), cuts a text into words and encodes each
word by itself. For texts of ASCII and composed Latin letters, whose normal form is plain
lower-casing, the words are cut here by the same pattern, and each worker keeps a bounded table of
their ids; only words it has not met go to the tokenizer, many as one text, whose word-final ids
mark where each ends. Chunks with any other character go to the tokenizer by themselves.
"""

from __future__ import annotations

import os
import re

import numpy as np

CACHE_WORDS = 800_000      # words kept a worker; the table is emptied beyond it
WORD_CHARS = 64            # longer words are encoded but not kept

# fixed values: the characters that need no normal form, and the tokenizer's word pattern on them
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\\[-`{-~]+").findall
_SPACE = re.compile("[ \n]+")
_RAW = "\0"                # marks a chunk that is no word of the pattern
_LOADED: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Little-endian unsigned 32-bit ids of texts, as bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # one task, one core
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        vocab = self._tok.get_vocab()
        self._special = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._final = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self._final[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._words: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self._tok.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        out = {w: self._ids(w[1:]).tobytes() for w in words if w[0] == _RAW}
        new = [w for w in words if w[0] != _RAW]
        if new:
            ids = self._ids(" ".join(new))
            ends = (np.nonzero(self._final[ids])[0] + 1).tolist()
            if len(ends) == len(new):
                raw, at = ids.tobytes(), 0
                for w, end in zip(new, ends):
                    out[w] = raw[at:4 * end]
                    at = 4 * end
            else:
                out.update((w, self._ids(w).tobytes()) for w in new)
        return out

    def _cut(self, text: str) -> list[str]:
        if not any(s in text for s in self._special):
            if _PLAIN.fullmatch(text):
                return _CUT(text.lower())
            return [w for c in _SPACE.split(text) if c
                    for w in (_CUT(c.lower()) if _PLAIN.fullmatch(c) else (_RAW + c,))]
        return [_RAW + text]

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [self._cut(t) for t in texts]
        known = self._words
        every = set().union(*words)
        new = every.difference(known)
        if new:
            learnt = self._learn(new)
            if len(known) + len(learnt) > CACHE_WORDS:
                learnt.update((w, known[w]) for w in every if w in known)   # for this batch
                known = self._words = {}
            known.update((w, b) for w, b in learnt.items() if len(w) <= WORD_CHARS)
            if len(known) < len(learnt) or any(len(w) > WORD_CHARS for w in learnt):
                known = {w: learnt[w] if w in learnt else known[w] for w in every}
        get = known.__getitem__
        return [b"".join(map(get, ws)) for ws in words]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]
