"""Fill-in-middle transformation over a Fenwick tree of text blocks.

A text is cut at two unit boundaries (units: a run of A-Z a-z, or one other code point) into prefix,
middle and suffix, and written with markers so that a model learns to fill the middle:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text itself

*Index.* The text is read once in fixed blocks of ``BLOCK`` code points. A Fenwick tree (binary
indexed tree) holds for each block the units that begin in it and its code points, so no list of
units is kept: a text of any length costs two counts a block. *Cut.* The block of a cut is found by
binary-lifting descent from the highest power of two, adding nodes while their units stay within
the cut; the boundary is then located inside that one block.

Cuts and forms follow from the id alone (sha256 of ``1:`` and the decimal id), so reruns agree.

Defined results. A null or empty text is the empty text: no units, form ``plain``. A text that
holds a marker is ``plain``, since the markers could not be told from it. A null id counts as the
empty string after ``1:``. Rows that repeat an id are transformed each by itself, with equal cuts if
their texts are equal. Very long texts are handled as a whole; memory beyond the text itself is
one block and two counts a block. Other columns of the input are not read, so their names cannot
clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import small_batches

BLOCK = 4096
P, S, M = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20      # of 100


class BlockIndex:
    """Fenwick tree over the blocks of a text: units that begin in a block, and its code points."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        self.size = max(1, -(-len(text) // block))
        self.units = [0] * (self.size + 1)
        self.points = [0] * (self.size + 1)
        after_letter = False
        for b in range(self.size):
            starts, after_letter = self._starts(b, after_letter)
            self.units[b + 1], self.points[b + 1] = int(starts.sum()), len(starts)
        for i in range(1, self.size + 1):       # build in place: each node passes its sum to its parent
            up = i + (i & -i)
            if up <= self.size:
                self.units[up] += self.units[i]
                self.points[up] += self.points[i]

    def _starts(self, b: int, after_letter: bool) -> tuple[np.ndarray, bool]:
        """Which code points of block ``b`` begin a unit; whether the block ends with a letter."""
        part = self.text[b * self.block:(b + 1) * self.block]
        code = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        low = code | 32
        letter = (low >= 97) & (low <= 122)
        starts = np.ones(len(code), bool)
        starts[1:] = ~(letter[1:] & letter[:-1])
        if len(code):
            starts[0] = not (after_letter and letter[0])
        return starts, bool(len(code) and letter[-1])

    def total(self) -> int:
        """Units of the whole text: the sum over the prefix of all blocks."""
        n, i = 0, self.size
        while i:
            n += self.units[i]
            i -= i & -i
        return n

    def locate(self, cut: int) -> int:
        """The code point at which unit number ``cut`` (from 0) begins; the text's end beyond the last."""
        at, units, points = 0, 0, 0
        step = 1 << (self.size.bit_length() - 1)
        while step:
            node = at + step
            if node <= self.size and units + self.units[node] <= cut:
                at, units, points = node, units + self.units[node], points + self.points[node]
            step >>= 1
        if at == self.size:
            return points
        before = self.text[points - 1:points]
        starts, _ = self._starts(at, before.isascii() and before.isalpha())
        return points + int(np.flatnonzero(starts)[cut - units])


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """The four unsigned 32-bit numbers of an id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * i:8 * i + 8], 16) for i in range(4))


def transform(text: str, doc_id: int | None, block: int = BLOCK) -> tuple[int, str, tuple[str, str, str] | None]:
    """(units, form, (prefix, middle, suffix) or None for ``plain``)."""
    h1, h2, h3, h4 = draws(doc_id)
    index = BlockIndex(text, block)
    n = index.total()
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in (P, S, M)):
        return n, "plain", None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = index.locate(a), index.locate(b)
    return n, "spm" if h4 % 100 < SPM_BELOW else "psm", (text[:i], text[i:j], text[j:])


def write(form: str, parts: tuple[str, str, str]) -> str:
    prefix, middle, suffix = parts
    return f"{P}{prefix}{S}{suffix}{M}{middle}" if form == "psm" else f"{S}{suffix}{P}{prefix}{M}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row; one pass, no shuffle."""

    def make(batches):
        for batch in small_batches(batches):
            out = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                n, form, parts = transform(text, doc_id, block)
                row = (n, form, None, None, text) if parts is None else \
                    (n, form, len(parts[0]), len(parts[1]), write(form, parts))
                for col, v in zip(out, row):
                    col.append(v)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(make, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(made: DataFrame) -> DataFrame:
    """``made`` plus ``restored``: the text, rebuilt from ``output`` and ``form`` alone.

    A marker holds brackets at its ends only and none is in the text, so none can arise where text
    and marker meet: the first of each kind is the written one.
    """
    out, psm = F.col("output"), F.col("form") == "psm"
    third = F.instr(out, F.lit(M))
    second = F.when(psm, F.instr(out, F.lit(S))).otherwise(F.instr(out, F.lit(P)))
    width = F.lit(len(P))
    one = F.substr(out, width + 1, second - width - 1)
    two = F.substr(out, second + width, third - second - width)
    middle = F.substr(out, third + width)
    return made.withColumn("restored", F.when(F.col("form") == "plain", out)
                           .when(psm, F.concat(one, middle, two)).otherwise(F.concat(two, middle, one)))
