import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from helpers import DOCS, awkward_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playstats.llm.packing import TOKENIZER, _inverse, configurations, linear_groups, pack_documents, plan_packing
from playstats.llm.tokens import WordEncoder

PATH = public_tokenizers.path(TOKENIZER)


def plain_ids(tok, text):
    return np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_round_trip(spark):
    rows = awkward_docs()
    tok = Tokenizer.from_file(PATH)
    out = pack_documents(spark.createDataFrame(rows, DOCS), capacity=256).collect()
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(plain_ids(tok, r[1] or "") + b"\0\0\0\0")
    want = Counter()
    for doc, many in texts.items():
        for ids in many:
            for piece, at in enumerate(range(0, len(ids), 1024)):
                part = ids[at:at + 1024]
                want[doc, piece, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter(tuple(r)[:5] for r in out) == want
    seqs = defaultdict(list)
    for r in out:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    bound = -(-sum(r["length"] for r in out) // 256)
    assert bound <= len(seqs) <= 1.1 * bound + 1


def test_empty_table(spark):
    out = pack_documents(spark.createDataFrame([], DOCS))
    assert out.count() == 0 and "sequence_id" in out.columns


def total(plan):
    out = Counter()
    for shape, n in plan:
        for s in shape:
            out[s] += n
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40), st.integers(1, 12))
def test_plan_places_every_piece_once(counts, groups):
    plan = plan_packing(counts, 64, groups)
    assert all(sum(shape) <= 64 for shape, _ in plan)
    assert total(plan) == Counter(counts)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 2048, 30000), np.clip(rng.lognormal(6, 1, 30000).astype(int) + 1, 1, 2047),
                    rng.choice([700, 690, 650, 1300, 1350, 20], 30000)):
        counts = Counter(lengths.tolist())
        used = sum(n for _, n in plan_packing(counts, 2048))
        assert used <= 1.003 * best_fit_decreasing(lengths, 2048)


def best_fit_decreasing(lengths, capacity):
    room = Counter()
    used = 0
    for s in sorted(lengths.tolist(), reverse=True):
        r = next((r for r in range(s, capacity + 1) if room[r]), None)
        if r is None:
            used, r = used + 1, capacity
        else:
            room[r] -= 1
        room[r - s] += 1
    return used


def test_planner_ends_beside_a_running_session(spark):
    """800 groups, planned in the process that started the JVM, without thread variables and in time."""
    assert spark.range(100).selectExpr("sum(id)").first()[0] == 4950
    lengths = np.clip(np.random.default_rng(4).lognormal(6, 1, 200_000).astype(int) + 1, 1, 2047)
    counts = Counter(lengths.tolist())
    began = time.monotonic()
    plan = plan_packing(counts, 2048, 800)
    assert time.monotonic() - began < 60
    assert total(plan) == counts
    assert sum(n for _, n in plan) <= 1.003 * -(-int(lengths.sum()) // 2048)


def test_inverse_without_blas():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 4, (30, 30)) + 9.0 * np.eye(30)[::-1]      # needs row exchanges
    product = (a[:, :, None] * _inverse(a)[None, :, :]).sum(axis=1)
    assert np.abs(product - np.eye(30)).max() < 1e-9


def test_linear_groups_have_equal_cardinality():
    groups = linear_groups({s: 10 for s in range(1, 101)}, 20, 8)
    assert len(groups) == 8 and all(g == max(members) for g, members in groups)
    assert sorted(s for _, m in groups for s in m) == list(range(21, 101))


def test_configurations_reach_the_optimum_of_a_known_case():
    found = configurations([60, 40, 50], [100, 100, 100], 100)
    assert sum(m for _, m in found) == 150


def test_chunks_equal_whole_texts():
    enc, tok = WordEncoder(PATH), Tokenizer.from_file(PATH)
    odd = ["", " ", "a<|endoftext|>b c", "don't 'S we'll", "É́x ß ΑΣ Σ", "tab\tand\x0bfeed\x0c\r\n", "12 3.5 ²³ ª",
           "日本 🎉 x", "x" * 9000, "word, word. (word) [x]|", "a\x1cb\x85c\xa0d"]
    assert enc.encode(odd) == [plain_ids(tok, t) for t in odd]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_chunks_equal_whole_texts_property(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    enc, tok = _PAIR
    assert enc.encode(texts) == [plain_ids(tok, t) for t in texts]


_PAIR = (WordEncoder(PATH), Tokenizer.from_file(PATH))


def test_full_tables_are_emptied(monkeypatch):
    from playstats.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    enc, tok = WordEncoder(PATH), Tokenizer.from_file(PATH)
    texts = [f"alpha beta gamma{i} delta, epsilon{i}. 1{i}" for i in range(30)]
    for at in range(0, 30, 3):
        part = texts[at:at + 3] + texts[:2]
        assert enc.encode(part) == [plain_ids(tok, t) for t in part]
