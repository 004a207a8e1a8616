"""Packed sequences against the tokenizer itself, and the plan against small bounds."""

import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import rowgraft.llm.queries as llm
from rowgraft.llm import cutting_stock, packing
from rowgraft.llm.common import documents

TEXTS = [
    (1, "Hello there, it's 2024's best  text.\n\n\tIndented <|endoftext|> and more "), (2, None), (3, ""), (3, ""), (None, "naïve café 中文 😀 " * 40), (5, " lead and trail  "),
    (6, "w" * 30000), (7, "one two three " * 3000), (8, "  odd\u0085blanks\x1c here　"), *[(100 + i, "the same words again " * 220) for i in range(60)], *[(200 + i, "short " * (i % 37 + 1)) for i in range(300)],
]


def _check(docs, pieces, size):
    """Padding as a share of the tokens; every id lies in one piece, in order."""
    reference = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    want = collections.Counter()
    for i, text in docs:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 1]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()) if len(ids) <= 20 else 0)] += 1
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for (i, n, _), times in want.items():
        ids = [*reference.encode(next(t for d, t in docs if d == i) or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[i], key=lambda r: (r.start, r.length))
        assert sum(r.length for r in own) == n * times and {r.doc_tokens for r in own} == {n}
        assert collections.Counter(x for r in own for x in range(r.start, r.start + r.length)) == dict.fromkeys(range(n), times)
        assert all(r.length > 0 and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own)
    padding = total = 0
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
        total += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / total


@pytest.mark.parametrize("size", [2048, 256])
def test_packed(spark, size):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in TEXTS], "doc_id long, text string, rid string, length int").repartition(3, "text").cache()
    pieces = packing.packed(docs, size=size)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert _check(TEXTS, pieces.collect(), size) < 0.02
    assert packing.packed(docs.where("1 = 0")).count() == 0


def test_sequences(spark):
    own = [(i, t) for i, t in dict(TEXTS).items() if i is not None]
    docs = spark.createDataFrame(own, "doc_id long, text string").repartition(2, "doc_id").cache()
    pieces = packing.packed(docs).cache()
    found = {r.sequence_id: r.ids for r in packing.sequences(docs, pieces, pad=9).collect()}
    reference = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    ids = {i: [*reference.encode(t or "", add_special_tokens=False).ids, 1] for i, t in own}
    held = collections.Counter()
    for r in pieces.collect():
        assert found[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]
        held[r.sequence_id] += r.length
    assert all(len(found[s]) == (n if n & (n - 1) == 0 else 2048) and set(found[s][n:]) <= {9} for s, n in held.items())


def test_the_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    assert _check(rows, llm.QUERIES["op13_packing"](spark, sf).collect(), 2048) < 0.01


def test_knapsack():
    rng = np.random.default_rng(4)
    size = np.array([3, 5, 7, 11])
    for _ in range(20):
        value = rng.random(4)
        best, counts = cutting_stock.best_pattern(value, size, 23)
        every = max(sum(n * v for n, v in zip(k, value)) for k in np.ndindex(8, 5, 4, 3) if np.dot(k, size) <= 23)
        assert abs(best - every) < 1e-9 and abs(counts @ value - best) < 1e-9 and counts @ size <= 23


def test_plan():
    # Lengths 6 and 4 fill 10 together, 3 + 3 + 4 as well.
    plan = cutting_stock.patterns(np.arange(11), np.bincount([6, 4, 3], [100, 150, 100], minlength=11).astype(int), 10, 0.99)
    used = collections.Counter()
    for p in plan:
        assert sum(c * n for c, n in p.counts.items()) == 10
        used.update({c: n * p.times for c, n in p.counts.items()})
    assert sum(p.times for p in plan) >= 148 and used[6] <= 100 and used[4] <= 150 and used[3] <= 100
    # Where nothing fits, nothing is planned, and the rest is cut.
    assert cutting_stock.patterns(np.arange(11), np.bincount([7], [50], minlength=11).astype(int), 10, 0.99) == []
    assert cutting_stock.patterns(np.arange(11), np.zeros(11, int), 10, 0.99) == []
