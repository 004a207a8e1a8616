"""The PPM operator's work on a block, without Spark."""

import collections
import time

import numpy as np
import pyarrow as pa
import pytest

from rowgraft.llm import ppm

BUCKETS = 64


def block_of(texts, learned=True):
    n = len(texts)
    return pa.table({"rid": pa.array(range(n), pa.int64()), "block": pa.array([0] * n, pa.int64()), "text": texts, "learned": [learned] * n})


def asked_of(docs, rows):
    return pa.Table.from_batches(ppm._asked(iter(docs.to_batches(max_chunksize=rows)), BUCKETS)).to_pylist()


def answers_of(asked):
    """A block's answers: to each string its last byte, to each word its count."""
    block, bucket, kind, found = [], [], [], []
    for r in asked:
        if r["kind"] in (ppm.GRAMS, ppm.WORDS):
            grams = r["kind"] == ppm.GRAMS
            block.append(0), bucket.append(r["bucket"]), kind.append(r["kind"])
            found.append((ppm._keys([r["grams"]])[0] & np.uint64(0xFF)).astype(np.float32).tobytes() if grams else r["n"])
    return pa.table({"block": block, "bucket": bucket, "kind": kind, "found": pa.array(found, pa.binary())})


def test_a_block_in_many_batches_is_scored_at_the_cost_of_one():
    rng = np.random.default_rng(3)
    docs = block_of([" ".join(f"w{x:x}" for x in rng.integers(0, 1 << 40, 60)) for _ in range(4000)])
    answers = answers_of(asked_of(docs, 4000))
    took, scored = {}, {}
    for rows in (4000, 5):
        cut = pa.Table.from_batches(docs.drop_columns(["learned"]).to_batches(max_chunksize=rows))
        start = time.process_time()
        scored[rows] = ppm._score(cut, answers, BUCKETS).to_pydict()
        took[rows] = time.process_time() - start
    assert scored[4000] == scored[5] and len(scored[5]["rid"]) == 4000
    assert scored[5]["n_words"] == [60] * 4000 == scored[5]["n_known"]
    laid = ppm.tokens_text(docs["text"][7].as_py().encode())
    assert scored[5]["score"][7] == sum(laid[ppm.ORDER :])
    # Looking up all words of the block for each of the 800 batches took many times as long.
    assert took[5] < 4 * took[4000]


@pytest.mark.parametrize("rows", [1, 10])
def test_counts_of_a_block_also_beyond_what_a_key_holds(rows):
    texts = ["a" * 200_000, "B" * 70_000 + " x", "a" * 65_540, "", None, "\x00\x00\x00\xff".encode("latin-1").decode("latin-1") * 3, "a  b\tC\n"]
    want, words = collections.Counter(), collections.Counter()
    for t in texts:
        own = (t or "").encode()
        words.update(own.lower().split())
        s = ppm.tokens_text(own)
        want.update(int.from_bytes(s[p - ppm.ORDER : p + 1], "big") for p in range(ppm.ORDER, len(s)))
    assert want[int.from_bytes(b"aaaaaa", "big")] > 4 * 65_535
    for learned in (True, False):
        got, found, pairs = {}, {}, collections.Counter()
        for r in asked_of(block_of(texts, learned), rows):
            if r["kind"] == ppm.GRAMS:
                keys = ppm._keys([r["grams"]])[0]
                assert (ppm._bucket(keys, BUCKETS) == r["bucket"]).all()
                got.update(zip(keys.tolist(), np.frombuffer(r["n"], np.uint32).tolist()))
            elif r["kind"] == ppm.WORDS:
                found.update(zip(r["words"], np.frombuffer(r["n"], np.uint32).tolist()))
            else:
                pairs[r["bucket"]] += r["total"]
        assert got == {g: n * learned for g, n in want.items()}
        assert found == {w: n * learned for w, n in words.items()}
        assert sum(pairs.values()) == learned * sum(want.values())


def test_a_block_of_blank_texts():
    docs = block_of([None, "", " \n\t"])
    scored = ppm._score(docs.drop_columns(["learned"]), answers_of(asked_of(docs, 2)), BUCKETS)
    assert scored.schema.field("words_log").type == pa.float64()
    assert scored.to_pydict() == {"rid": [0, 1, 2], "n_words": [0] * 3, "n_known": [0] * 3, "words_log": [0.0] * 3, "score": [float(ppm.END[0])] * 3}
