"""Passages of over 50 words that occur again, however few bytes they have."""

import collections
import re

import numpy as np
import pytest

import corpus_pipeline
from rowgraft.llm import repeats
from rowgraft.llm.common import numbered


def _cut(rows, words=51, length=400):
    """What stays of the texts, window by window."""
    places = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for t in rows]
    split = [t.split() for t in rows]
    passages = collections.Counter(tuple(w[k : k + words]) for w in split for k in range(len(w) - words + 1))
    strings = collections.Counter(t[p : p + length] for t in rows for p in range(len(t) - length + 1))
    for t, w, at in zip(rows, split, places):
        gone = bytearray(len(t))
        for k in range(len(w) - words + 1):
            if passages[tuple(w[k : k + words])] > 1:
                a, b = at[k][0], at[k + words - 1][1]
                gone[a:b] = b"\1" * (b - a)
        for p in range(len(t) - length + 1):
            x = t[p : p + length]
            if strings[x] > 1 and len(re.findall(rb"(?<=[ \t-\r])[^ \t-\r]+(?=[ \t-\r])", x)) < words:
                gone[p : p + length] = b"\1" * length
        yield bytes(x for x, g in zip(t, gone) if not g)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(9)

    def some(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))

    short = " ".join(f"w{x}" for x in rng.integers(0, 100, 51))  # 51 words, under 200 bytes
    fifty = some(50)
    solid = "".join(chr(0x4E00 + x) for x in rng.integers(0, 5000, 200))  # 600 bytes without a blank
    return [
        some(30) + " " + short + " " + some(70), some(5) + "\n" + short.replace(" ", "\n"), some(9) + " " + fifty + " a " + some(9), some(80) + " " + fifty + " b",
        "x" + solid + "y " + some(60), some(60) + " z" + solid, "the " * 300, some(3) + " the" * 52, "a " * 51, "", None, some(200),
    ]


def test_passages(spark, texts):
    assert 51 <= len(texts[1].split()) < 60 and len(texts[1]) < 400
    own = numbered(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2).cache())
    rows = [(r.rid, (r.text or "").encode()) for r in own.collect()]
    want = dict(zip([i for i, _ in rows], _cut([t for _, t in rows])))
    assert sum(map(len, want.values())) < sum(len(t) for _, t in rows) - 2000
    assert {r.rid: bytes(r.kept) for r in repeats.without_repeats(own, words=51).collect()} == want


def test_the_stage_cuts_a_short_passage(spark, sf, texts):
    docs = spark.createDataFrame([(i, t, 0 if t is None else len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int").repartition(2, "doc_id").cache()
    out = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, docs, sf).collect()}
    want = list(_cut([(t or "").encode() for t in texts]))
    assert {i: r.text or "" for i, r in out.items()} == {i: t.decode("utf-8", "ignore") for i, t in enumerate(want)}
    assert out[0].n_chars == len(out[0].text) == len(texts[0]) - len(" ".join(texts[1].split()[5:]))


def test_shared_words(spark):
    rng = np.random.default_rng(8)
    short, long = (" ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) for n in (51, 300))
    fresh = lambda n: " ".join(f"x{x}" for x in rng.integers(0, 10**9, n))
    texts = [fresh(90), f"{fresh(30)} {short} {fresh(40)}", f"{fresh(7)}\n{short}", f"{long} {fresh(80)}", f"{fresh(9)} {long}", short[:150], None, ""]
    own = numbered(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    got = {r.rid: r.shared_words for r in repeats.shared_words(own).collect()}
    order = [r.rid for r in own.select("rid").collect()]
    assert set(got) == {order[k] for k in (1, 2, 3, 4)}
    assert got[order[1]] == got[order[2]] and 16 <= got[order[1]] <= 51 and 210 <= got[order[3]] == got[order[4]] <= 300


def test_word_grams_are_those_of_every_window():
    rng = np.random.default_rng(9)
    text = b" ".join(b"%d" % x for x in rng.integers(0, 40, 700))
    at, g = repeats.word_grams(text, 20, 8)
    assert all(any(p <= a <= p + 12 for a in at.tolist()) for p in range(700 - 20 + 1)) and len(set(g.tolist())) > 10


def test_rows_of_a_heavy_key_are_not_dealt_by_it_alone(spark):
    rows = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(3000)], "g long, c long").coalesce(2)
    keys = rows.groupBy("g").count().withColumnRenamed("count", "n").where("n > 1")
    found = repeats._matching(rows, keys, ["g"], 100)
    assert {(r.g, r.c) for r in found.collect()} == {(1, i) for i in range(3000) if i % 3}
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert any("salt" in d for d in dealt) and not re.search(r"SortMergeJoin \[g#\d+L?\], \[g#", plan)


def test_kept_as_text_drops_parts_of_characters(spark):
    """Two texts that share 400 bytes from inside a character on."""
    shared = "é" * 300
    rows = [(1, "ũ" + shared[1:] + "x"), (2, "©" + shared[1:] + "y")]
    docs = spark.createDataFrame(rows, "rid long, text string")
    as_bytes = {r.rid: bytes(r.kept) for r in repeats.without_repeats(docs).collect()}
    found = repeats.without_repeats(docs, as_text=True)
    assert dict(found.dtypes)["kept"] == "string"
    assert {r.rid: r.kept for r in found.collect()} == {i: b.decode("utf-8", "ignore") for i, b in as_bytes.items()}
    assert any(b.decode("utf-8", "replace") != b.decode("utf-8", "ignore") for b in as_bytes.values())
