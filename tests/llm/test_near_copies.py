"""Near copies against brute force: pairs at 0.8 to 0.95 that differ in more than four bits."""

import itertools

import numpy as np
import pytest

import corpus_pipeline
from rowgraft.llm import near_copies


def _set(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _components(texts, least=0.8):
    sets, root = {i: _set(t or "") for i, t in texts.items()}, {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        both, all_ = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if (not all_ or both / all_ >= least) and root[a] != root[b]:
            x, y = sorted((root[a], root[b]))
            root = {i: x if r == y else r for i, r in root.items()}
    return root


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    out = {}
    for base in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        out[base * 10] = " ".join(words)
        for copy in range(1, 8):  # 2 to 14 words changed: similarities from 0.95 down past 0.8
            changed = list(words)
            for at in rng.choice(300, 2 * copy, replace=False):
                changed[at] = f"x{rng.integers(0, 5000)}"
            out[base * 10 + copy] = " ".join(changed)
    return out | {900: None, 901: "", 902: "two words", 903: "Two  WORDS", 904: out[0].upper()}


@pytest.mark.parametrize("block", [near_copies.BLOCK, 1000])
def test_near_copies(spark, texts, block, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    want = _components(texts)
    assert len(set(want.values())) < len(want) - 12
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).cache()
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want
    assert near_copies.near_copies(docs.where("1 = 0")).count() == 0


def test_the_stage_keeps_one_of_each(spark, sf, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3, "doc_id").cache()
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    assert kept == set(_components(texts).values())


def test_the_stage_clusters_by_fingerprints(spark, sf, texts, monkeypatch):
    """Every two texts whose fingerprints differ in few bits are in one cluster, and the stage asks for them."""
    seen, told = [], near_copies.clusters
    monkeypatch.setattr(near_copies, "clusters", lambda distinct: seen.append(told(distinct).collect()) or told(distinct))
    near = {i: t for i, t in texts.items() if i % 10 < 3}
    docs = spark.createDataFrame(list(near.items()), "doc_id long, text string").coalesce(1).cache()
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()}
    assert kept == set(_components(near).values())
    sets = {near_copies._node(s): near_copies.majority(s) for s in (near_copies.shingles((t or "").encode()) for t in near.values()) if len(s)}
    root = {n: n for n in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if (sets[a] ^ sets[b]).bit_count() <= near_copies.RADIUS and root[a] != root[b]:
            x, y = root[a], root[b]
            root = {n: x if r == y else r for n, r in root.items()}
    groups = {frozenset(n for n in root if root[n] == r) for r in root.values()}
    found = {}
    for r in seen[0]:
        found.setdefault(r.key, set()).add(r.fp)
    assert {frozenset(g) for g in found.values()} == {g for g in groups if len(g) > 1} != set()
