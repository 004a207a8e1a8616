"""The pipeline against plain Python: what each stage must keep, drop and cut."""

import re

import corpus_pipeline
from rowgraft.llm import pieces
from rowgraft.llm.common import documents, table
from tests_llm_helpers import components, repeated_passages


def _windows(text, size=10):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set(), w


def test_stages_one_by_one(spark, sf):
    """Each stage on all its predecessor kept."""
    docs = documents(spark, sf)
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    language, near, cut, leaks, encode = (stages[name] for name, _ in corpus_pipeline.STAGES)

    told = language(spark, docs, sf).cache()
    kept = {r.doc_id: r for r in told.collect()}
    assert told.columns == columns and all(kept[i] == before[i] for i in kept)
    assert len(kept) >= 0.98 * sum(any(map(str.isalpha, r.text or "")) for r in before.values())
    assert all(any(map(str.isalpha, r.text)) for r in kept.values())

    single = near(spark, told, sf).cache()
    left = {r.doc_id: r for r in single.collect()}
    root = components({i: r.text for i, r in kept.items()})
    assert set(left) == set(root.values()) and all(left[i] == kept[i] for i in left)

    shorn = cut(spark, single, sf).cache()
    after = {r.doc_id: r for r in shorn.collect()}
    assert set(after) == set(left)
    held = repeated_passages({i: r.text for i, r in left.items()}, 51)
    assert held and all(after[i].n_chars == len(after[i].text) < len(left[i].text) for i in held)
    assert not repeated_passages({i: r.text for i, r in after.items()}, 51, within=held)
    assert sum(after[i].text == left[i].text for i in left if i not in held) >= 0.95 * sum(i not in held for i in left)

    clean = leaks(spark, shorn, sf).cache()
    stay = {r.doc_id for r in clean.collect()}
    items = [_windows(r.text) for r in table(spark, sf, "benchmark").collect()]
    whole = set().union(*[w for w, words in items if len(words) >= 10])
    short = [tuple(words) for w, words in items if 0 < len(words) < 10]
    hit = set()
    for i, r in after.items():
        found, words = _windows(r.text)
        if found & whole or any(words[k : k + len(s)] == list(s) for s in short for k in range(len(words) - len(s) + 1)):
            hit.add(i)
    assert stay == set(after) - hit and hit

    out = encode(spark, clean, sf).cache()
    assert out.columns == [*columns, "pieces"] and {r.doc_id for r in out.collect()} == stay
    assert all(bytes(r.decoded).decode() == r.text for r in pieces.decoded(out).collect())


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*documents(spark, sf).columns, "pieces"] and len(corpus_pipeline.STAGES) == 5 and out.count() > 0


def test_stages_on_an_empty_table(spark, sf):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, sf).where("1 = 0"), sf).count() == 0
