"""Operators against brute force, with nulls, empty and long texts, ties, copies and odd columns."""

import collections
import hashlib
import math
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgraft.llm import decontamination, language_id, licenses, line_dedup, pieces, ppm, repeats, sharding, simhash, top_k
from rowgraft.llm.common import crc_of, documents, numbered

PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark forest of old oaks " * 6
TEXTS = [
    (1, "One two three four five six.\nShort line.\n" + PASSAGE), (2, "ONE  two three four five six.\nelse\n" + PASSAGE + "é tail"),
    (3, None), (4, ""), (4, ""), (None, "Released under the MIT License."), (7, "word " * 4000), (8, "word " * 4000),
    (9, "a" * 900), (10, "Ein ganz kurzer Text über nichts"), (11, "123 456"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 0, "en") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, shard int, lang string").repartition(2, "doc_id").cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("1 = 0")


def test_units(spark, docs, none):
    found = {(r.doc_id, r.n_units): r for r in line_dedup.repeated_units(docs).collect()}
    spans = {k: [tuple(s) for s in r.spans] for k, r in found.items()}
    assert spans[(2, 3)] == [(0, 29)] and found[(2, 3)].passage_words == 6
    assert spans[(8, 1)] == [(0, 20000)] and spans[(7, 1)] == [] and found[(7, 1)].passage_words == 4000 and spans[(1, 3)] == []
    assert line_dedup.repeated_units(none).count() == 0
    short = [(1, "Yes. No one said so!  Yes."), (2, "no one said so! Then\nyes.\n\n好。是的。"), (3, "是的。"), (None, "Then"), (3, "x\nyes."), (4, None)]
    frame = spark.createDataFrame(short, "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.n_units): ([tuple(s) for s in r.spans], r.passage_words) for r in line_dedup.repeated_units(frame).collect()}
    assert got == {(1, 3): ([(22, 26)], 6), (2, 5): ([(0, 16), (21, 25)], 6), (3, 1): ([(0, 3)], 1), (None, 1): ([(0, 4)], 1), (3, 2): ([(2, 6)], 1), (4, 0): ([], 0)}
    cut = line_dedup.repeated_units(frame).join(frame.where("doc_id = 2"), "doc_id").select(line_dedup.without_spans("text", "spans")).first()[0]
    assert cut == "Then\n\n好。是的。"


def test_licenses(spark, docs, none):
    found = licenses.license_matches(docs, licenses.known_licenses(spark))
    assert found.columns == [*docs.columns, "digest_", "license_id"]
    assert [r.license_id for r in found.where("license_id is not null").collect()] == ["MIT line"]
    odd = "Copyright (c) 2020 Someone\n\n" + licenses.KNOWN["MIT"].upper().replace("SUBLICENSE", "sublicence").replace(",", " ")
    one = licenses.license_matches(spark.createDataFrame([(odd,)], "text string"), licenses.known_licenses(spark)).first()
    assert one.license_id == "MIT"
    assert licenses.license_matches(none, licenses.known_licenses(spark)).count() == 0


def test_licenses_however_wrapped(spark):
    """Every width, title and list mark; a copyright line of any usual form above."""
    heads = ["Copyright (c) 2020 Someone", "Copyright 2019-2021, Some One <a@b.c>\nAll rights reserved.", "(c) 2001 X", "© 2020 Y", "Copyright [yyyy] [name]"]
    rows = []
    for license_id, text in licenses.variants():
        if "line" in license_id or "notice" in license_id:
            continue
        for width in range(50, 101):
            body = "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))
            rows.append((license_id, f"{heads[width % len(heads)]}\n\n{body}"))
    frame = spark.createDataFrame(rows, "want string, text string")
    found = licenses.license_matches(frame, licenses.known_licenses(spark)).where("not license_id <=> want")
    assert found.count() == 0 and len(rows) > 1500
    assert licenses.license_matches(spark.createDataFrame([("Copyright notice kept.",)], "text string"), licenses.known_licenses(spark)).first().license_id is None


def test_licenses_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("Own Licence\n\nCopyright 2020 Me\n\nYou may.\n(c) You must not.\n")
    found = licenses.license_matches(spark.createDataFrame([("own LICENSE\ncopyright (c) 1999 You\nyou may. (C) you must\nnot",)], "text string"), licenses.known_licenses(spark, str(tmp_path)))
    assert found.first().license_id == "Own-1.0"


def test_shards(spark, docs, none):
    rows = [(i % 50 if i % 3 else 7, 100 + i % 7) for i in range(3000)]  # a third of the rows are equal in key
    df = spark.createDataFrame(rows, "k long, size long")
    out = sharding.histogram_shards(df, F.col("k"), F.col("k"), F.col("size"), 24).collect()
    weight, slots = collections.Counter(), collections.defaultdict(list)
    for r in out:
        weight[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(s for _, s in rows) / 24
    assert len(out) == 3000 and len(weight) == 24 and all(abs(w - mean) <= 110 for w in weight.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    named = sharding.histogram_shards(docs, F.col("text"), F.col("doc_id"), F.lit(8), 3)
    assert named.columns == [*docs.columns, "shard_", "slot"] and named.count() == len(TEXTS)
    assert sharding.histogram_shards(none, F.col("text"), F.col("doc_id"), F.lit(8), 3).count() == 0


def _simhash(text):
    import xxhash

    w = text.encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, sf, docs, none):
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf).collect()}
    fp = {i: _simhash(t) for i, t in texts.items()}
    root = {i: i for i in fp}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fp)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(documents(spark, sf)).collect()}
    assert got == {i: (fp[i], top(i)) for i in ids}
    small = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert small.count((4, 3)) == 2 and (3, 3) in small and (8, 7) in small and simhash.near_duplicates(none).count() == 0


def test_simhash_blocks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 30, dtype=np.uint64)
    fps = np.concatenate([base] + [base ^ np.uint64((1 << k) - 1) for k in range(1, 7)])
    i, j = simhash._links_of(fps, np.zeros(len(fps), int), np.full(len(fps), 2), 4)
    want = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if int(fps[a] ^ fps[b]).bit_count() <= 4}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(links).collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def _cut(rows, length=400):
    c = collections.Counter(t[p : p + length] for t in rows for p in range(len(t) - length + 1))
    for t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if c[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        yield bytes(x for x, g in zip(t, gone) if not g)


def test_repeats(docs, none):
    own = numbered(docs)
    got = {r.rid: bytes(r.kept) for r in repeats.without_repeats(own).collect()}
    rows = [(r.rid, (r.text or "").encode()) for r in own.collect()]
    assert got == dict(zip([i for i, _ in rows], _cut([t for _, t in rows])))
    assert repeats.without_repeats(numbered(none)).count() == 0


def test_contamination(spark, docs, none):
    items = spark.createDataFrame([(5, "Quick brown FOX jumps over the lazy dog and runs far"), (6, "ganz kurzer"), (7, None), (8, ""), (9, "kurzer ganz")], "item_id long, text string")
    found = {r.doc_id: r for r in decontamination.contamination(docs, items).collect()}
    assert found[1]["items"] == [5] and found[1].n_hit == 6 * 11 and found[10]["items"] == [6] and found[10].n_hit == 2
    assert found[3].n_words == 0 and found[11].n_hit == 0 and found[11]["items"] == []
    near = {r.doc_id: r["items"] for r in decontamination.contamination(docs, items, slop=2).collect()}
    assert near[10] == [6, 9]
    assert decontamination.contamination(none, items).count() == 0
    assert all(r.n_hit == 0 for r in decontamination.contamination(docs, items.where("1 = 0")).collect())


def test_ppm(docs, none):
    learned = crc_of("doc_id") % 5 != 1
    got = {(r.doc_id, r.n_tokens): r for r in ppm.lm_scores(docs, learned).collect()}
    c, ctx = collections.Counter(), collections.defaultdict(collections.Counter)
    for i, t in TEXTS:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1:
            c.update([*(t or "").encode().lower().split(), b"\n"])
            s = ppm.tokens_text((t or "").encode())
            for p in range(5, len(s)):
                for k in range(6):
                    ctx[s[p - k : p]][s[p]] += 1
    n, v = sum(c.values()), len(c)

    def log_p(before, symbol):
        out, total = set(), 0.0
        for k in range(5, -1, -1):
            left = {x: m for x, m in ctx.get(before[5 - k :], {}).items() if x not in out}
            if left:
                if symbol in left:
                    return total + math.log10((left[symbol] - 0.5) / sum(left.values()))
                total += math.log10(0.5 * len(left) / sum(left.values()))
                out |= set(left)
        return total - math.log10(256 - len(out))

    for i, t in TEXTS:
        words = [*(t or "").encode().lower().split(), b"\n"]
        r, s = got[(i, len(words))], ppm.tokens_text((t or "").encode())
        assert (r.train_tokens, r.n_known) == (n, sum(w in c for w in words))
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel_tol=1e-9)
        assert math.isclose(r.score, sum(log_p(s[p - 5 : p], s[p]) for p in range(5, len(s))), rel_tol=1e-5, abs_tol=1e-4)
    assert ppm.lm_scores(none, learned).count() == 0
    assert all(r.train_tokens == 0 for r in ppm.lm_scores(docs, F.lit(False)).collect())


def test_language(spark, sf, docs, none):
    own = documents(spark, sf)
    held = crc_of("doc_id") % 4 == 2
    told = language_id.with_language(own.where(held), language_id.learn(own.where(~held)))
    rows = told.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    learned = language_id.learn(own)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in language_id.with_language(docs, learned).collect()}
    assert odd[3] == odd[11] == ("und", 0) and odd[10][0] == "de" and language_id.with_language(none, learned).count() == 0
    assert {r.lang_pred for r in language_id.with_language(docs, language_id.learn(none)).collect()} == {"und"}


def test_lattice_sums_all_segmentations():
    from rowgraft.llm.lattice import Lattice, Segments, load_vocabulary, zipf

    v = load_vocabulary()
    weight, cut = zipf(v), Segments([b"the then " + b"x" * 40])
    lattice = Lattice(v, cut.distinct)
    ahead, behind = lattice.forward(weight[None])[0], lattice.backward(weight[None])[0]
    for s, text in enumerate(cut.distinct.to_pylist()):
        total = [1.0, *[0.0] * len(text)]
        for e in range(1, len(text) + 1):
            for k in range(max(0, e - v.longest), e):
                ids = [i for i, p in enumerate(v.bytes_of) if p == text[k:e] and not (len(p) == 1 and i in v.byte_id)]
                total[e] += sum(total[k] * math.exp(weight[i]) for i in ids[:1])
        assert math.isclose(ahead[lattice.last[s]], math.log(total[-1]), rel_tol=1e-9)
        assert math.isclose(behind[lattice.base[s]], ahead[lattice.last[s]], rel_tol=1e-9)


def test_pieces(docs, none):
    got = pieces.decoded(pieces.encoded(docs)).select("doc_id", "text", "pieces", "decoded").collect()
    assert all((None if r.text is None else r.text.encode()) == (None if r.decoded is None else bytes(r.decoded)) for r in got)
    again = {(r.doc_id, r.text): r.pieces for r in pieces.encoded(docs.repartition(3)).collect()}
    assert all(again[(r.doc_id, r.text)] == r.pieces for r in got)
    by_id = {r.doc_id: r.pieces for r in got}
    assert by_id[3] is None and by_id[4] == [] and by_id[7] != by_id[8] and pieces.encoded(none).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(700, 8)).round(2)
    data[100:350] = data[100]  # one very common vector
    rows = [(i, x.tolist()) for i, x in enumerate(data)] + [(900, None), (950, [float("nan")] * 8), (1000, [1.0, None] + [0.0] * 6), (None, [1.0] * 8), (1050, []), (1100, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in top_k.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    whole = np.floor(data * 256).astype(int)
    for q in range(0, 700, 50):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in range(700) if i != q)[:5]
        assert [got[(q, k + 1)] for k in range(5)] == [(i, -s) for s, i in best]
    assert {q for q, _ in got} == set(range(0, 700, 50)) and top_k.top_k(df.where("1 = 0"), F.lit(True)).count() == 0


def test_cover_trees_pass_over_far_pairs():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 6)) * 2000
    data = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 6)))
    ids = np.arange(4000)
    best, made = top_k.search(data[::100], ids[::100], data, ids, ids, 3)
    score = data[::100] @ data.T
    score[np.arange(40), ids[::100]] = -np.inf
    assert (best.score == -np.sort(-score, axis=1)[:, :3]).all() and made < 40 * 4000


def test_sha_of_kept(docs):
    r = repeats.without_repeats(numbered(docs)).select(F.sha2("kept", 256).alias("h"), "n_bytes").where("n_bytes = 0").first()
    assert r.h == hashlib.sha256(b"").hexdigest()
