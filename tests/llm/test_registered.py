"""Registered queries without SQL against plain Python, on the smallest data set."""

import collections
import hashlib
import itertools
import math
import zlib

import numpy as np
import pytest
import xxhash

from rowgraft.llm import language_id, pieces, repeats
from rowgraft.llm.common import documents
from rowgraft.llm.lattice import Segments, load_vocabulary, zipf
from rowgraft.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: (r.text or "").encode() for r in documents(spark, sf).collect()}


def _crc(i):
    return zlib.crc32(str(i).encode())


def test_op2(spark, sf, texts):
    rows = {r.doc_id: r for r in QUERIES["op2_ppm_score"](spark, sf).collect()}
    words = {i: [*t.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split(), b"\n"] for i, t in texts.items()}
    count = collections.Counter(w for i, own in words.items() if _crc(i) % 5 != 1 for w in own)
    n, v = sum(count.values()), len(count)
    assert set(rows) == set(texts)
    for i, own in words.items():
        r = rows[i]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_crc(i) % 5 == 1, len(own), sum(w in count for w in own), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_op5(spark, sf, texts):
    rows = QUERIES["op5_histogram_shards"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    shards, of_text = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]), "bytes", None)
        shards[r.shard].append(r)
        of_text[texts[r.doc_id]].add(r.shard)
    mean = sum(r["size"] for r in rows) / 24
    longest = max(r["size"] for r in rows)
    assert set(shards) <= set(range(24)) and all(abs(sum(r["size"] for r in own) - mean) <= longest for own in shards.values())
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in shards.values())
    # Copies are neighbours: cut apart only where a shard ends.
    assert all(max(s) - min(s) <= 1 for s in of_text.values())


def test_op6(spark, sf, texts):
    seen = collections.Counter()
    for t in texts.values():
        seen.update(xxhash.xxh3_64_intdigest(t[p : p + 400]) for p in range(len(t) - 399))
    grams, of_doc = collections.Counter(), {}
    for i, t in texts.items():
        at, g = repeats.word_grams(t)
        of_doc[i] = (at, g)
        grams.update(g.tolist())
    for r in QUERIES["op6_suffix_dedup"](spark, sf).collect():
        t, gone = texts[r.doc_id], np.zeros(len(texts[r.doc_id]) + 1, np.int64)
        for p in range(len(t) - 399):
            if seen[xxhash.xxh3_64_intdigest(t[p : p + 400])] > 1:
                gone[p] += 1
                gone[p + 400] -= 1
        cut = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(t, np.uint8)[~cut].tobytes()
        spans = int((np.diff(cut.astype(int), prepend=0) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest())
        at, g = of_doc[r.doc_id]
        shared = [a for a, x in zip(at.tolist(), g.tolist()) if grams[x] > 1]
        assert r.n_shared_words == sum(16 if k == 0 or a - shared[k - 1] >= 51 else a - shared[k - 1] for k, a in enumerate(shared))


def test_op10(spark, sf, texts):
    def fingerprint(text):
        w = text.lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in fp}
    for a, b in itertools.combinations(sorted(fp), 2):
        if (fp[a] ^ fp[b]).bit_count() <= 4 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, sf).collect()} == {(i, f"{fp[i]:016x}", root[i]) for i in fp}


class Brute:
    """All segmentations of a segment, by dynamic programming over a dictionary of pieces."""

    def __init__(self, vocabulary):
        special = set(vocabulary.byte_id.tolist())
        self.longest = vocabulary.longest
        self.id_of = {}
        for i, p in enumerate(vocabulary.bytes_of):
            if p and i not in special:
                self.id_of.setdefault(p, i)
        for b in range(256):
            self.id_of.setdefault(bytes([b]), int(vocabulary.byte_id[b]))

    def arcs(self, text):
        return [(k, e, self.id_of[text[k:e]]) for e in range(1, len(text) + 1) for k in range(max(0, e - self.longest), e) if text[k:e] in self.id_of]

    def sums(self, text, weight):
        """(probability, expected uses of each piece)."""
        arcs, ahead = self.arcs(text), [1.0, *[0.0] * len(text)]
        for k, e, i in arcs:
            ahead[e] += ahead[k] * math.exp(weight[i])
        behind = [*[0.0] * len(text), 1.0]
        for k, e, i in reversed(arcs):
            behind[k] += behind[e] * math.exp(weight[i])
        uses = collections.Counter()
        for k, e, i in arcs:
            uses[i] += ahead[k] * math.exp(weight[i]) * behind[e] / ahead[-1]
        return ahead[-1], uses


def _segments(text):
    cut = Segments([text])
    return [cut.distinct[c].as_py() for c in cut.code.tolist()]


def test_op8_learns_and_predicts_as_by_hand(spark):
    rows = [("a", "the cat sat"), ("a", "the dog"), ("b", "der Hund"), ("b", "die Katze saß da"), (None, "ignored"), ("a", None)]
    labelled = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    langs, weight = language_id.learn(labelled)
    v = load_vocabulary()
    brute, prior = Brute(v), zipf(v)
    counts = {lang: np.full(v.size, language_id.SMOOTHING) for lang in "ab"}
    for lang, text in rows:
        for s in _segments(text.encode()) if lang and text else ():
            for i, n in brute.sums(s, prior)[1].items():
                counts[lang][i] += n
    want = {lang: np.maximum(np.log(c / c.sum()), language_id.LEAST) for lang, c in counts.items()}
    assert langs == ["a", "b"] and all(np.allclose(weight[k], want[lang], rtol=1e-6) for k, lang in enumerate("ab"))
    asked = ["the hat", "der Dog da", "xyz", "1 2", "", None]
    told = language_id.with_language(spark.createDataFrame([(t,) for t in asked], "text string").coalesce(1), (langs, weight)).collect()
    for t, r in zip(asked, told):
        if not t or not any(map(str.isalpha, t)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        logs = [sum(math.log(brute.sums(s, want[lang])[0]) for s in _segments(t.encode())) for lang in "ab"]
        share = [math.exp(x - max(logs)) for x in logs]
        best = int(np.argmax(logs))
        assert r.lang_pred == "ab"[best] and math.isclose(r.score, share[best] / sum(share), rel_tol=1e-6)


def test_op8_sample_is_bounded_and_mixed(spark):
    """Copies of one text do not crowd out the others of its language."""
    rows = [("a", "copy of one text")] * 5000 + [("a", f"other text number {i} zebra") for i in range(1000)] + [("b", "kurz")]
    labelled = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    v = load_vocabulary()
    langs, weight = language_id.learn(labelled, per_language=128)
    counts = np.exp(weight[0])
    word = v.bytes_of.index(b" number")
    assert langs == ["a", "b"] and counts[word] > 10 * np.exp(weight[1])[word]


def test_op7_draws_follow_the_segmentations(spark, sf):
    """Shares of the segmentations of one text over many row keys, against their probabilities."""
    v = load_vocabulary()
    brute, weight, n = Brute(v), zipf(v), 20_000
    text = b"then"
    (segment,) = _segments(text)
    arcs = collections.defaultdict(list)
    for k, e, i in brute.arcs(segment):
        arcs[k].append((e, i))
    paths = {(): (0, 0.0)}
    whole = {}
    while paths:
        ids, (at, log_p) = paths.popitem()
        if at == len(segment):
            whole[ids] = math.exp(log_p)
        for e, i in arcs[at]:
            paths[(*ids, i)] = (e, log_p + weight[i])
    total = sum(whole.values())
    assert math.isclose(total, brute.sums(segment, weight)[0], rel_tol=1e-9)
    drawn, each = pieces.sample([text] * n, np.array([xxhash.xxh64_intdigest(str(k), 7) for k in range(n)], np.uint64), v)
    at = np.r_[0, np.cumsum(each)]
    seen = collections.Counter(tuple(drawn[a:b].tolist()) for a, b in zip(at, at[1:]))
    assert set(seen) <= set(whole)
    for ids, p in whole.items():
        p /= total
        assert abs(seen[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
    rows = QUERIES["op7_sampled_pieces"](spark, sf).collect()
    assert all(r.lossless and r.n_pieces == len(r.pieces or []) for r in rows)
