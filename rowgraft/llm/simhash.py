"""Near copies by SimHash fingerprints that differ in few bits.

Fingerprints are made where the text lies.  Distinct ones are bucketed by chosen bits: with
the 64 bits in ``b`` bands, two fingerprints at ``radius`` differing bits agree on some
``b - radius`` whole bands, so every link falls into a bucket; ``b`` follows from the number
of fingerprints, so that buckets stay small.  A bucket over ``BLOCK`` is dealt out as pairs of
blocks.  Inside, bit planes are stored vertically, one 64-bit word holding one bit of 64
fingerprints; distances of 64 pairs at a time are added with carry-save counters, plane by
plane, and words in which all distances exceed the radius are abandoned.  Each task hands on
a spanning forest of the links it finds, so a dense group costs as many rows as it has
members.  Components come from large-star and small-star rounds over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import durable, slices

RADIUS = 4
WORDS = 4
SEED = 42
#: Rows of a bucket that one task compares with each other, or with as many others.
BLOCK = 4096
#: (fingerprint, word of 64) pairs compared at a time.
TILES = 1 << 16
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the shingles of a lower-cased text; zero without words."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    else:
        joined, ends, at = b" ".join(found), [], -1
        for w in found:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends]]
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :])]
    return majority(hashes)


def majority(hashes: list[int] | np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[i : i + (1 << 16)], np.uint64)
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp) per row, fp the 64 bits as a signed long.  Null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in slices(batches):
            fp = pa.array([_signed(fingerprint(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b["id"], fp], ["id", "fp"])

    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return own.mapInArrow(run, f"id {dict(own.dtypes)['id']}, fp long")


def bands_for(n: int, radius: int = RADIUS) -> int:
    """The fewest bands for which the mean bucket of n spread fingerprints is under BLOCK rows."""
    for b in range(radius + 1, 17):
        if n <= BLOCK << (64 * (b - radius) // b):
            return b
    return 16


def _masks(bands: int, radius: int) -> list[int]:
    """Bits of every choice of bands that remain when ``radius`` bands are left out."""
    edge = [round(i * 64 / bands) for i in range(bands + 1)]
    band = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(bands)]
    return [sum(x) for x in combinations(band, bands - radius)]


def near_in_blocks(fps: np.ndarray, left: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) within the radius, for tiles: fingerprint ``left[t]`` against the lanes set in
    ``lanes[t]`` of word ``word[t]`` (fingerprints 64 * word and on)."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)
    most = (radius + 1).bit_length()
    found_i, found_j = [], []
    for a in range(0, len(left), TILES):
        i, w, live = left[a : a + TILES], word[a : a + TILES], lanes[a : a + TILES].copy()
        count = [np.zeros(len(i), np.uint64) for _ in range(most)]
        own = fps[i]
        for p in range(64):
            carry = planes[p][w] ^ (ONES * ((own >> np.uint64(p)) & np.uint64(1)))
            for c in count:
                c_old = c.copy()
                c ^= carry
                carry &= c_old
            over = carry  # the counters ran over
            if p % 8 == 7 or radius + 1 == 1 << most:
                over = over | _at_least(count, radius + 1)
            live &= ~over
            if p % 8 == 7:
                keep = live != 0
                if not keep.any():
                    i = i[:0]
                    break
                if not keep.all():
                    i, w, live, own = i[keep], w[keep], live[keep], own[keep]
                    count = [c[keep] for c in count]
        if len(i):
            hit = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            t, lane = np.nonzero(hit)
            found_i.append(i[t])
            found_j.append(w[t] * 64 + lane)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _at_least(count: list[np.ndarray], n: int) -> np.ndarray:
    """Lanes whose counter (lowest bit first) is n or more."""
    above, same = np.zeros_like(count[0]), np.full_like(count[0], ONES)
    for k in range(len(count) - 1, -1, -1):
        if n >> k & 1:
            same = same & count[k]
        else:
            above |= same & count[k]
            same = same & ~count[k]
    return above | same


def _forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Positions of links that join something new."""
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := top.get(x, x)) != x:
            top[x] = x = top.get(y, y)
        return x

    kept = []
    for at, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = root(a), root(b)
        if a != b:
            top[a] = b
            kept.append(at)
    return kept


def _links_of(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in rows sorted by group, then side: side 0 against side 1, or among side 2."""
    edge = np.flatnonzero(np.diff(group)) + 1
    first, last = np.r_[0, edge], np.r_[edge, len(group)]
    lefts, words, lanes = [], [], []
    for s, e in zip(first.tolist(), last.tolist()):
        if e - s < 2:
            continue
        if side[s] == 2:
            i = np.arange(s, e - 1)
            low = i + 1
        else:
            cut = s + int(np.searchsorted(side[s:e], 1))
            i = np.arange(s, cut)
            low = np.full(len(i), cut)
        n = (e - 1) // 64 - low // 64 + 1  # words from the first lane to the group's end
        left = np.repeat(i, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        word = np.repeat(low // 64, n) + at
        begin = np.maximum(np.repeat(low, n) - word * 64, 0)
        stop = np.minimum(e - word * 64, 64)
        full = np.where(stop == 64, ONES, (np.uint64(1) << (stop % 64).astype(np.uint64)) - np.uint64(1))
        lefts.append(left)
        words.append(word)
        lanes.append(full & (ONES << begin.astype(np.uint64)))
    if not lefts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return near_in_blocks(fps, np.concatenate(lefts), np.concatenate(words), np.concatenate(lanes), radius)


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of each run of rows with one group; a run that goes on in the next batch is held back."""

    def links(fp, group, side):
        i, j = _links_of(fp.view(np.uint64), group, side, radius)
        keep = _forest(i, j)
        return pa.RecordBatch.from_arrays([pa.array(fp[i[keep]]), pa.array(fp[j[keep]])], ["a", "b"])

    held: list[np.ndarray] | None = None
    for b in batches:
        new = [b[c].to_numpy(zero_copy_only=False) for c in ("fp", "grp", "side")]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if len(held[1]) and held[1][0] != held[1][-1]:
            cut = int(np.flatnonzero(np.diff(held[1]))[-1]) + 1
            yield links(*(x[:cut] for x in held))
            held = [x[cut:].copy() for x in held]
    if held is not None and len(held[0]):
        yield links(*held)


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fp) that connect all that are within the
    radius: enough for components, fewer than all pairs."""
    n = fps.count()
    masks = _masks(bands_for(n, radius), radius)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "bits"))
    size = keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = keyed.join(size, ["mask", "bits"]).withColumn("blocks", blocks).withColumn("own", F.expr("cast(pmod(xxhash64(fp, mask), blocks) as int)"))
    # A block meets itself and every other block of its bucket once.
    met = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = met.select(
        F.xxhash64("mask", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("grp"),
        F.expr("case when own = other then 2 when own < other then 0 else 1 end").alias("side"),
        "fp",
    )
    sorted_ = rows.repartition("grp").sortWithinPartitions("grp", "side")
    return sorted_.mapInArrow(lambda b: _compare(b, radius), "a long, b long").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node it reaches.

    Large-star and small-star rounds, each over the written result of the round before; their
    number grows with the logarithm of the longest chain.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("x"), "m").unionAll(small.select(F.col("u").alias("x"), "m")).where("x <> m")
        edges = durable(small.select(F.col("x").alias("u"), F.col("m").alias("v")).distinct())
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(marked: DataFrame, distinct: DataFrame, links: DataFrame, id_column: str) -> DataFrame:
    """The rows (id, fp) with ``component_id``, the smallest ``least`` of the distinct ones (fp, least)
    that the links reach."""
    member = components(links)
    rooted = distinct.join(member, distinct.fp == member.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = durable(rooted.join(smallest, "root").select("fp", "component_id"))
    return marked.join(known, "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` and ``component_id``, the smallest id reachable
    over links of at most ``radius`` differing bits.

    Null and empty texts have fingerprint 0, which links like any other.  Null ids are never a
    component's id unless the component has no other; repeated rows give repeated results; an
    empty table gives no rows.  Other columns are not read.
    """
    marked = durable(fingerprints(docs, id_column, text_column))
    distinct = durable(marked.groupBy("fp").agg(F.min("id").alias("least")))
    return grouped(marked, distinct, near_links(distinct.select("fp"), radius), id_column)
