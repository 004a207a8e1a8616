"""Near copies by the Jaccard similarity of their word shingles, every link checked exactly.

Texts with the same shingles are one node.  Links are found in two steps:

1. SimHash.  A node's fingerprint is the majority of its shingles' hashes.  Bands, the bit-sliced
   comparison and star components (see ``simhash``) gather nodes whose fingerprints differ in at
   most ``RADIUS`` bits, and the members of each cluster are compared by their sets.
2. The rest.  At a similarity of 0.8 about ten of 64 bits are expected to differ, too many for
   bands.  The shingles are hashed where the text lies, and the least of them under ``ROWS``
   mixings is one of ``BANDS`` keys (MinHash).  Nodes that share a key meet, but those that the
   first step has put into one component need no comparison.  A pair at 0.8 shares none of the
   keys once in 100,000 times, a nearer one less often.

The texts that meet others are shingled again, once for both steps.  Groups with the same members
are one group, which compares its sets in full.  Pairs already in one component need no comparison,
so a dense group costs about as many comparisons as it has members outside its largest component.
A group over ``BLOCK`` shingles is dealt out as pairs of blocks.  Only a spanning forest of the
links is handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import durable, slices
from rowgraft.llm.simhash import SEED, components, grouped, majority, near_links

WORDS = 5
LEAST = 0.8
#: Bits in which fingerprints of one cluster's links may differ.
RADIUS = 6
BANDS = 16
ROWS = 3
#: Shingles of a group that one task compares with each other, or with as many others.
BLOCK = 1 << 20
#: Shingles mixed at a time.
CHUNK = 1 << 13
_MIXINGS = np.random.default_rng(SEED).integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the shingles of a lower-cased text, in order; of a shorter text the
    hash of all its words, and none without words."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined, ends, at = b" ".join(found), [], -1
    for w in found:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends]]
    hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[min(words, len(ends)) - 1 :])]
    return np.unique(np.array(hashes, np.uint64))


def keys(own: np.ndarray) -> list[int]:
    """The keys under which the text with these shingles meets others."""
    least = np.full(len(_MIXINGS), 2**64 - 1, np.uint64)
    for i in range(0, len(own), CHUNK):
        x = own[None, i : i + CHUNK] ^ _MIXINGS
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95)
        least = np.minimum(least, x.min(axis=1))
    return [_signed(xxhash.xxh3_64_intdigest(band.tobytes(), i)) for i, band in enumerate(least.reshape(BANDS, ROWS))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _node(own: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(own.tobytes())) if len(own) else 0


def _marks(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for b, texts in slices(batches):
        sets = [shingles(t, words) for t in texts]
        columns = [
            b["id"],
            pa.array([_node(s) for s in sets], pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([_signed(majority(s)) for s in sets], pa.int64()),
            pa.array([keys(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["id", "fp", "size", "sim", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for b, texts in slices(batches):
        yield pa.RecordBatch.from_arrays([b["fp"], pa.array([shingles(t, words).tobytes() for t in texts], pa.binary())], ["fp", "own"])


def alike(sets: list[np.ndarray], side: np.ndarray, least: float, root: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with at least this similarity: side 0 against side 1, or
    among side 2.  Members with one root are known to be in one component."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    part = np.unique(root, return_inverse=True)[1]
    if m < 2 or size.min() < 1 or not part.any():
        return []
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if both / (size.sum() - both) >= least else []
    # Who has a shingle that several have: ``holder`` in runs, ``own`` the runs of each member.
    _, run, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(m), size)
    shared = count[run] > 1
    run, member = run[shared], member[shared]
    begin = np.zeros(len(count) + 1, np.int64)
    np.cumsum(np.where(count > 1, count, 0), out=begin[1:])
    holder = member[np.argsort(run, kind="stable")]
    first = np.searchsorted(member, np.arange(m + 1))
    done, links = np.zeros(m, bool), []
    while True:
        # Pairs inside the largest component need no comparison, all others have a member outside.
        left = np.flatnonzero(~done & (part != np.bincount(part).argmax()))
        if not len(left):
            return links
        i = left[0]
        done[i] = True
        own = run[first[i] : first[i + 1]]
        n = begin[own + 1] - begin[own]
        met = holder[np.arange(n.sum()) + np.repeat(begin[own] - np.cumsum(n) + n, n)]
        both = np.bincount(met, minlength=m)
        near = both / (size + size[i] - both) >= least
        near &= (side == 2) | (side != side[i])
        near &= part != part[i]
        if near.any():
            with_, at = np.unique(part[near], return_index=True)
            links += [(i, int(j)) for j in np.flatnonzero(near)[at]]
            part[np.isin(part, with_)] = part[i]


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links of each run of rows with one group."""

    def links(rows):
        fps, sides, roots, sets = zip(*rows)
        found = alike([np.frombuffer(s, np.uint64) for s in sets], np.array(sides), least, np.array(roots))
        return [(fps[i], fps[j]) for i, j in found]

    group, rows = None, []
    for b in batches:
        found = []
        for g, side, fp, root, own in zip(*[b[c].to_pylist() for c in ("grp", "side", "fp", "root", "own")]):
            if g != group:
                found += links(rows) if len(rows) > 1 else []
                group, rows = g, []
            rows.append((fp, side, root, own))
        yield _batch(found)
    yield _batch(links(rows) if len(rows) > 1 else [])


def _batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _groups(members: DataFrame) -> DataFrame:
    """(key, blocks) of the keys whose members (fp, size, root, key) have several roots; of keys
    with the same members one."""
    told = [F.bit_xor(F.xxhash64("fp", F.lit(i))).alias(f"m{i}") for i in (1, 2)]
    several = members.groupBy("key").agg(F.sum("size").alias("all"), F.min("root").alias("low"), F.max("root").alias("high"), *told).where("low < high")
    return several.groupBy("all", "m1", "m2").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"))


def _meetings(members: DataFrame) -> DataFrame:
    """(fp, root, grp, side) of the members that meet others."""
    dealt = members.join(_groups(members), "key").withColumn("own", F.expr("cast(pmod(xxhash64(fp, key), blocks) as int)"))
    # A block meets itself and every other block of its group once.
    return dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "fp",
        "root",
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("grp"),
        F.expr("case when own = other then 2 when own < other then 0 else 1 end").alias("side"),
    )


def _links(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that connect all members of a key whose sets are alike."""
    sorted_ = _meetings(members).join(sets, "fp").repartition("grp").sortWithinPartitions("grp")
    return durable(sorted_.mapInArrow(lambda b: _compare(b, least), "a long, b long").distinct())


def clusters(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, size, root, key) of the nodes whose fingerprint is linked with another node's over at
    most ``radius`` differing bits: key is the cluster, root the node itself."""
    own = distinct.where("size > 0").select("fp", "size", F.col("fp").alias("root"), "sim")
    linked = components(near_links(own.select(F.col("sim").alias("fp")).distinct(), radius)).toDF("sim", "cluster")
    keyed = own.join(linked, "sim", "left").select("fp", "size", "root", F.coalesce("cluster", "sim").alias("key"))
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return keyed.join(several, "key").select("fp", "size", "root", "key")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (equal for equal sets of shingles) and
    ``component_id``, the smallest id reachable over pairs of texts whose shingles have at
    least this Jaccard similarity.

    Ids are distinct.  Texts without words are one group; an empty table gives no rows.
    Other columns are not read.
    """
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    marked = durable(own.mapInArrow(lambda b: _marks(b, words), f"id {dict(own.dtypes)['id']}, fp long, size long, sim long, keys array<long>"))
    columns = [F.min("id").alias("least"), *[F.first(c).alias(c) for c in ("size", "sim", "keys")]]
    distinct = durable(marked.groupBy("fp").agg(*columns))
    near = durable(clusters(distinct))
    keyed = lambda nodes: nodes.select("fp", "size", "root", F.explode("keys").alias("key"))
    alone = keyed(distinct.withColumn("root", F.col("fp")))
    met = near.select("fp").unionAll(alone.join(_groups(alone), "key").select("fp")).distinct()
    meeting = distinct.select("fp", F.col("least").alias("id")).join(met, "fp")
    sets = durable(own.join(meeting, "id").select("fp", "text").mapInArrow(lambda b: _sets(b, words), "fp long, own binary"))
    first = _links(near, sets, least)
    known = components(first).select(F.col("node").alias("fp"), "root")
    rest = keyed(distinct.join(known, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    links = first.unionAll(_links(rest, sets, least))
    return grouped(marked.select("id", "fp"), distinct.select("fp", "least"), links, id_column)
