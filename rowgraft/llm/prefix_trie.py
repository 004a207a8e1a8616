"""The prefix trie of conversations, by collapsing whole sequences first.

A turn is two 64-bit hashes; a prefix is known by its depth and the xor of the hashes of its
(place, turn) pairs, 128 bits, so prefixes of all depths come from running aggregates.

1. Turns get their places: one range exchange by (conversation, turn) and counts carried over
   the partitions, so that a conversation of any length is spread over many tasks.
2. Conversations with one whole key are a weighted sequence; its smallest member stands for it
   and the list of its ends becomes a digest, in pieces of bounded size.
3. Sequences whose key is a proper prefix of another one are dropped by an anti join: what stays
   are the leaves.
4. The prefixes of the sequences are grouped with their weights.  Sums over a subtree need no
   walk: all words of its members below a depth, less the words of its nodes, each counted for
   the one sequence it is the smallest member of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import durable
from rowgraft.operators.skew import salted_join

#: Turns of a sequence that one group of a window holds.
BLOCK = 4096
#: Conversation ids of an end list are joined in ranges of so many.
ENDS = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "k1", "k2"]


def turn_hashes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, h1, h2, words) of each turn; null role and text are empty, and a turn without a
    conversation belongs to none.  Other columns are not read."""
    r, t = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.xxhash64(r, t).alias("h1"),
        F.xxhash64(t, F.lit(1), r).alias("h2"),
        F.regexp_count(t, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame, every: int = 20, deepest: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows (conv, pos, h1, h2, words), conversations (conv)) of the frame ``turn_hashes`` gives.

    Conversation c takes its first h turns, h = crc32(c) % ``deepest``, from the one with id
    c - c % ``every`` (all it has, if fewer), and its own after its first h.  With ``deepest`` 1
    conversations are as they were.  Turns go by ``turn``, null first; equal ones by their hashes.
    """
    slim = durable(turns).withColumn("rid", F.monotonically_increasing_id())
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("h1").asc(), F.col("h2").asc(), F.col("rid").asc()]
    # The id goes up along the order and tells the partition: numbers need no window over rows.
    placed = durable(slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "h1", "h2", "words", F.monotonically_increasing_id().alias("id")))
    placed = placed.withColumn("part", F.shiftright("id", 33))
    parts = placed.groupBy("conv", "part").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    parts = parts.selectExpr("conv", "part", "first", "coalesce(sum(n) over (partition by conv order by part rows between unbounded preceding and 1 preceding), 0) as before", "n")
    size = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    own = size.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % deepest).alias("h"))
    head = own.join(size.selectExpr("conv as base", "n"), "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("head"))
    head = durable(head)
    ranked = placed.join(parts.join(head, "conv").drop("n", "base"), ["conv", "part"]).withColumn("rank", F.expr("id - first + before + 1"))
    ranked = durable(ranked.select("conv", "rank", "h", "head", "h1", "h2", "words"))
    kept = ranked.where("rank > h").selectExpr("conv", "rank - h + head as pos", "h1", "h2", "words")
    first = ranked.where((F.col("rank") < deepest) & (F.col("conv") % every == 0)).selectExpr("conv as base", "rank as pos", "h1", "h2", "words")
    taken = head.where("head > 0").select("conv", "base", "head").join(first, "base").where("pos <= head").select("conv", "pos", "h1", "h2", "words")
    return kept.unionAll(taken), head.select("conv")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of end lists whose pieces come one after the other, in order."""
    key, digest = None, None
    for batch in batches:
        done = []
        for *own, ids in zip(*[batch[c].to_pylist() for c in (*KEY, "ids")]):
            if own != key:
                done += [(*key, digest.hexdigest())] if key else []
                key, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        yield _told(done)
    yield _told([(*key, digest.hexdigest())] if key else [])


def _told(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*KEY, "ends_sha256"])


def end_digests(whole: DataFrame) -> DataFrame:
    """(key, ends_sha256) of frame (conv, key): SHA-256 of the ids that have the key, ascending and
    joined by commas.  Ids are joined in ranges first, so no group holds more than ``ENDS``."""
    ranges = whole.groupBy(*KEY, F.floor(F.col("conv") / ENDS).alias("range")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    texts = ranges.select(*KEY, "range", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "range").mapInArrow(_ends, "depth long, k1 long, k2 long, ends_sha256 string")


def _block(pos: Column) -> Column:
    return F.floor((pos - 1) / BLOCK)


def sequences_of(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with hashes of place and turn, conversations with their whole key, weighted sequences)."""
    marked = durable(rows.select("conv", "pos", F.xxhash64("pos", "h1", "h2").alias("e1"), F.xxhash64("h2", F.lit(1), "h1", "pos").alias("e2"), "words"))
    sums = marked.groupBy("conv").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("e1").alias("k1"), F.bit_xor("e2").alias("k2"), F.sum("words").alias("total"))
    whole = durable(convs.join(sums, "conv", "left").na.fill(0))
    collapsed = whole.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("seq"), F.first("total").alias("total"))
    return marked, whole, durable(collapsed)


def _prefixes(marked: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every sequence: (seq, depth, key, key of the parent, words in the sequence before it, words of its last turn, weight, total)."""
    own = sequences.select(F.col("seq").alias("conv"), F.col("depth").alias("length"), "weight", "total")
    blocks = own.where("length > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), _block(F.col("length")))))
    held = marked.withColumn("block", _block(F.col("pos"))).join(blocks, ["conv", "block"])
    inside = "over (partition by conv, block order by pos rows between unbounded preceding and current row)"
    running = held.selectExpr("*", f"bit_xor(e1) {inside} as r1", f"bit_xor(e2) {inside} as r2", f"sum(words) {inside} - words as r3")
    # Only sequences longer than a block have blocks before others.
    sums = held.where(F.col("length") > BLOCK).groupBy("conv", "block").agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"), F.sum("words").alias("x3"))
    earlier = "over (partition by conv order by block rows between unbounded preceding and 1 preceding)"
    offset = sums.selectExpr("conv", "block", f"bit_xor(x1) {earlier} as o1", f"bit_xor(x2) {earlier} as o2", f"sum(x3) {earlier} as o3")
    keyed = running.join(offset, ["conv", "block"], "left").selectExpr(
        "conv as seq", "block", "pos as depth", "r1 ^ coalesce(o1, 0) as k1", "r2 ^ coalesce(o2, 0) as k2", "e1", "e2", "r3 + coalesce(o3, 0) as before", "words", "weight", "total", "length"
    )
    nodes = keyed.selectExpr("seq", "block", *KEY, "k1 ^ e1 as p1", "k2 ^ e2 as p2", "before", "words", "weight", "total", "length")
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    root = sequences.select("seq", zero.alias("block"), zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("before"), zero.alias("words"), "weight", "total", F.col("depth").alias("length"))
    return nodes.unionAll(root)


def leaves_of(sequences: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The sequences that are no proper prefix of another one."""
    return sequences.join(prefixes.where("depth < length").select(*KEY).distinct(), KEY, "left_anti")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256, of the frames that ``rebuilt`` gives.

    ``rows`` has each place of a conversation once, from 1 without gaps; ``convs`` has every
    conversation, also those without rows, which end at the root.  Ids are whole numbers of any
    sign.  Without conversations there is no row, not even a root.
    """
    marked, whole, sequences = sequences_of(rows, convs)
    prefixes = durable(_prefixes(marked, sequences))
    # Where along its own prefixes a sequence begins to be the smallest member.
    owner = prefixes.groupBy(*KEY).agg(F.min(F.struct("seq", "before")).alias("own"))
    begin = owner.groupBy(F.col("own.seq").alias("seq")).agg(F.min(F.struct("depth", "own.before")).alias("begin"))
    leaf = leaves_of(sequences, prefixes).select("seq", F.lit(1).alias("leaf"))
    facts = sequences.select("seq", F.col("depth").alias("length")).join(begin, "seq", "left").join(leaf, "seq", "left")
    facts = facts.select("seq", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.col("begin.depth").alias("begins"), F.col("begin.before").alias("skipped"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(_block(F.col("length")), F.lit(0)))).alias("block"))
    once = F.expr("case when begins is null then 0 else total - greatest(before, skipped) end")
    nodes = (
        prefixes.join(facts, ["seq", "block"])
        .groupBy(*KEY)
        .agg(
            F.min(F.struct("seq", "begins")).alias("own"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(F.col("weight") * (F.col("total") - F.col("before")) - once).alias("saved_tokens"),
            F.first("p1").alias("p1"),
            F.first("p2").alias("p2"),
        )
    )
    nodes = durable(nodes.select(*KEY, F.col("own.seq").alias("conv_id"), F.col("own.begins").alias("begins"), "n_convs", "n_leaves", "saved_tokens", "p1", "p2"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    # A parent has the same smallest member, but above the first node a sequence owns.
    asking = nodes.where("depth = begins and depth > 0").select(*KEY, (F.col("depth") - 1).alias("q0"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    told = nodes.select(F.col("depth").alias("q0"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("up"))
    above = salted_join(asking, told, ["q0", "q1", "q2"], "inner", ["k1", "k2"]).select(*KEY, "up")
    found = nodes.join(children, KEY, "left").join(above, KEY, "left").join(end_digests(whole), KEY, "left")
    return found.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
