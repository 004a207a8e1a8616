"""Shards of near equal size by histogram sort; DataFrame functions only.

Rows are ordered by (hash of the text, hash of the id, row number), so equal texts lie next
to each other and a group of copies is cut only where a shard ends.  Splitters are sought by
counting: each round deals the key ranges that still hold a splitter into equal slices, sums
the bytes of every slice over all partitions and goes on in the slice with the splitter,
until what is left weighs no more than the tolerance.  A range that has shrunk to a single
key value (one large group of equal texts) is refined by the next key.  Then each row's shard
is a comparison with the splitters, and one exchange brings the shards together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from rowgraft.llm.common import durable, free_name

SLICES = 128
WIDEST = (1 << 63) - 1


@dataclass(frozen=True)
class Range:
    """Rows whose first keys equal ``prefix`` and whose next key is in low..high; ``below`` is
    the weight of all rows before them."""

    prefix: tuple[int, ...]
    low: int
    high: int
    below: int

    def step(self) -> int:
        return -(-(self.high - self.low + 1) // SLICES)


def _within(r: Range, keys: list[str]) -> Column:
    found = F.col(keys[len(r.prefix)]).between(r.low, r.high)
    for key, value in zip(keys, r.prefix):
        found = (F.col(key) == F.lit(value)) & found
    return found


def _not_before(cut: tuple[int, ...], keys: list[str]) -> Column:
    """Whether a row is at or after the cut in the order of the keys."""
    key, value = F.col(keys[0]), F.lit(cut[0])
    if len(cut) == 1:
        return key >= value
    return (key > value) | ((key == value) & _not_before(cut[1:], keys[1:]))


def _slices(df: DataFrame, keys: list[str], ranges: list[Range]) -> dict[Range, dict[int, Row]]:
    """Weight, least and greatest key and rows of each slice of each range: at most SLICES rows a range reach the driver."""
    which = part = key = None
    for i, r in enumerate(ranges):
        here = _within(r, keys)
        own = F.col(keys[len(r.prefix)])
        at = F.expr(f"(`{keys[len(r.prefix)]}` - {r.low}) div {r.step()}")
        which = F.when(here, F.lit(i)) if which is None else which.when(here, F.lit(i))
        part = F.when(here, at) if part is None else part.when(here, at)
        key = F.when(here, own) if key is None else key.when(here, own)
    told = df.select(which.alias("r"), part.alias("p"), key.alias("k"), "weight").where("r is not null")
    sums = told.groupBy("r", "p").agg(F.sum("weight").alias("w"), F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n"))
    found: dict[Range, dict[int, Row]] = {r: {} for r in ranges}
    for row in sums.collect():
        found[ranges[row.r]][row.p] = row
    return found


def splitters(df: DataFrame, keys: list[str], shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """The first keys of shards 1, 2, ...: where the weight before them is nearest to equal.

    ``df`` holds the keys (non-negative longs, the last one unique) and ``weight``.
    """
    total = df.agg(F.sum("weight")).first()[0] or 0
    targets = [total * j / shards for j in range(1, shards)]
    limit = tolerance * total / shards
    open_, cuts = {j: Range((), 0, WIDEST, 0) for j in range(len(targets))}, {}
    while open_ and total:
        found = _slices(df, keys, sorted(set(open_.values()), key=lambda r: (r.prefix, r.low)))
        after = {}
        for j, r in open_.items():
            slices, below = sorted(found[r].items()), r.below
            for _, s in slices:
                if below + s.w >= targets[j] or s is slices[-1][1]:
                    break
                below += s.w
            if s.w <= limit or s.n == 1:
                behind = targets[j] - below > below + s.w - targets[j]
                cuts[j] = (*r.prefix, s.high + 1 if behind else s.low)
            elif s.low == s.high:
                after[j] = Range((*r.prefix, s.low), 0, WIDEST, below)
            else:
                after[j] = Range(r.prefix, s.low, s.high, below)
        open_ = after
    return sorted(cuts.values())


def histogram_shards(df: DataFrame, group: Column, row: Column, size: Column, shards: int, tolerance: float = 1e-4) -> DataFrame:
    """The rows of ``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``size`` weighs a row (a whole number, not negative); rows of equal ``group`` are
    neighbours, ordered by ``row``.  Shard weights differ from the mean by about the
    tolerance (a part of the mean) or half a row, whichever is more.  The frame is written
    once, so carry only the columns that are needed.

    An empty frame gives an empty frame.  Nulls are a group of their own.  Rows equal in every
    column are told apart by their row number and may be cut apart.  A column of the frame
    named shard or slot is not touched: the new one gets a trailing underscore.
    """
    k = [free_name(df, n) for n in ("key1", "key2", "key3", "weight")]
    hashed = [F.shiftrightunsigned(F.xxhash64(x), 1) for x in (group, row)]
    held = durable(df.withColumns({k[0]: hashed[0], k[1]: hashed[1], k[2]: F.monotonically_increasing_id(), k[3]: size.cast("long")}))
    keys = k[:3]
    cuts = splitters(held.select(*keys, F.col(k[3]).alias("weight")), keys, shards, tolerance)
    shard, slot, part, n, first = (free_name(held, c) for c in ("shard", "slot", "part", "n", "first"))
    at = F.lit(0)
    for cut in cuts:
        at = at + _not_before(cut, keys).cast("int")
    # The high bits of the row number name the written part, so a numbered group is at most one part.
    dealt = held.withColumns({shard: at, part: F.shiftright(F.col(k[2]), 33)})
    counts = dealt.groupBy(shard, part).agg(F.count(F.lit(1)).alias(n))
    firsts = counts.selectExpr(f"{shard}", f"{part}", f"sum({n}) over (partition by {shard} order by {part}) - {n} as {first}")
    inside = F.expr(f"row_number() over (partition by {shard}, {part} order by {k[0]}, {k[1]}, {k[2]})")
    return (
        dealt.withColumn(slot, inside)
        .join(firsts, [shard, part])
        .withColumn(slot, F.col(slot) + F.col(first) - 1)
        .select(*df.columns, shard, slot)
    )
