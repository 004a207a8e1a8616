"""Exact top-k by inner product with two cover trees.

Vectors are dealt into blocks and queries into groups; a task gets one block and one group and
builds a tree over each: a node is a centre, the rows it covers and their greatest distance
from the centre; its children are centres chosen farthest first until they cover the rows
at half the radius.  Pairs of nodes are visited best first.  For a query node (centre q, radius
s) and a data node (centre c, radius r) no inner product exceeds q.c + s|c| + r|q| + s r, so a pair
whose bound is under the worst k-th score of the query node's queries is passed over whole; at
the leaves scores are exact products of whole numbers.  The best k of each block meet per query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import durable, numbered

K = 5
#: Rows of a block of data and of a group of queries, and of a leaf of either tree; fewer queries
#: share a leaf, as the worst of them decides what may be passed over.  Every group meets all
#: data, so groups are large.
BLOCK, GROUP, LEAF, QUERY_LEAF = 8192, 8192, 1024, 32
#: Centres a node is split into at most, where half its radius needs more.
WIDEST = 32


class Node:
    __slots__ = ("centre", "norm", "radius", "rows", "children")

    def __init__(self, x: np.ndarray, rows: np.ndarray, centre: int, leaf: int):
        self.centre, self.rows, self.children = x[centre], rows, []
        self.norm = float(np.sqrt(self.centre @ self.centre))
        gap = _gaps(x, rows, centre)
        # Rounding must not make a bound too small.
        self.radius = float(gap.max()) * (1 + 1e-9)
        if len(rows) > leaf and self.radius:
            self._split(x, rows, centre, gap, leaf)

    def _split(self, x: np.ndarray, rows: np.ndarray, centre: int, gap: np.ndarray, leaf: int) -> None:
        centres, nearest, far = [centre], np.zeros(len(rows), np.int64), gap
        while far.max() > self.radius / 2 and len(centres) < WIDEST:
            new = int(rows[far.argmax()])
            other = _gaps(x, rows, new)
            closer = other < far
            nearest[closer], far = len(centres), np.minimum(far, other)
            centres.append(new)
        self.children = [Node(x, own, c, leaf) for k, c in enumerate(centres) if len(own := rows[nearest == k])]


def _gaps(x: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    away = x[rows] - x[centre]
    return np.sqrt(np.einsum("ij,ij->i", away, away))


def _bound(q: Node, d: Node) -> float:
    return float(q.centre @ d.centre) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius + 0.5


class Best:
    """The k best scores so far of each query, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        n, col = np.nonzero((score >= self.score[rows, -1][:, None]) & (score > -np.inf))
        if not len(n):
            return
        # What the touched queries hold already meets the new hits; the first k of each stay.
        touched = np.unique(n)
        at = np.r_[np.repeat(touched, k), n]
        s = np.r_[self.score[rows[touched]].ravel(), score[n, col]]
        i = np.r_[self.ids[rows[touched]].ravel(), ids[col]]
        order = np.lexsort((i, -s, at))
        first = np.searchsorted(at[order], touched)
        top = order[first[:, None] + np.arange(k)]
        self.score[rows[touched]], self.ids[rows[touched]] = s[top], i[top]

    def worst(self, rows: np.ndarray) -> float:
        return float(self.score[rows, -1].min())


def search(q: np.ndarray, q_rid: np.ndarray, d: np.ndarray, d_rid: np.ndarray, d_id: np.ndarray, k: int = K) -> tuple[Best, int]:
    """The best k rows of ``d`` for each row of ``q`` (whole numbers as floats) other than the row
    itself, and how many scores were computed."""
    best, made = Best(len(q), k), 0
    if not len(q) or not len(d):
        return best, made
    roots = Node(q, np.arange(len(q)), 0, QUERY_LEAF), Node(d, np.arange(len(d)), 0, LEAF)
    heap, turn = [(-_bound(*roots), 0, *roots)], 1
    while heap:
        bound, _, a, b = heapq.heappop(heap)
        if -bound < best.worst(a.rows):
            continue
        if not a.children and not b.children:
            score = q[a.rows] @ d[b.rows].T
            made += score.size
            score[q_rid[a.rows][:, None] == d_rid[b.rows][None]] = -np.inf
            best.add(a.rows, score, d_id[b.rows])
            continue
        wide = not b.children or (a.children and a.radius * b.norm > b.radius * a.norm)
        for x, y in [(c, b) for c in a.children] if wide else [(a, c) for c in b.children]:
            limit = _bound(x, y)
            if limit >= best.worst(x.rows):
                heapq.heappush(heap, (-limit, turn, x, y))
                turn += 1
    return best, made


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all components finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = t["vector"].combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(t), -1), t["rid"].to_numpy(), t["id"].to_numpy()


def _pair(queries: pa.Table, data: pa.Table, k: int) -> pa.Table:
    if not len(queries) or not len(data):
        return pa.table({"rid": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    q, q_rid, _ = _matrix(queries)
    best, _ = search(q, q_rid, *_matrix(data), k)
    found = np.isfinite(best.score)
    row = np.nonzero(found)[0]
    return pa.table({"rid": q_rid[row], "id": best.ids[found], "score": best.score[found].astype(np.int64)})


def top_k(vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, id, score): the k highest integer inner products of each query row with
    any other row, ties to the smaller id; fewer where there are fewer rows.

    ``is_query`` is a condition on the columns of ``vectors``.  Rows with a null id, or with a
    vector that is null, empty or holds a null or non-finite component, take no part.  Vectors
    are compared with those of the same length.  Repeated rows are separate: a copy of the
    query is a candidate.  An empty table gives no rows.  Other columns are not read.
    """
    own = numbered(vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asks")))
    fit = durable(own.where(usable(F.col("raw")) & F.col("id").isNotNull()).select("rid", "id", "asks", F.size("raw").alias("dim"), whole_numbers(F.col("raw")).alias("vector")))
    sizes = {r["dim"]: (r["n"], r["q"]) for r in fit.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).collect()}
    parts = []
    for dim, (n, asked) in sorted(sizes.items()):
        if not asked:
            continue
        blocks, groups = -(-n // BLOCK), -(-asked // GROUP)
        of = fit.where(F.col("dim") == dim)
        data = of.select("rid", "id", "vector", F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"))
        asks = of.where("asks").select("rid", "id", "vector", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(groups)).cast("int").alias("grp"))
        # Each group of queries meets each block once: a stated query set against all rows.
        data = data.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        met = asks.groupBy("block", "grp").cogroup(data.groupBy("block", "grp"))
        parts.append(met.applyInArrow(lambda a, b: _pair(a, b, k), "rid long, id long, score long"))
    if not parts:
        return fit.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score")).limit(0)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    ranked = found.withColumn("rank", F.expr("row_number() over (partition by rid order by score desc, id)")).where(F.col("rank") <= k)
    return ranked.join(fit.where("asks").select("rid", F.col("id").alias("query_id")), "rid").select("query_id", "rank", "id", "score")
