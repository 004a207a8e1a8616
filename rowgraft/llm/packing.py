"""Tokenised documents packed into sequences by a cutting-stock plan.

1. Every document is tokenised where it lies and cut into whole sequences and a rest; only
   slim pieces (length, checksum, and a running number and sum of tokens within length class
   and partition) are written.
2. Numbers and sums are carried over the partitions of a class, so each rest has its rank among
   those of its class, and the tokens before it, without a sort.
3. The histogram of the rests (one row per class) is planned on the driver, see
   ``cutting_stock``; a rest finds its sequence from its class and rank.
4. Rests that no full pattern takes (little, unless most lengths fit nothing) are laid end to
   end and cut where a sequence is full, the last tokens at powers of two.  Only documents cut
   there are tokenised again, for the checksums of their parts.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import Joined, durable, numbered, slices, unit_ends
from rowgraft.llm.cutting_stock import Pattern, patterns
from rowgraft.operators.skew import is_small, sized_join

#: The ranks of the vocabulary; its ids are those of byte_bpe_50k.json (tests hold both together).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed: the vocabulary's split into words, and its one special token.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}
END = 1
SIZE = 2048
#: Lengths of one class differ by less.
WIDTH = 8
#: Patterns that leave more than this share of a sequence empty are not used.
WASTE = 0.01
#: Bytes of text tokenised at a time.
CHUNK = 4 << 20

PIECE = "part int, rid long, start long, length long, crc long, doc_tokens long, class int, nth long, before long"


class Encoder:
    """Token ids of texts.  Words never share a token with their neighbours, so each distinct word
    of a chunk is encoded once."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bpe = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=table, special_tokens=SPECIAL)
        self.size_of = np.zeros(max(table.values()) + 2, np.int64)
        for token, i in [*table.items(), *[(k.encode(), i) for k, i in SPECIAL.items()]]:
            self.size_of[i] = len(token)

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.bpe.encode(text.decode(), allowed_special="all"), np.uint32)

    def _of_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, their number per unit): units that begin with a blank and end
        with a word are encoded as one text, as no token goes over the end of one."""
        apart = [i for i, u in enumerate(units) if u[:1].strip() or not u[-1:].strip()]
        alone = set(apart)
        chained = [i for i in range(len(units)) if i not in alone]
        ids = self._ids(b"".join([units[i] for i in chained]))
        size = np.array([len(units[i]) for i in chained], np.int64)
        counts = np.zeros(len(units), np.int64)
        if chained:
            counts[chained] = np.diff(np.searchsorted(np.cumsum(self.size_of[ids]), np.cumsum(size), side="right"), prepend=0)
        found = {i: self._ids(units[i]) for i in apart}
        for i, own in found.items():
            counts[i] = len(own)
        out, first = np.zeros(int(counts.sum()), np.uint32), np.cumsum(counts) - counts
        for i, own in found.items():
            out[first[i] : first[i] + len(own)] = own
        if chained:
            out[_runs(first[chained], counts[chained])] = ids
        return out, counts

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, each text's followed by ``end``; where each text's begin, and their end)."""
        joined = Joined(texts)
        ends = unit_ends(joined)
        offsets = np.r_[0, ends].astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(joined.data)])
        coded = units.dictionary_encode()
        ids, counts = self._of_units(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy()
        held = counts[code]
        flat = ids[_runs((np.cumsum(counts) - counts)[code], held)]
        upto = np.r_[0, np.cumsum(held)][np.searchsorted(ends, joined.end, side="right")]
        stop = upto + np.arange(1, len(texts) + 1)
        out = np.full(len(flat) + len(texts), end, np.uint32)
        inside = np.ones(len(out), bool)
        inside[stop - 1] = False
        out[inside] = flat
        return out, np.r_[0, stop]


def _runs(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for as many as counted, then those of first[1], ..."""
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


@lru_cache(maxsize=2)
def _encoder(ranks: bytes) -> Encoder:
    return Encoder(ranks)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(batches: Iterator[pa.RecordBatch], ranks: bytes, size: int, width: int, end: int) -> Iterator[pa.RecordBatch]:
    """Whole sequences (class 0) and rests of each text, numbered within class and task."""
    classes = -(-size // width) + 1
    seen, tokens = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    part = TaskContext.get().partitionId()
    for batch, texts in slices(batches, most=CHUNK):
        ids, at = _encoder(ranks).encode(texts, end)
        n = np.diff(at)
        k = -(-n // size)
        doc = np.repeat(np.arange(len(texts)), k)
        start = _runs(np.zeros(len(texts), np.int64), k) * size
        length = np.minimum(n[doc] - start, size)
        begin = at[doc] + start
        crc = [_crc(ids[a : a + m]) for a, m in zip(begin.tolist(), length.tolist())]
        kind = np.where(length == size, 0, -(-length // width))
        # Numbers and sums within each class go on from what the task has seen.
        order = np.argsort(kind, kind="stable")
        of, own = kind[order], length[order]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        group = np.repeat(first, np.diff(np.r_[first, len(of)]))
        upto = np.cumsum(own) - own
        nth, before = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
        nth[order] = np.arange(len(of)) - group + seen[of]
        before[order] = upto - upto[group] + tokens[of]
        seen += np.bincount(kind, minlength=classes)
        tokens += np.bincount(kind, length, minlength=classes).astype(np.int64)
        rid = batch["rid"].to_numpy()[doc]
        columns = [np.full(len(doc), part, np.int32), rid, start, length, np.array(crc, np.int64), n[doc], kind.astype(np.int32), nth, before]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in PIECE.split(", ")])


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank in their class and the tokens of the class before them."""
    held = pieces.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("m"))
    earlier = "over (partition by class order by part rows between unbounded preceding and 1 preceding)"
    first = held.selectExpr("class", "part", f"coalesce(sum(n) {earlier}, 0) as first_n", f"coalesce(sum(m) {earlier}, 0) as first_m")
    return pieces.join(first, ["class", "part"]).selectExpr("rid", "start", "length", "crc", "doc_tokens", "class", "nth + first_n as rank", "before + first_m as before")


@dataclass(frozen=True)
class Plan:
    """Where a piece goes, from its class, its rank there and the tokens before it."""

    plan: list[Pattern]
    #: Of each class: rank of the first piece that is laid end to end, and tokens to be added to its sum.
    taken: np.ndarray
    shift: np.ndarray
    #: Tokens laid end to end, and the sequence the first of them begin.
    loose: int
    first_loose: int
    size: int

    def cuts(self) -> np.ndarray:
        """Ends of the last loose sequences: what does not fill one is cut at powers of two."""
        whole = self.loose // self.size * self.size
        bits = [1 << b for b in range(self.size.bit_length(), -1, -1) if self.loose - whole >> b & 1]
        return whole + np.cumsum([0, *bits])

    def sequence_of(self, kind: int, rank: np.ndarray) -> np.ndarray:
        """Sequences of pieces of one class that patterns take."""
        ends, begin, each, upto, sequence = [], [], [], 0, 0
        for p in self.plan:
            if kind in p.counts:
                upto += p.times * p.counts[kind]
                ends.append(upto)
                begin.append(sequence)
                each.append(p.counts[kind])
            sequence += p.times
        i = np.searchsorted(ends, rank, side="right")
        before = np.r_[0, ends][i]
        return np.array(begin)[i] + (rank - before) // np.array(each)[i]

    def assign(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """(rid, start, length, crc, doc_tokens, rank, class, sequence_id, offset, cut): the offset is null where a pattern tells the sequence."""
        kind, rank, before, length = (batch[c].to_numpy() for c in ("class", "rank", "before", "length"))
        ends = self.cuts()
        whole = self.loose // self.size
        sequence, offset, fixed = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64), rank >= self.taken[kind]
        full = kind == 0
        sequence[full] = self.first_loose + whole + len(ends) - 1 + rank[full]
        for k in np.unique(kind[~fixed & ~full]).tolist():
            own = (kind == k) & ~fixed
            sequence[own] = self.sequence_of(k, rank[own])
        fixed |= full
        loose = np.flatnonzero(fixed & ~full)
        at = before[loose] + self.shift[kind[loose]]
        # Pieces of a loose run: cut at each multiple of the size, and at the last ends.
        row, begin, stop = [], [], []
        for i, a, b in zip(loose.tolist(), at.tolist(), (at + length[loose]).tolist()):
            inner = [*range((a // self.size + 1) * self.size, min(b, int(ends[0]) + 1), self.size), *ends[(ends > max(a, ends[0])) & (ends < b)].tolist()]
            edges = [a, *[e for e in inner if e < b], b]
            row += [i] * (len(edges) - 1)
            begin += edges[:-1]
            stop += edges[1:]
        index = np.r_[np.flatnonzero(~fixed | full), np.array(row, np.int64)]
        begin, stop = np.array(begin, np.int64), np.array(stop, np.int64)
        n = len(index) - len(row)
        out = {c: batch[c].to_numpy()[index] for c in ("rid", "start", "length", "crc", "doc_tokens", "rank", "class")}
        out["sequence_id"], out["offset"] = sequence[index], offset[index]
        last = np.searchsorted(ends, begin, side="right") - 1
        tail = begin >= ends[0]
        out["sequence_id"][n:] = self.first_loose + np.where(tail, whole + last, begin // self.size)
        out["offset"][n:] = np.where(tail, begin - ends[np.maximum(last, 0)], begin % self.size)
        of = np.array(row, np.int64)
        origin = (before + self.shift[kind])[of]
        cut = np.zeros(len(index), bool)
        cut[n:] = stop - begin < length[of]
        out["start"][n:] += begin - origin
        out["length"][n:] = stop - begin
        free = np.r_[~fixed[index[:n]], np.zeros(len(row), bool)]
        columns = [pa.array(x, mask=free) if c == "offset" else pa.array(x) for c, x in out.items()]
        return pa.RecordBatch.from_arrays([*columns, pa.array(cut)], [*out, "cut"])


ASSIGNED = "rid long, start long, length long, crc long, doc_tokens long, rank long, class int, sequence_id long, offset long, cut boolean"


def _planned(placed: DataFrame, size: int, width: int, waste: float) -> Plan:
    """The plan from the histogram: one row per class reaches the driver, twice."""
    classes = -(-size // width) + 1
    counts, tokens = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for r in placed.where("class > 0").groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("m")).collect():
        counts[r["class"]], tokens[r["class"]] = r.n, r.m
    plan = patterns(np.arange(classes), counts, size // width, 1 - waste)
    taken = np.zeros(classes, np.int64)
    for p in plan:
        for c, a in p.counts.items():
            taken[c] += p.times * a
    # Tokens of each class before its first loose piece.
    edge = F.element_at(F.array(*[F.lit(int(t)) for t in taken]), F.col("class") + 1)
    inside = tokens.copy()
    for r in placed.where((F.col("class") > 0) & (F.col("rank") == edge)).select("class", "before").collect():
        inside[r["class"]] = r.before
    loose = tokens - inside
    return Plan(plan, taken, np.cumsum(loose) - loose - inside, int(loose.sum()), sum(p.times for p in plan), size)


def _crcs(batches: Iterator[pa.RecordBatch], ranks: bytes, end: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, most=CHUNK):
        ids, at = _encoder(ranks).encode(texts, end)
        rows = []
        for first, cuts in zip(at.tolist(), batch["cuts"].to_pylist()):
            rows += [{**c, "crc": _crc(ids[first + c["start"] : first + c["start"] + c["length"]])} for c in cuts]
        rids = np.repeat(batch["rid"].to_numpy(), pc.list_value_length(batch["cuts"]).to_numpy())
        fields = ("start", "length", "crc", "doc_tokens", "sequence_id", "offset")
        yield pa.RecordBatch.from_arrays([pa.array(rids), *[pa.array([r[f] for r in rows], pa.int64()) for f in fields]], ["rid", *fields])


def packed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, width: int = WIDTH, waste: float = WASTE, end: int = END, path: str = RANKS
) -> DataFrame:
    """One row per piece: the id, ``start`` (tokens of the document before it), ``length``,
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit numbers), ``doc_tokens``,
    ``sequence_id`` and ``offset`` there.

    A document's ids are those of its text and ``end``; null and empty texts have only that.
    Sequences hold at most ``size`` tokens (a multiple of ``width``); each but the last ones, at
    powers of two, is filled but for at most ``waste`` and less than ``width`` a piece.  Ids may
    be null or repeat: rows are told apart by their number.  An empty table gives no rows, other
    columns are not read.  A task holds one chunk of texts, or one longer text, at a time.
    """
    with open(path, "rb") as f:  # on the driver; its size is fixed
        ranks = f.read()
    own = numbered(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    pieces = durable(own.select("rid", "text").mapInArrow(lambda b: _cut(b, ranks, size, width, end), PIECE))
    placed = durable(_placed(pieces))
    plan = _planned(placed, size, width, waste)
    assigned = durable(placed.mapInArrow(lambda batches: (plan.assign(b) for b in batches), ASSIGNED))
    held = ["rid", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]
    filled = assigned.where("offset is null").withColumn("offset", F.expr("coalesce(sum(length) over (partition by sequence_id order by class desc, rank rows between unbounded preceding and 1 preceding), 0)"))
    known = assigned.where("offset is not null and not cut")
    cuts = durable(assigned.where("cut").groupBy("rid").agg(F.collect_list(F.struct("start", "length", "doc_tokens", "sequence_id", "offset")).alias("cuts")))
    again = sized_join(own.select("rid", "text"), cuts, ["rid"], "inner", ["rid"], is_small(cuts)).mapInArrow(
        lambda b: _crcs(b, ranks, end), "rid long, start long, length long, crc long, doc_tokens long, sequence_id long, offset long"
    )
    every = filled.select(held).unionAll(known.select(held)).unionAll(again.select(held))
    return own.select("rid", F.col("id").alias(id_column)).join(every, "rid").drop("rid").withColumnRenamed("crc", "ids_crc32")


def _pieces_ids(batches: Iterator[pa.RecordBatch], ranks: bytes, end: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, most=CHUNK):
        ids, at = _encoder(ranks).encode(texts, end)
        sequence, offset, own = [], [], []
        for first, places in zip(at.tolist(), batch["places"].to_pylist()):
            for p in places:
                sequence.append(p["sequence_id"])
                offset.append(p["offset"])
                own.append(ids[first + p["start"] : first + p["start"] + p["length"]])
        yield pa.RecordBatch.from_arrays([pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), pa.array(own, pa.list_(pa.int32()))], ["sequence_id", "offset", "ids"])


def sequences(docs: DataFrame, pieces: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, end: int = END, pad: int = END, path: str = RANKS) -> DataFrame:
    """(sequence_id, ids) of the pieces that ``packed`` gave for these documents (ids distinct, not
    null): ids in order, padded to ``size`` but for lengths at a power of two."""
    with open(path, "rb") as f:
        ranks = f.read()
    places = pieces.groupBy(id_column).agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("places"))
    parts = docs.select(id_column, F.col(text_column).alias("text")).join(places, id_column).mapInArrow(lambda b: _pieces_ids(b, ranks, end), "sequence_id long, offset long, ids array<int>")
    whole = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    ids = F.flatten(F.col("own.ids"))
    n = F.size(ids)
    return whole.select("sequence_id", F.when(n.bitwiseAND(n - 1) == 0, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad), F.lit(size) - n))).alias("ids"))
