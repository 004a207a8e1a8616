"""Sampled segmentations of texts into SentencePiece ids, and their decoding.

Forward filtering sums all segmentations of every distinct segment; backward sampling then
walks each occurrence from its end, drawing the last piece by its share of the sum.  The
draws are a hash of (seed, row key, place in the text), so a row always gets the same ids,
wherever and however often it is run.  Bytes without a piece have ids of their own, so
decoding gives back exactly the text that was encoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.llm.common import free_name, slices
from rowgraft.llm.lattice import CHUNK, MODEL, Lattice, Segments, Vocabulary, load_vocabulary, zipf

SEED = 7
#: Sharpens (over 1) or flattens (under 1) the distribution over segmentations.
ALPHA = 1.0


STEP = np.uint64(0x9E3779B97F4A7C15)


def _draws(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1), each a hash of x."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53


def sample(texts: list[bytes], keys: np.ndarray, vocabulary: Vocabulary, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, their number per text)."""
    cut = Segments(texts)
    lattice, weight = Lattice(vocabulary, cut.distinct), alpha * zipf(vocabulary)
    reach = lattice.forward(weight[None])[0]
    share = np.cumsum(np.exp(reach[lattice.start] + weight[lattice.piece] - reach[lattice.end]))
    high = np.cumsum(np.bincount(lattice.end, minlength=lattice.nodes)) - 1
    low = np.r_[0, high[:-1] + 1]
    found = np.full(len(cut.data), -1, np.int32)
    node, begin = lattice.last[cut.code], lattice.base[cut.code]
    # The place of a node in the chunk is node + shift, and its draw is the hash of node * STEP + key.
    shift = cut.start - begin
    key = keys[cut.text] + (shift - cut.text_start[cut.text]).astype(np.uint64) * STEP
    while len(node):
        a, b = low[node], high[node]
        before = np.where(a > 0, share[a - 1], 0.0)
        aim = before + _draws(key + node.astype(np.uint64) * STEP) * (share[b] - before)
        arc = a
        todo = np.flatnonzero((share[a] <= aim) & (a < b))
        while len(todo):
            arc[todo] += 1
            at = arc[todo]
            todo = todo[(share[at] <= aim[todo]) & (at < b[todo])]
        node = lattice.start[arc].astype(np.int64)
        found[node + shift] = lattice.piece[arc]
        more = node > begin
        node, begin, shift, key = node[more], begin[more], shift[more], key[more]
    chosen = found >= 0
    return found[chosen], np.add.reduceat(chosen, cut.text_start, dtype=np.int64)


def encoded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED, alpha: float = ALPHA, model: str = MODEL) -> DataFrame:
    """Every row with ``pieces``, a sampled segmentation of its text as ids.

    A null text has null pieces, an empty one none.  The row key is the id as text (null: the
    empty text), so rows that agree in id and text agree in pieces.  Rows do not influence
    each other.  A column of ``docs`` named pieces keeps it; the new one gets an underscore.
    """
    vocabulary, name = load_vocabulary(model), free_name(docs, "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_column, CHUNK):
            keys = np.array([xxhash.xxh64_intdigest("" if i is None else str(i), seed) for i in batch[id_column].to_pylist()], np.uint64)
            at = [i for i, t in enumerate(texts) if t]
            n, ids = np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
            if at:
                ids, n[at] = sample([texts[i] for i in at], keys[at], vocabulary, alpha)
            empty = batch[text_column].is_null()
            pieces = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(ids, pa.int32()), mask=empty)
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], [*batch.schema.names, name])

    return docs.mapInArrow(run, docs.select("*", F.lit(None).cast("array<int>").alias(name)).schema)


def decoded(rows: DataFrame, pieces_column: str = "pieces", model: str = MODEL) -> DataFrame:
    """Every row with ``decoded``, the bytes its pieces stand for (null pieces: null)."""
    table, name = load_vocabulary(model).bytes_of, free_name(rows, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if p is None else b"".join([table[i] for i in p.tolist()])[1:] for p in _lists(batch[pieces_column])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, name])

    return rows.mapInArrow(run, rows.select("*", F.lit(None).cast("binary").alias(name)).schema)


def _lists(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for i, given in enumerate(column.is_valid().to_pylist()):
        yield values[offsets[i] : offsets[i + 1]] if given else None
