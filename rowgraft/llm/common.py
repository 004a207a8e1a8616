"""Helpers the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgraft.operators.skew import ensure_checkpoint_dir

__all__ = [
    "NOT_BLANK", "WORD", "Joined", "crc_of", "documents", "durable", "free_name", "numbered", "passing", "pieces_of", "slices", "table", "text_bytes", "unit_ends", "words_of", "written",
]

#: Bytes of text that a task turns into arrays at a time.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the frame has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str = "rid") -> DataFrame:
    """The frame with a number per row that stays the same whenever the frame is read again.

    The frame must give its rows in the same partitions and order each time, as a scan of
    files does; anything else is to be written with ``durable`` first.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def crc_of(column: str) -> Column:
    """crc32 of the value as text; null counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8"))


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, null as the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


class Joined:
    """Texts laid end to end in one array, text i at ``start[i]:end[i]``."""

    def __init__(self, texts: list[bytes]):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.data = b"".join(texts)
        self.bytes = np.frombuffer(self.data, np.uint8)


def pieces_of(texts: list, size=len, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts that hold about ``most`` bytes; a longer one stands alone."""
    first, held = 0, 0
    for i, x in enumerate(texts):
        if held and held + size(x) > most:
            yield first, i
            first, held = i, 0
        held += size(x)
    if first < len(texts):
        yield first, len(texts)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches cut so that each holds about ``most`` bytes of text, with the texts."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
        for a, b in pieces_of(size, size=int, most=most):
            part = batch.slice(a, b - a)
            yield part, text_bytes(part[column])


#: Lets Spark delete the shuffle files of a query when it ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the tables that go with the innermost ``passing`` block.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def durable(df: DataFrame) -> DataFrame:
    """The frame as a table in the session's checkpoint folder (see ``operators.skew.durable``)."""
    return _table(df, None, _passing.get())


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The frame as a table in the session's checkpoint folder, packed harder than ``durable``'s."""
    return _table(df, codec, _passing.get())


def _table(df: DataFrame, codec: str | None, block: list[str] | None) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    if block is not None:
        block.append(path)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose tables (``durable``, ``written``) are deleted at its end, and the shuffle files of
    its queries when each of them ends: what is on the disk at once is one step, not all of them.

    It gives a function that writes a table which stays: to the end of the block around this one,
    or for good.  Frames made in the block must be written by it before they are used outside.
    """
    outer, own, before = _passing.get(), [], spark.conf.get(FREE_SHUFFLES, None)
    here = _passing.set(own)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield lambda df: _table(df, "zstd", outer)
    finally:
        _passing.reset(here)
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
        context = spark.sparkContext
        for path in map(context._jvm.org.apache.hadoop.fs.Path, own):
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of words: all but ASCII white space; ASCII letters and digits and all beyond ASCII.
NOT_BLANK = np.array([i not in (0x20, *range(0x09, 0x0E)) for i in range(256)])
WORD = np.array([0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 for i in range(256)])


def words_of(texts: list[bytes], inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of the texts with A-Z lowered (runs of bytes that are ``inside``), in order, and
    their number per text.  Nothing is done word by word."""
    joined = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    within = inside[joined]
    turns = np.flatnonzero(np.diff(within, prepend=False, append=False)).reshape(-1, 2)
    offsets = np.zeros(len(turns) + 1, np.int32)
    np.cumsum(turns[:, 1] - turns[:, 0], out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(turns), [None, pa.py_buffer(offsets), pa.py_buffer(joined[within])])
    begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return words, np.diff(np.searchsorted(turns[:, 0], begin))


def unit_ends(joined: Joined) -> np.ndarray:
    """Where the units of the joined texts end, in order: a unit is a word with the blanks before
    it, or what blanks a text ends with.  No unit goes over the end of its text."""
    inside = NOT_BLANK[joined.bytes]
    last = np.zeros(len(inside) + 1, bool)
    last[1:][inside] = True
    last[1:-1] &= ~inside[1:]
    last[joined.end] = True
    last[0] = False
    return np.flatnonzero(last)
