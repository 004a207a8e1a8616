"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast when it has at most this many rows and bytes of text.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A key is heavy when it holds more than one part in HEAVY_SLOTS of the rows, so there
# are fewer than HEAVY_SLOTS heavy keys whatever the data looks like.
HEAVY_SLOTS = 256
SALTS = 64
# Rows of a task that are sorted in memory.
TASK_ROWS = 250_000


# Tables in between and parts of graphs are packed by this.
CODEC = "zstd"
# Tables in between are read once or twice: packed fast rather than hard.
FAST = {"compression": CODEC, "parquet.compression.codec.zstd.level": "1"}
# Lets Spark delete the shuffle files of a query when it ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Joins on more keys take rows as they were dealt by some of them.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def durable(df: DataFrame) -> DataFrame:
    """The frame as a table in the session's checkpoint folder: it outlives executors, cuts
    the lineage and can be read by column."""
    return _table(df)[0]


def _table(df: DataFrame) -> tuple[DataFrame, str]:
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.options(**FAST).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the session's own."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """A block with other settings; ``values`` by the names of this module."""
    names = {globals()[k]: v for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class Steps:
    """A job in steps, so that the disk holds one of them at a time: each ends with a table, its
    shuffle files go when it is written, and so do the tables that no later step reads."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._written: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, *last_read: DataFrame) -> DataFrame:
        """The frame as a table; of the tables written before, those ``last_read`` by it go."""
        with settings(self._spark, FREE_SHUFFLES="true", ALL_KEYS="false"):
            table, path = _table(df)
        self.drop(*last_read)
        self._written.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables of former steps; no frame that reads them may be used any more."""
        gone = [any(table is t for t in tables) for table, _ in self._written]
        for (_, path), goes in zip(self._written, gone):
            if goes:
                discard(self._spark, path)
        self._written = [held for held, goes in zip(self._written, gone) if not goes]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the session names; only a local session may fall back to its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        named = tempfile.mkdtemp(prefix="rowgraft-checkpoint-")
    context.setCheckpointDir(named)


def dealt(df: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """The frame, which is read from tables, dealt by its keys, so that no task sorts more rows than fit."""
    rows = df.count() if rows is None else rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, rows // TASK_ROWS + 1), *keys)


def measured(df: DataFrame, most: int = BROADCAST_ROWS) -> tuple[int, int]:
    """Rows and bytes of text, measured no further than one row past ``most``."""
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, total = df.limit(most + 1).select(size.alias("b")).agg(F.count(F.lit(1)), F.sum("b")).first()
    return rows, total or 0


def is_small(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame may be broadcast."""
    rows, total = measured(df, most)
    return rows <= most and total <= most_bytes


def heavy_keys(df: DataFrame, keys: list[str], slots: int = HEAVY_SLOTS) -> DataFrame:
    """Keys that hold more than 1/slots of the rows: fewer than ``slots`` rows.

    Counts are combined before the shuffle, so a heavy key travels as one row per task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    share = counts.agg((F.sum("__n") / slots).alias("s")).scalar()
    return counts.where(F.col("__n") > share).select(*keys)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[str],
    salts: int = SALTS,
) -> DataFrame:
    """An equi join (inner, left, left_semi, left_anti) whose heavy left keys are spread
    over ``salts`` tasks by the columns ``spread_by``; right rows of those keys are copied
    to each of them.  Other keys are joined as usual."""
    heavy = F.broadcast(heavy_keys(left, keys).withColumn("__heavy", F.lit(True)))
    slot = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    spread_left = (
        left.join(heavy, keys, "left")
        .withColumn("__salt", F.when(F.col("__heavy") | missing, slot).otherwise(F.lit(0)))
        .drop("__heavy")
    )
    copies = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread_right = right.join(heavy, keys, "left").withColumn("__salt", F.explode(copies)).drop("__heavy")
    return spread_left.join(spread_right, keys + ["__salt"], how).drop("__salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[str],
    most: int = BROADCAST_ROWS,
) -> DataFrame:
    """Joins a row-sized frame with a usually small one: broadcast when its counted size
    allows, otherwise a salted join."""
    return sized_join(left, right, keys, how, spread_by, is_small(right, most))


def sized_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, spread_by: list[str], small: bool
) -> DataFrame:
    """The same for a right side that has been measured already."""
    if small:
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how, spread_by)
