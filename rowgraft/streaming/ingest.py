"""Continuous ingestion: an append-only source merged into the graph batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowgraft.plans.pipeline import Pipeline
from rowgraft.sources.relations import normalised


def ingest(
    stream: DataFrame,
    pipeline: Pipeline,
    mapping_ids: list[str],
    checkpoint: str,
    name: str = "ingest",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts a query that treats every micro-batch as a timestamp extract of the mappings.

    The stream's checkpoint takes the place of the stored watermark.  Each batch commits
    under its own origin, made of the id its checkpoint gives the stream, so a batch replayed
    after a failure changes nothing and streams do not take each other's batches for theirs.
    A batch with a failing mapping fails the stream and is tried again.  A merge
    rewrites the parts it touches, so choose a trigger that gives large batches; the
    default drains what is there and stops.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        rows = normalised(batch).persist()
        try:
            stream_id = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first().id
            pipeline.apply_rows(rows, mapping_ids, f"{stream_id}/{epoch}")
        finally:
            rows.unpersist()

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(apply)
        .start()
    )
