"""Incremental ingest as a stream: new source files become Bronze batches."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.bronze import land_batch


def stream_to_bronze(
    source: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    batch_prefix: str = "S",
    ingested_at: datetime | None = None,
) -> StreamingQuery:
    """Land each micro-batch under its own batch id.

    A micro-batch replayed after a failure has the same id and replaces its
    partition, so every source row lands once.
    """

    def land(rows: DataFrame, epoch: int) -> None:
        at = ingested_at or datetime.now(UTC).replace(tzinfo=None)
        land_batch(rows, table, path, f"{batch_prefix}{epoch:08d}", at)

    return (
        source.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
