"""High-water marks of incremental loads, and the log of their runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ETL_LOG


def loaded_marks(loaded: Mapping[str, DataFrame], ts_columns: Mapping[str, str | None]) -> DataFrame:
    """One row per table just loaded: newest source time, batch and row count.

    The mark is the newest time actually read, so rows committed while the load
    ran are picked up next time.
    """
    result = None
    for table, df in loaded.items():
        ts = ts_columns.get(table)
        time = F.col(ts) if ts else F.lit(None)
        row = df.agg(
            F.max(time.cast("timestamp_ntz")).alias("last_loaded_at"),
            F.max("_batch_id").alias("last_batch_id"),
            F.count("*").alias("last_row_count"),
        ).select(F.lit(table).alias("table_name"), "*")
        result = row if result is None else result.unionByName(row)
    return result


def read_watermarks(state: DataFrame) -> DataFrame:
    """Latest state row per table from the append-only control table."""
    newest = F.max_by(
        F.struct("last_loaded_at", "last_batch_id", "last_row_count", "updated_at"),
        # Of rows written in one instant, the one with the later mark, then the later batch.
        F.struct("updated_at", "last_loaded_at", "last_batch_id", "last_row_count"),
    )
    return state.groupBy("table_name").agg(newest.alias("s")).select("table_name", "s.*")


def advance_watermarks(state: DataFrame, loaded: DataFrame, run_at: datetime) -> DataFrame:
    """State after a load: never moves back, keeps tables that loaded nothing, adds new tables."""
    moved = F.coalesce(F.col("n.last_row_count"), F.lit(0)) > 0
    return (
        state.alias("o")
        .join(loaded.alias("n"), "table_name", "full_outer")
        .select(
            "table_name",
            F.greatest("o.last_loaded_at", "n.last_loaded_at").alias("last_loaded_at"),
            F.when(moved, F.col("n.last_batch_id"))
            .otherwise(F.col("o.last_batch_id"))
            .alias("last_batch_id"),
            F.coalesce("n.last_row_count", "o.last_row_count").alias("last_row_count"),
            F.when(F.col("n.last_row_count").isNotNull(), F.lit(run_at).cast("timestamp_ntz"))
            .otherwise(F.col("o.updated_at"))
            .alias("updated_at"),
        )
    )


def run_log(events: DataFrame) -> DataFrame:
    """Fold RUNNING / SUCCESS / ROLLED_BACK / FAILED events into one row per run.

    Aggregates with map-side combine only, so a run retried without end stays cheap.
    """
    last = F.max_by(
        F.struct("batch_id", "table_name", "status", "rows_loaded", "error_message", "event_at"),
        # RUNNING loses a tie: a run that starts and ends in one instant has ended.
        F.struct("event_at", (F.col("status") != "RUNNING").alias("ended")),
    )
    started = F.min(F.when(F.col("status") == "RUNNING", F.col("event_at")))
    ended = F.col("last.status") != "RUNNING"
    return (
        events.groupBy("log_id")
        .agg(last.alias("last"), started.alias("started_at"))
        .select(
            "log_id",
            "last.batch_id",
            "last.table_name",
            "last.status",
            F.coalesce("last.rows_loaded", F.lit(0)).alias("rows_loaded"),
            "last.error_message",
            "started_at",
            F.when(ended, F.col("last.event_at")).alias("finished_at"),
        )
        .withColumn(
            "duration_sec",
            F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("finished_at")) / 1e6,
        )
    )


@dataclass
class Step:
    """A running step of a load; its caller sets how many rows it processed."""

    rows: int | None = None


@contextmanager
def logged_step(
    spark: SparkSession, control: str, procedure: str, layer: str, clock: Callable[[], datetime]
) -> Iterator[Step]:
    """Write a step to the ETL log: STARTED before it, then COMPLETED, or FAILED and why."""
    started, step = clock(), Step()
    log_id = uuid.uuid4().int >> 65

    def write(status: str, ended: datetime | None, error: str | None) -> None:
        row = (log_id, procedure, layer, status, started, ended, step.rows, error)
        frame = spark.createDataFrame([row], ETL_LOG).coalesce(1)
        frame.write.mode("append").parquet(f"{control}/etl_log")

    write("STARTED", None, None)
    try:
        yield step
    except Exception as error:
        write("FAILED", clock(), str(error))
        raise
    write("COMPLETED", clock(), None)


def etl_log_report(log: DataFrame) -> DataFrame:
    """Procedure log with whole-second durations, newest first."""
    return log.select(
        "procedure_name",
        "layer",
        "status",
        "start_time",
        "end_time",
        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
        "rows_processed",
    ).orderBy(F.col("start_time").desc())
