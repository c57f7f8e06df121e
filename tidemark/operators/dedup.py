"""Batch snapshots and best-row-per-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_batch(bronze: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Rows of the newest batch.

    A caller that knows the batch id gets plain partition pruning; otherwise the
    newest ingest time is found first, by a scalar subquery over that one column.
    """
    if batch_id is not None:
        return bronze.filter(F.col("_batch_id") == batch_id)
    newest = bronze.agg(F.max("_ingested_at")).scalar()
    return bronze.filter(F.col("_ingested_at") == newest)


def keep_best(df: DataFrame, key: Sequence[str | Column], best_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark limits each key to its best row before the shuffle (WindowGroupLimit), so
    a key holding a large share of the rows sends one row per map task.
    """
    order = Window.partitionBy(*key).orderBy(*best_first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def newest_bronze_row() -> list[Column]:
    return [F.col("_bronze_id").desc()]
