"""Surrogate keys that never sort a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import new_folder

MOST_DIGITS = 4  # 65,536 buckets: the bound of the offsets that are broadcast


def key_bucket(columns: list[str], digits: int = 3) -> Column:
    """Evenly spread bucket name, ``16**digits`` in all, from the row's key text."""
    return F.expr(f"substring(md5(concat_ws('|', {', '.join(columns)})), 1, {digits})")


def dense_keys(
    df: DataFrame,
    name: str,
    key: list[str],
    after: DataFrame | None = None,
    digits: int = 3,
) -> DataFrame:
    """Prepend gap-free LONG keys 1..n, ordered by (bucket, key).

    Two phases: rows are numbered within their hash bucket and stored, then each
    bucket is shifted by the row count of the buckets before it. So the input is
    computed once, no task sees more than one bucket, and a lost task renumbers nothing. The
    counts are read from the stored bucket column; there are at most ``16**digits``,
    hence the broadcast. Rows equal in ``key`` share a bucket, so the key must identify a
    row. ``after`` continues the numbering of an existing table.

    The stored rows lie in the shared folder; ``scratch`` of the result names it, for callers
    that store the result and want to clear it.
    """
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must be 1 to {MOST_DIGITS}")
    spark, path = df.sparkSession, new_folder(df.sparkSession, f"numbered-{name}")
    bucketed = df.withColumn("_bucket", key_bucket(key, digits))
    within = Window.partitionBy("_bucket").orderBy(*key)
    numbered = bucketed.withColumn("_nth", F.row_number().over(within).cast("long"))
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.col("_nth") + F.col("_offset")
    if after is not None:
        number = number + after.agg(F.coalesce(F.max(name), F.lit(0)).cast("long")).scalar()
    others = [column for column in df.columns if column != name]
    result = stored.join(F.broadcast(offsets), "_bucket").select(number.alias(name), *others)
    result.scratch = path
    return result
