"""Change-event streams: read, route, explode, wrap and store.

All steps are stateless, so the same functions serve batch and streaming frames and
the stream's only state is its source position in the checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# The tables watched, per schema.
WATCHED = {"bronze": ("crm_cust_info", "crm_sales_details", "cdc_test")}


def change_schema(row: T.DataType) -> T.StructType:
    """A change event over rows of type ``row``: one event may carry several rows.

    Inserts and deletes fill ``values``; updates fill ``before_values`` and ``after_values``.
    """
    image = T.StructType(
        [T.StructField(name, row) for name in ("values", "before_values", "after_values")]
    )
    return T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("schema", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("rows", T.ArrayType(image)),
        ]
    )


def read_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_batch: int = 1000,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def route(df: DataFrame, allowed: Mapping[str, Sequence[str]] = WATCHED) -> DataFrame:
    """Keep events of the watched tables."""
    wanted = F.lit(False)
    for schema, tables in allowed.items():
        wanted = wanted | ((F.col("schema") == schema) & F.col("table").isin(*tables))
    return df.filter(wanted)


def explode_rows(df: DataFrame) -> DataFrame:
    """One record per changed row; ``row_no`` is its place within the event."""
    kept = [name for name in df.columns if name != "rows"]
    return df.select(*kept, F.posexplode("rows").alias("row_no", "row"))


def _json(value: str) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def envelope(df: DataFrame) -> DataFrame:
    """The outgoing record; an update's data holds its before and after images."""
    images = F.struct(
        F.col("row.before_values").alias("before"), F.col("row.after_values").alias("after")
    )
    kept = [name for name in df.columns if name not in ("row", "event_type", "schema", "table")]
    update = F.col("event_type") == "UPDATE"
    return df.withColumn("_images", images).select(
        *kept,
        "event_type",
        "schema",
        "table",
        F.current_timestamp().alias("timestamp"),
        F.when(update, _json("_images")).otherwise(_json("row.values")).alias("data"),
    )


def capture(df: DataFrame, allowed: Mapping[str, Sequence[str]] = WATCHED) -> DataFrame:
    return envelope(explode_rows(route(df, allowed)))


def write_changes(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available and stop; a restart continues after the last finished batch."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
