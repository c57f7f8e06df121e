"""Bronze: raw rows as text with lineage, append-only and partitioned by batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.keys import dense_keys
from tidemark.schemas import BATCH
from tidemark.sources.tables import absent_from, if_stored


def to_bronze(df: DataFrame, source: str, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Every source column as text (NULL stays NULL) behind the three lineage columns."""
    text = df.selectExpr(*[f"CAST(`{name}` AS STRING) AS `{name}`" for name in df.columns])
    return text.select(
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(source).alias("_source_table"),
        F.lit(batch_id).alias("_batch_id"),
        "*",
    )


def with_bronze_id(
    df: DataFrame, key: Sequence[str] | None = None, start: int = 0, digits: int = 3
) -> DataFrame:
    """Prepend the surrogate ``_bronze_id``.

    Without a key: unique arrival-ordered ids with gaps, no shuffle; ``start`` is
    the highest id stored so far. With a (nearly) unique key: reproducible ids
    without gaps, numbered per hash bucket.
    """
    if key is None:
        number = F.monotonically_increasing_id() + F.lit(start + 1)
        return df.select(number.alias("_bronze_id"), "*")
    return dense_keys(df, "_bronze_id", list(key), digits=digits)


def replace_batch(df: DataFrame, path: str) -> None:
    """Append batches to a stored table; a batch already there is replaced, not doubled."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_batch_id")
        .parquet(path, compression="zstd")
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Stored batches, the batch id read as the text it is.

    Spark guesses the types of partition folders: ids such as 00012345, 12E45678 or
    1234567D would become other values, so the id's type is declared before reading.
    """
    found = spark.read.parquet(path).schema
    declared = StructType(
        [StructField(f.name, StringType()) if f.name == "_batch_id" else f for f in found]
    )
    return spark.read.schema(declared).parquet(path)


def batch_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed batch: id, ingest time, rows and highest ``_bronze_id``.

    Kept in a folder that readers of the table skip, so that neither the next free
    id nor the newest batch needs a scan of Bronze.
    """
    found = if_stored(lambda: spark.read.schema(BATCH).parquet(f"{path}/_batches/*"))
    return spark.createDataFrame([], BATCH) if found is None else found


def newest_batch(spark: SparkSession, path: str) -> str | None:
    """Id of the batch ingested last that holds rows."""
    filled = batch_catalog(spark, path).filter("row_count > 0")
    return filled.agg(F.max_by("batch_id", "ingested_at")).first()[0]


def snapshot_batch(spark: SparkSession, path: str) -> str | None:
    """The newest batch with rows if it is a full load, so that it is a snapshot by itself."""
    filled = batch_catalog(spark, path).filter("row_count > 0")
    last = filled.agg(F.max_by(F.struct("batch_id", "is_full"), "ingested_at").alias("b")).first()["b"]
    return last["batch_id"] if last is not None and last["is_full"] else None


@dataclass(frozen=True)
class Landed:
    """What a batch holds: rows, and the newest time of its source column, if it has one."""

    rows: int
    newest: datetime | None


def land_batch(
    df: DataFrame,
    source: str,
    path: str,
    batch_id: str,
    ingested_at: datetime,
    is_full: bool = False,
) -> Landed:
    """Write one batch of a source.

    Running it again replaces what the first attempt wrote; a run without any rows
    leaves a batch that is there, and its entry, as they are. Count, highest id and
    newest time are observed while writing, not read back.
    """
    spark = df.sparkSession
    known = batch_catalog(spark, path)
    others = known.filter(F.col("batch_id") != batch_id)
    start = others.agg(F.coalesce(F.max("highest_id"), F.lit(0))).first()[0]
    seen = Observation()
    rows = with_bronze_id(to_bronze(df, source, batch_id, ingested_at), start=start)
    column = time_column(df)
    # Bronze holds the time as text; the source column's own type is read back from it.
    time = F.col(column).cast("timestamp_ntz") if column else F.lit(None).cast("timestamp_ntz")
    measures = {
        "rows": F.count("*"),
        "top": F.coalesce(F.max("_bronze_id"), F.lit(start)),
        "newest": F.max(time),
    }
    replace_batch(rows.observe(seen, *[x.alias(name) for name, x in measures.items()]), path)
    found = seen.get
    if not found["rows"]:
        before = known.filter(F.col("batch_id") == batch_id).first()
        if before is not None and before["row_count"]:
            return Landed(before["row_count"], None)
    entry = [(batch_id, ingested_at, found["rows"], found["top"], is_full)]
    catalog = spark.createDataFrame(entry, BATCH).coalesce(1)
    catalog.write.mode("overwrite").parquet(f"{path}/_batches/{batch_id}")
    return Landed(found["rows"], found["newest"])


def ingest_all(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folder: str,
    batch_id: str,
    ingested_at: datetime,
) -> DataFrame:
    """Full extract of each source into ``folder/<table>``; returns the batch summary.

    Each table is its own Spark job; the loop runs over tables, never over rows.
    A rerun of the batch replaces what its first attempt wrote. The summary reads
    the batch catalogs, not Bronze.
    """
    summaries = []
    for source, df in sources.items():
        path = f"{folder}/{source.split('.')[-1]}"
        land_batch(df, source, path, batch_id, ingested_at, is_full=True)
        batches = batch_catalog(spark, path).selectExpr(
            f"'{source}' AS _source_table",
            "batch_id AS _batch_id",
            "row_count AS batch_rows",
            "sum(row_count) OVER () AS total_rows",
        )
        summaries.append(batches.filter(F.col("_batch_id") == batch_id))
    return reduce(DataFrame.unionByName, summaries)


def batch_summary(bronze: DataFrame) -> DataFrame:
    """Rows per batch beside the table's running total over all batches."""
    per_table = Window.partitionBy("_source_table")
    return (
        bronze.groupBy("_source_table", "_batch_id")
        .agg(F.count("*").alias("batch_rows"))
        .withColumn("total_rows", F.sum("batch_rows").over(per_table))
    )


# The columns that may carry a row's change time, best first.
TIME_COLUMNS = ("updated_at", "created_at")


def time_column(df: DataFrame, candidates: Sequence[str] = TIME_COLUMNS) -> str | None:
    """The first candidate the source has as a date or time; text dates may be dirty."""
    kinds = dict(df.dtypes)
    timed = (name for name in candidates if kinds.get(name, "").startswith(("timestamp", "date")))
    return next(timed, None)


def incremental(
    df: DataFrame,
    watermark: datetime | Column | None,
    ts_candidates: Sequence[str] = TIME_COLUMNS,
) -> DataFrame:
    """Rows newer than the watermark by the source's time column; all rows without either.

    A row stamped exactly at the watermark was part of the earlier load.
    """
    ts = time_column(df, ts_candidates)
    if ts is None or watermark is None:
        return df
    return df.filter(F.col(ts) > watermark)


def row_digest(df: DataFrame) -> Column:
    """Digest of a row's text columns, nulls told from empty texts; lineage columns left out."""
    names = [name for name in df.columns if not name.startswith("_")]
    return F.md5(F.to_json(F.struct(*[F.col(f"`{x}`").cast("string").alias(x) for x in names]), {"ignoreNullFields": "false"}))


def incremental_overlap(
    df: DataFrame,
    watermark: datetime | None,
    landed: DataFrame | None,
    overlap: timedelta,
    ts_candidates: Sequence[str] = TIME_COLUMNS,
) -> DataFrame:
    """Rows newer than the watermark, and those of the span below it that have not landed.

    A transaction may commit after a load and yet carry an older time. Rows up to ``overlap``
    below the watermark are read again, and those that ``landed`` (stored Bronze) holds
    with the same content, key included, are left out. So a row that comes late by less
    than the span is loaded once, and one that changed under its old time is loaded as
    changed. Both sides are cut to the span before they meet; in the join only digests of
    the landed rows move.
    """
    ts = time_column(df, ts_candidates)
    if ts is None or watermark is None:
        return df
    since = F.lit(watermark - overlap)
    wanted = df.filter(F.col(ts) > since)
    if landed is None:
        return wanted
    kind = df.schema[ts].dataType.simpleString()
    known = landed.filter(F.expr(f"try_cast(`{ts}` AS {kind})") > since).select(*df.columns)
    marked = wanted.withColumn("_digest", row_digest(wanted))
    return absent_from(marked, known.select(row_digest(known).alias("_digest")), ["_digest"]).select(*df.columns)


def rollback_batch(bronze: DataFrame, batch_id: str) -> DataFrame:
    """Bronze as if the batch had not been loaded."""
    return bronze.filter(F.col("_batch_id") != batch_id)


def drop_batch(spark: SparkSession, path: str, batch_id: str) -> None:
    """Remove a batch from stored Bronze: its partition folder and its catalog entry."""
    for name in (f"_batch_id={batch_id}", f"_batches/{batch_id}"):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder, True)
