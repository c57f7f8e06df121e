"""Table sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    splits: int = 1,
    **options: str,
) -> DataFrame:
    """A database table, read by ``splits`` tasks over ranges of an indexed numeric column.

    Filters put on the result, such as the incremental one, are pushed to the database.
    """
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, fetchsize="10000", pushDownPredicate="true", **options
    )
    if split_on:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=lower, upperBound=upper, numPartitions=splits
        )
    return reader.load()


def if_stored(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist; any other failure shows."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stamped(df: DataFrame, column: str, at: datetime) -> DataFrame:
    """Add a layer's processing time; kept out of the operators so that reruns compare equal."""
    return df.withColumn(column, F.lit(at).cast("timestamp_ntz"))


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full refresh of a stored table, safe to repeat; returns the stored rows.

    The new table is written beside the old one, which stays readable until the new one
    is complete and takes its place by renaming. A failed write changes nothing. Rows of a
    partitioned table are gathered per partition value first, and adaptive execution
    splits the large ones, so that tasks do not each write a file into every folder.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    spark, target = df.sparkSession, path.rstrip("/")
    recover(spark, target)
    parent, _, name = target.rpartition("/")
    mark = uuid.uuid4().hex[:12]
    # Names with a leading dot are skipped by readers of the parent folder.
    fresh, old = f"{parent}/.{name}-{mark}", f"{parent}/.{name}-{mark}-old"
    try:
        df.write.partitionBy(*partition_by).parquet(fresh)
    except Exception:
        delete_path(spark, fresh)
        raise
    had = rename_path(spark, target, old)
    rename_path(spark, fresh, target)
    if had:
        delete_path(spark, old)
    return spark.read.parquet(target)


def recover(spark: SparkSession, path: str) -> bool:
    """Put a table back whose replacement stopped between the two renames of ``overwrite``.

    Then the old table lies beside the missing one, and takes its place again; the load that
    failed is run anew. True if there was something to put back.
    """
    target = path.rstrip("/")
    parent, _, name = target.rpartition("/")
    if path_exists(spark, target):
        return False
    at, files = _file_system(spark, f"{parent}/.{name}-*-old")
    left = sorted(files.globStatus(at) or (), key=lambda found: found.getModificationTime())
    return bool(left) and rename_path(spark, left[-1].getPath().toString(), target)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path of a pattern, exists."""
    at, files = _file_system(spark, pattern)
    return bool(files.globStatus(at))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the paths that a pattern finds."""
    at, files = _file_system(spark, pattern)
    return sorted(found.getPath().getName() for found in files.globStatus(at) or ())


def delete_path(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)


def rename_path(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder; False if there is none."""
    at, files = _file_system(spark, path)
    if not files.exists(at):
        return False
    if not files.rename(at, _file_system(spark, to)[0]):
        raise OSError(f"cannot rename {path} to {to}")
    return True


def append_new(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it does not hold yet."""
    return target.unionByName(absent_from(source, target, key))


def absent_from(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks.

    Target keys are made distinct first, which shrinks a hot key to one row per map
    task. The hash beside the key makes the join shuffle anew instead of riding on
    that aggregation's partitions, which adaptive execution could not split for a
    hot source key.
    """
    known = target.select(*key).distinct().withColumn("_hash", F.xxhash64(*key))
    hashed = source.withColumn("_hash", F.xxhash64(*key))
    return hashed.join(known, [*key, "_hash"], "left_anti").select(source.columns)
