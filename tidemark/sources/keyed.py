"""Stored tables with one row per key, brought up to date by touching only what changes.

A keyed table is partitioned by a hash bucket of its key. A merge reads and rewrites the
buckets that the incoming keys fall into, and no other. Each row carries a sequence:
of two rows of a key the one with the higher sequence stays, so merging the same rows again,
or older ones, changes nothing. A deleted key stays behind as a tombstone with its
sequence, so that an older event that arrives later does not bring it back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_best
from tidemark.sources.tables import delete_path, folders, if_stored, path_exists, rename_path

BUCKETS = 64
PARTS = 4  # tasks that may share a bucket
BUCKET, SEQUENCE, DELETED = "_bucket", "_sequence", "_deleted"


def bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def read_keyed(spark: SparkSession, path: str, deleted: bool = False) -> DataFrame | None:
    """The stored rows, without tombstones unless asked for; None if there is no table yet."""
    found = if_stored(lambda: spark.read.parquet(path))
    if found is None or deleted:
        return found
    return found.filter(f"NOT {DELETED}").drop(BUCKET, SEQUENCE, DELETED)


def rows_of_buckets(stored: DataFrame, touched: Sequence[int]) -> DataFrame:
    """Rows of some buckets; a list of values, so that the scan opens their folders only."""
    return stored.filter(F.col(BUCKET).isin(list(touched))) if touched else stored.limit(0)


def merge_keyed(
    incoming: DataFrame,
    path: str,
    key: Sequence[str],
    token: str,
    buckets: int = BUCKETS,
    replaced: Column | None = None,
    by: Sequence[str] | None = None,
) -> None:
    """Bring a stored table up to ``incoming``, which has a ``_sequence`` and may have ``_deleted``.

    ``token`` names the merge, such as a batch or epoch. The new content of the touched
    buckets is written to a folder of that token first; then each bucket's folder takes the
    place of the old one by renaming. If a merge is interrupted while it replaces buckets, calling
    it again with its token takes the folders that are left, so nothing is lost; if it was
    complete, the sequences leave the table as it is. One merge runs at a time. At equal
    sequence the incoming row stays, and of several incoming ones one that is not deleted. Stored
    rows that meet ``replaced`` go first, whatever their sequence; their keys must be among the
    incoming ones, if only as deleted.

    ``incoming`` is computed twice, its keys alone for the buckets they touch and then its rows: callers
    store what is dear to compute, and reduce keys that come very often, such as in change events. Rows
    move in one shuffle, by bucket and a part of its keys.
    ``buckets`` is fixed by the first merge, as is ``by``: other columns that choose the bucket,
    which a key never changes. Rows with a null key component have no
    identity and are refused. Only the bucket numbers, at most ``buckets``, reach the driver.
    """
    spark = incoming.sparkSession
    staged = f"{path}/_merges/{token}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        rows = incoming if DELETED in incoming.columns else incoming.withColumn(DELETED, F.lit(False))
        placed = bucketed(rows, by or key, buckets)
        missing = F.expr(" OR ".join(f"{name} IS NULL" for name in key))
        found = placed.groupBy(BUCKET).agg(F.max(missing).alias("missing")).collect()
        if any(row["missing"] for row in found):
            raise ValueError(f"rows without {', '.join(key)} cannot be merged")
        merged = placed.withColumn("_stored", F.lit(0))
        stored = if_stored(lambda: spark.read.parquet(path))
        if stored is not None:
            old = rows_of_buckets(stored, sorted(row[BUCKET] for row in found))
            if replaced is not None:
                old = old.filter(~F.coalesce(replaced, F.lit(False)))
            merged = merged.unionByName(old.withColumn("_stored", F.lit(1)), allowMissingColumns=True)
        # One shuffle serves the choice of the newest row and the files of each bucket.
        part = F.pmod(F.xxhash64(F.lit(PARTS), *key), F.lit(PARTS))
        merged = merged.withColumn("_part", part).repartition(BUCKET, "_part")
        newest_first = [F.col(SEQUENCE).desc(), "_stored", DELETED]
        newest = keep_best(merged, [BUCKET, "_part", *key], newest_first).drop("_stored", "_part")
        newest.write.mode("overwrite").partitionBy(BUCKET).parquet(staged, compression="zstd")
    if path_exists(spark, f"{staged}/{BUCKET}=*"):
        for name in folders(spark, f"{staged}/{BUCKET}=*"):
            delete_path(spark, f"{path}/{name}")
            rename_path(spark, f"{staged}/{name}", f"{path}/{name}")
        spark.catalog.refreshByPath(path)
    delete_path(spark, staged)
