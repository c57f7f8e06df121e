"""What the corpus operators share: table access, stored cuts, text rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import new_folder
from tidemark.sources.tables import read_table

# The characters that separate words, as a regex class.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder all executors share and read it back.

    Cuts the lineage: later stages, and tasks that run again after a lost executor,
    see the same rows.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing will read again."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def replacing(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with result columns; an input column of the same name gives way."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def one_per(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; each map task sends at most one row of a key.

    Spark turns the filter on the row number into a group limit before the shuffle.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", number).filter("_nth = 1").drop("_nth")
