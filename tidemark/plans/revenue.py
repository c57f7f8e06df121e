"""Revenue by month and category, kept up to date batch by batch.

Three stored parts: the fact's items by order (a keyed table), per batch the change
of each (category, day) sum, and nothing else. A batch touches the buckets of its orders
only. Of these the orders' sums as they were and as they become are compared,
so an order that spans batches, changes its state or moves to another day counts once; the
differences are stored under the batch's name. The mart adds up the differences,
a row per category, day and batch, without looking at the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.marts import NOT_SOLD, by_month
from tidemark.sources.keyed import (
    BUCKET,
    BUCKETS,
    DELETED,
    SEQUENCE,
    bucketed,
    merge_keyed,
    read_keyed,
    rows_of_buckets,
)
from tidemark.sources.tables import if_stored, path_exists

SUMMED = {"qty": "quantity", "gross": "gross_amount", "discount": "discount_amount", "net": "net_amount"}
MEASURES = ("orders", *SUMMED)
# What the mart needs of a fact row.
ITEM = ("order_item_sk", "order_id", "order_date_key", "order_status", "category", *SUMMED.values())
COUNTED = f"order_status NOT IN {NOT_SOLD} AND category IS NOT NULL"


def sold_orders(items: DataFrame) -> DataFrame:
    """One row per order, category and day that counts as revenue."""
    return (
        items.filter(COUNTED)
        .groupBy("category", "order_date_key", "order_id")
        .agg(*[F.sum(column).alias(name) for name, column in SUMMED.items()])
        .withColumn("orders", F.lit(1))
    )


def add_batch(
    spark: SparkSession, path: str, facts: DataFrame, batch: str, sequence: int, buckets: int = BUCKETS
) -> None:
    """Take a batch of new or changed fact rows, with their product's category, into the stored mart.

    ``facts`` holds each order item once; ``sequence`` orders the batches. An older batch
    that arrives late changes only items without a newer row. Calling it again for
    a batch, finished or not, gives the same mart: the differences are stored before
    the items change and are taken as they are if they are complete.
    """
    items, changes = f"{path}/items", f"{path}/changes/batch={batch}"
    own = facts.select(*ITEM)
    incoming = own.withColumns({SEQUENCE: F.lit(sequence).cast("bigint"), DELETED: F.lit(False)})
    if not path_exists(spark, f"{changes}/_SUCCESS"):
        stored = read_keyed(spark, items, deleted=True)
        if stored is None:
            per_order = sold_orders(incoming)
        else:
            touched = bucketed(incoming, ["order_id"], buckets).select(BUCKET).distinct().collect()
            per_order = _changed_orders(incoming, rows_of_buckets(stored, sorted(row[0] for row in touched)))
        change = (
            per_order.groupBy("category", "order_date_key")
            .agg(*[F.sum(name).alias(name) for name in MEASURES])
            .filter(" OR ".join(f"{name} <> 0" for name in MEASURES))
        )
        change.write.mode("overwrite").parquet(changes)
    merge_keyed(incoming, items, ["order_item_sk"], f"batch-{batch}", buckets, by=["order_id"])


def _changed_orders(incoming: DataFrame, old: DataFrame) -> DataFrame:
    """What changes in the sums per order, category and day; rows without a change cancel out.

    One shuffle by order serves the choice of each item's newest row and the sums.
    """
    both = incoming.withColumn("_stored", F.lit(0)).unionByName(old.drop(BUCKET).withColumn("_stored", F.lit(1)))
    newest = Window.partitionBy("order_id", "order_item_sk").orderBy(F.col(SEQUENCE).desc(), "_stored")
    ranked = both.repartition("order_id").withColumn("_stays", (F.row_number().over(newest) == 1).cast("int"))
    sign = F.col("_stays") - F.col("_stored")

    def difference(name: str) -> Column:
        return F.sum(F.when(sign > 0, F.col(name)).when(sign < 0, -F.col(name)))

    return (
        ranked.filter(COUNTED)
        .groupBy("category", "order_date_key", "order_id")
        .agg(
            *[difference(column).alias(name) for name, column in SUMMED.items()],
            (F.max("_stays") - F.max("_stored")).alias("orders"),
            F.max(sign != 0).alias("_changed"),
        )
        .filter("_changed")
    )


def revenue(spark: SparkSession, path: str, dim_date: DataFrame) -> DataFrame:
    """The mart from the stored differences."""
    kinds = "category string, order_date_key int, orders bigint, qty bigint, " + ", ".join(
        f"{name} decimal(38,2)" for name in MEASURES[2:]
    )
    stored = if_stored(lambda: spark.read.parquet(f"{path}/changes"))
    changes = spark.createDataFrame([], kinds) if stored is None else stored
    per_day = (
        changes.groupBy("category", "order_date_key")
        .agg(*[F.sum(name).alias(name) for name in MEASURES])
        .filter("orders > 0")
    )
    return by_month(per_day, dim_date)
