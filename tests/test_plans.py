"""The physical plans the operators are meant to get."""

import re
from datetime import datetime

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tidemark.operators import marts, quality
from tidemark.operators.dedup import keep_best, latest_batch
from tidemark.operators.facts import fact_orders, with_user_sk
from tidemark.operators.silver_shop import clean_order_items, clean_orders
from tidemark.plans.catalog import QUERIES
from tidemark.plans.shop import Shop, recency
from tidemark.sources.bronze import incremental, land_batch, read_bronze, to_bronze, with_bronze_id
from tidemark.sources.tables import absent_from

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shop(spark):
    return Shop(spark, SF)


def test_dedup_limits_each_key_before_the_shuffle(shop):
    plan = plan_text(keep_best(shop.bronze("order_items"), ["item_id"], recency("order_items")))
    above, below = plan.split("Exchange hashpartitioning(item_id")
    assert re.search(r"WindowGroupLimit.*Final", above)
    assert re.search(r"WindowGroupLimit.*Partial", below)


def test_known_batch_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, batch in ((1, "B1"), (2, "B2")):
        land_batch(spark.range(10), "public.t", path, batch, datetime(2024, 1, day))
    plan = plan_text(latest_batch(read_bronze(spark, path), "B2"))
    assert re.search(r"PartitionFilters: \[.*B2", plan)


def test_incremental_filter_reaches_the_scan(spark, shop):
    plan = plan_text(incremental(shop.table("events"), datetime(2024, 1, 5), ["ts"]))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(ts", plan)


def test_scans_read_only_needed_columns(shop):
    plan = plan_text(marts.top_products(shop.fact_orders(), shop.dim_products()))
    lineitem = max(re.findall(r"ReadSchema: struct<([^>]*l_orderkey[^>]*)>", plan), key=len)
    assert "l_tax" not in lineitem and "l_returnflag" not in lineitem
    assert "TakeOrderedAndProject" in plan


def test_dimensions_shuffle_when_too_big_to_broadcast(spark, shop):
    """Nothing but the calendar and bounded lookups carries a broadcast hint."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = shop.fact_orders()
        plan = plan_text(marts.user_orders_by_city(facts, shop.dim_users()))
        # The offsets of key buckets are at most 4,096 rows.
        assert all("_bucket" in line for line in plan.splitlines() if "BroadcastHashJoin" in line)
        assert "SortMergeJoin" in plan
        assert QUERIES["f3_fact_sales"](spark, SF).count() > 0
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["v1_revenue_by_month_category", "q4_sales_by_region", "d4_scd2_upsert", "x7_constraints"])
def test_no_products_of_tables(spark, name):
    plan = plan_text(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture
def skew_settings(spark):
    """Skew limits scaled down to test data, broadcasts off."""
    before = {k: spark.conf.get(k, None) for k in SMALL_SKEW}
    for k, v in SMALL_SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(column: str, share_of: int = 3):
    """A third of the rows get key 7, the others spread over 5000 keys."""
    return F.when(F.col("id") % share_of == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias(column)


def test_hot_user_is_split_in_the_lookup(spark, skew_settings):
    users = spark.range(5000).selectExpr(
        "CAST(id AS INT) AS user_id", "id * 10 AS user_sk", "true AS is_current"
    )
    orders = spark.range(0, 300000, 1, 16).select(F.col("id").alias("order_id"), hot("user_id"))
    joined = with_user_sk(orders, users)
    assert "skew=true" in plan_text(joined)
    assert joined.filter("user_sk = user_id * 10").count() == 300000


def test_hot_order_is_split_in_the_fact(spark, skew_settings):
    """A third of all items belong to one order, straight from Bronze through both dedups."""
    at = datetime(2024, 1, 1)
    items = spark.range(0, 200000, 1, 16).select(
        F.col("id").alias("item_id"),
        hot("order_id"),
        F.lit(1).alias("product_id"),
        F.lit(2).alias("quantity"),
        F.lit("1.50").alias("unit_price"),
    )
    orders = spark.range(0, 5000, 1, 8).selectExpr(
        "id AS order_id", "id % 9 AS user_id", "'2024-01-01' AS order_date", "'new' AS status",
        "'Hue' AS shipping_city", "'5' AS total_amount", "'10' AS discount",
    )
    users = spark.range(9).selectExpr("CAST(id AS INT) AS user_id", "id AS user_sk", "true AS is_current")

    def bronze(df):
        return with_bronze_id(to_bronze(df, "public.t", "A", at))

    fact = fact_orders(
        clean_order_items(bronze(items), None, "A"), clean_orders(bronze(orders), "A"), users
    )
    assert re.search(r"SortMergeJoin\(skew=true\) \[order_id", plan_text(fact))
    assert fact.filter("net_amount = 2.70").count() == 200000


def test_hot_new_key_is_split_in_the_absence_check(spark, skew_settings):
    source = spark.range(0, 300000, 1, 16).select(hot("k"), F.col("id").alias("v"))
    target = spark.range(0, 300000, 1, 16).select((hot("k") + 1).alias("k")).filter("k <> 7")
    absent = absent_from(source, target, ["k"])
    assert "skew=true" in plan_text(absent)
    left = {r[0] for r in absent.select("k").distinct().collect()}
    assert left == {0, 7}
    assert absent.count() == source.filter("k IN (0, 7)").count()


def test_constraints_read_each_table_once(spark, tmp_path):
    """Two uniques, a check and two foreign keys: one scan of the fact and of each parent, one shuffle by key."""
    fact, dims = str(tmp_path / "fact"), [str(tmp_path / x) for x in ("a", "b")]
    rows = "id % 90 AS k", "id % 7 AS a", "if(id % 10 = 0, NULL, id % 5) AS b", "id - 3 AS v"
    spark.range(100).selectExpr(*rows).write.parquet(fact)
    spark.range(6).selectExpr("id AS a").write.parquet(dims[0])
    spark.range(5).selectExpr("CAST(id AS INT) AS b").write.parquet(dims[1])
    a, b = map(spark.read.parquet, dims)
    checked = quality.check_constraints(
        spark.read.parquet(fact),
        [
            quality.Unique("k", ("k",)),
            quality.Unique("k and v", ("k", "v")),
            quality.Unique("b", ("b",)),
            quality.NotNull("b given", "b"),
            quality.Check("v", "v >= 0"),
            quality.ForeignKey("a known", "a", a, "a"),
            quality.ForeignKey("b known", "b", b, "b"),
        ],
    )
    plan = plan_text(checked)
    for path in (fact, *dims):
        assert plan.count(f"{path}]") == 1
    assert {r["constraint"]: r["violations"] for r in checked.collect()} == {
        "k": 10, "k and v": 0, "b": 94, "b given": 10, "v": 3, "a known": 14, "b known": 0,
    }
    empty = quality.check_constraints(a.limit(0), [quality.Unique("u", ("a",)), quality.NotNull("n", "a")])
    assert sorted(map(tuple, empty.collect())) == [("n", 0), ("u", 0)]
