from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans.shop import Shop, refresh, run_full, run_incremental
from tidemark.sources.bronze import (
    drop_batch,
    incremental,
    ingest_all,
    land_batch,
    newest_batch,
    read_bronze,
    rollback_batch,
    to_bronze,
    with_bronze_id,
)
from tidemark.sources.tables import append_new, read_jdbc
from tidemark.sources.watermarks import advance_watermarks, read_watermarks, run_log

SF = "/root/testdata/sf0.001"
ENTITIES = ("users", "products", "orders", "order_items", "transactions")


@pytest.fixture(scope="module")
def sources(spark):
    shop = Shop(spark, SF)
    return {name: shop.source(name) for name in ENTITIES}


def test_bronze_is_text_and_keeps_null(spark):
    df = spark.createDataFrame([(1, None, True)], "a int, b double, c boolean")
    row = to_bronze(df, "public.t", "B1", datetime(2024, 1, 1)).first()
    assert (row.a, row.b, row.c, row._batch_id) == ("1", None, "true", "B1")


def test_batches_get_distinct_growing_ids(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(1000).repartition(4)
    for batch in ("B1", "B2", "B2", "20240101"):
        assert land_batch(df, "public.t", path, batch, datetime(2024, 1, 1)).rows == 1000
    stored = read_bronze(spark, path)
    assert stored.count() == 3000
    assert stored.select("_bronze_id").distinct().count() == 3000
    tops = {r[0]: (r[1], r[2]) for r in stored.groupBy("_batch_id").agg(F.min("_bronze_id"), F.max("_bronze_id")).collect()}
    assert tops["B1"][1] < tops["B2"][0] and tops["B2"][1] < tops["20240101"][0]


def test_rollback_view_and_partition_drop_agree(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ("B1", "B2"):
        land_batch(spark.range(10), "public.t", path, batch, datetime(2024, 1, int(batch[1])))
    assert rollback_batch(read_bronze(spark, path), "B2").count() == 10
    assert newest_batch(spark, path) == "B2"
    drop_batch(spark, path, "B2")
    assert newest_batch(spark, path) == "B1"
    spark.catalog.refreshByPath(path)
    assert {r[0] for r in read_bronze(spark, path).select("_batch_id").collect()} == {"B1"}


def test_dense_ids(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    ids = with_bronze_id(df, ["k"]).select("_bronze_id")
    got = ids.agg(F.min("_bronze_id"), F.max("_bronze_id"), F.count_distinct("_bronze_id")).first()
    assert tuple(got) == (1, 5000, 5000)


def test_incremental_picks_the_time_column(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), datetime(2024, 1, 5)), (2, datetime(2024, 1, 3), datetime(2024, 1, 3))],
        "id int, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    mark = datetime(2024, 1, 3)
    assert [r.id for r in incremental(df, mark).collect()] == [1]
    assert incremental(df.drop("updated_at"), mark).count() == 0
    assert incremental(df, None).count() == 2
    assert incremental(df.select("id"), mark).count() == 2


def test_watermarks_never_move_back(spark):
    from tidemark.schemas import WATERMARK

    at = datetime(2024, 1, 9)
    state = spark.createDataFrame(
        [("a", datetime(2024, 1, 5), "B1", 7, datetime(2024, 1, 6)), ("b", datetime(2024, 1, 5), "B1", 7, datetime(2024, 1, 6))],
        WATERMARK,
    )
    loaded = spark.createDataFrame(
        [("a", None, None, 0), ("b", datetime(2024, 1, 8), "B2", 3), ("c", datetime(2024, 1, 8), "B2", 4)],
        "table_name string, last_loaded_at timestamp_ntz, last_batch_id string, last_row_count bigint",
    )
    got = {r.table_name: tuple(r)[1:4] for r in advance_watermarks(state, loaded, at).collect()}
    assert got == {
        "a": (datetime(2024, 1, 5), "B1", 0),
        "b": (datetime(2024, 1, 8), "B2", 3),
        "c": (datetime(2024, 1, 8), "B2", 4),
    }


def test_append_new(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (2, "c"), (None, "d")], "k int, v string")
    got = sorted((r.k or 0, r.v) for r in append_new(target, source, ["k"]).collect())
    assert got == [(0, "d"), (1, "a"), (2, "c")]


def test_full_run_twice_is_one_run(spark, sources, tmp_path):
    lake = str(tmp_path)
    for _ in range(2):
        summary = run_full(spark, sources, lake, "B1", datetime(2024, 1, 2), date(2024, 1, 31))
    counts = {r._source_table: (r.batch_rows, r.total_rows) for r in summary.collect()}
    assert counts == {f"public.{n}": (df.count(),) * 2 for n, df in sources.items()}
    shop = Shop(spark, SF)
    for layer, name, lazy in (
        ("silver", "orders", shop.orders()),
        ("silver", "order_items", shop.order_items(shop.orders())),
        ("gold", "dim_users/as_of=2024-01-31", shop.dim_users()),
        ("gold", "fact_orders", shop.fact_orders()),
        ("gold", "fact_transactions", shop.fact_transactions()),
    ):
        assert spark.read.parquet(f"{lake}/{layer}/{name}").count() == lazy.count(), name


def test_incremental_runs(spark, sources, tmp_path):
    lake = str(tmp_path)
    cut = datetime(2024, 1, 10)
    early = {n: (df.filter(F.col("created_at") <= F.lit(cut)) if n == "transactions" else df) for n, df in sources.items()}
    times = [datetime(2024, 2, d) for d in (1, 2, 3)]
    run_incremental(spark, early, lake, "I1", times[0])
    run_incremental(spark, sources, lake, "I2", times[1])
    last = run_incremental(spark, sources, lake, "I3", times[2])

    # every payment landed exactly once, and the third run found nothing new
    payments = read_bronze(spark, f"{lake}/bronze/transactions")
    assert payments.count() == payments.select("txn_id").distinct().count() == 1000
    ended = {r.table_name: (r.status, r.rows_loaded) for r in last.filter("status <> 'RUNNING'").collect()}
    assert ended["public.transactions"] == ("SUCCESS", 0)
    assert ended["public.order_items"] == ("SUCCESS", sources["order_items"].count())
    marks = read_watermarks(spark.read.parquet(f"{lake}/control/watermarks"))
    assert marks.count() == 5

    refresh(spark, lake, times[2], date(2024, 2, 3), mode="latest_per_key")
    assert spark.read.parquet(f"{lake}/silver/transactions").count() == 1000
    refresh(spark, lake, times[2], date(2024, 2, 4), mode="latest_per_key")
    people = spark.read.parquet(f"{lake}/gold/dim_users")
    assert people.groupBy("as_of").count().select("count").distinct().count() == 1


def test_a_failing_table_is_rolled_back_and_the_rest_loads(spark, sources, tmp_path):
    broken = sources["orders"].withColumn("status", F.raise_error(F.lit("source lost")).cast("string"))
    some = {"orders": broken, "products": sources["products"]}
    log = run_incremental(spark, some, str(tmp_path), "I1", datetime(2024, 2, 1))
    ended = {r.table_name: r for r in run_log(log).collect()}
    assert ended["public.orders"].status == "ROLLED_BACK"
    assert "source lost" in ended["public.orders"].error_message
    assert ended["public.products"].status == "SUCCESS"
    assert read_bronze(spark, f"{tmp_path}/bronze/products").count() == 200


def test_ingest_summary_counts_older_batches(spark, tmp_path):
    source = {"public.t": spark.range(7)}
    ingest_all(spark, source, str(tmp_path), "B1", datetime(2024, 1, 1))
    row = ingest_all(spark, source, str(tmp_path), "B2", datetime(2024, 1, 2)).first()
    assert (row.batch_rows, row.total_rows) == (7, 14)


def test_jdbc_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        read_jdbc(spark, "jdbc:nowhere:x", "public.users", "user_id", 1, 100, 4)
