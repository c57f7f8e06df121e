"""Batches that run again, crash or bring nothing; ids that look like numbers; failed writes."""

from datetime import date, datetime, timedelta
from itertools import count

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.silver_shop import clean_order_items, clean_orders, rejected_rows
from tidemark.plans.shop import Shop, refresh, run_full, run_incremental
from tidemark.sources.bronze import (
    batch_catalog,
    land_batch,
    newest_batch,
    read_bronze,
    snapshot_batch,
    to_bronze,
    with_bronze_id,
)
from tidemark.sources.tables import if_stored, overwrite
from tidemark.sources.watermarks import run_log

DAY = datetime(2024, 1, 1)


def rows(spark, first, last):
    made = [(i, DAY + timedelta(days=i)) for i in range(first, last)]
    return spark.createDataFrame(made, "id int, created_at timestamp_ntz")


def ticking(seconds=3):
    steps = count()
    return lambda: DAY + timedelta(seconds=seconds * next(steps))


def ids(spark, path):
    spark.catalog.refreshByPath(path)
    return sorted((r._batch_id, int(r.id)) for r in read_bronze(spark, path).collect())


def test_a_batch_that_runs_again_keeps_its_rows(spark, tmp_path):
    lake, path, clock = str(tmp_path), f"{tmp_path}/bronze/t", ticking()
    run_incremental(spark, {"t": rows(spark, 0, 5)}, lake, "B0", DAY, clock)
    run_incremental(spark, {"t": rows(spark, 0, 15)}, lake, "B1", DAY, clock)
    before = batch_catalog(spark, path).orderBy("batch_id").collect()
    run_incremental(spark, {"t": rows(spark, 0, 15)}, lake, "B1", DAY, clock)
    assert batch_catalog(spark, path).orderBy("batch_id").collect() == before
    run_incremental(spark, {"t": rows(spark, 0, 16)}, lake, "B1", DAY, clock)
    assert ids(spark, path) == [("B0", i) for i in range(5)] + [("B1", i) for i in range(5, 16)]
    run_incremental(spark, {"t": rows(spark, 0, 18)}, lake, "B2", DAY, clock)
    assert ids(spark, path)[16:] == [("B2", 16), ("B2", 17)]
    stored = read_bronze(spark, path)
    assert stored.select("_bronze_id").distinct().count() == stored.count() == 18


def test_a_failing_rerun_deletes_nothing_confirmed(spark, tmp_path):
    lake, path, clock = str(tmp_path), f"{tmp_path}/bronze/t", ticking()
    run_incremental(spark, {"t": rows(spark, 0, 10)}, lake, "B1", DAY, clock)
    broken = rows(spark, 0, 12).withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    log = run_incremental(spark, {"t": broken}, lake, "B1", DAY, clock)
    assert {r.status for r in log.collect()} == {"RUNNING", "FAILED"}
    assert ids(spark, path) == [("B1", i) for i in range(10)]


def test_an_older_batch_may_not_run_again(spark, tmp_path):
    lake, path, clock = str(tmp_path), f"{tmp_path}/bronze/t", ticking()
    for batch, last in (("B1", 5), ("B2", 8)):
        run_incremental(spark, {"t": rows(spark, 0, last)}, lake, batch, DAY, clock)
    log = run_incremental(spark, {"t": rows(spark, 0, 9)}, lake, "B1", DAY, clock)
    assert "FAILED" in {r.status for r in log.collect()}
    assert len(ids(spark, path)) == 8


def test_a_crash_between_two_tables_loads_each_row_once(spark, tmp_path):
    lake, clock = str(tmp_path), ticking()
    both = {"a": rows(spark, 0, 6), "b": rows(spark, 0, 7)}
    run_incremental(spark, {"a": both["a"]}, lake, "B1", DAY, clock)
    # The crash left rows of table b without a mark.
    land_batch(rows(spark, 0, 3), "public.b", f"{lake}/bronze/b", "B1", DAY)
    run_incremental(spark, both, lake, "B1", DAY, clock)
    assert len(ids(spark, f"{lake}/bronze/a")) == 6
    assert len(ids(spark, f"{lake}/bronze/b")) == 7


def test_runs_take_time_and_are_stored_as_they_go(spark, tmp_path):
    run_incremental(spark, {"t": rows(spark, 0, 2)}, str(tmp_path), "B1", DAY, ticking(5))
    stored = spark.read.parquet(f"{tmp_path}/control/run_events")
    assert run_log(stored).first().duration_sec >= 5
    assert stored.count() == 2


@pytest.mark.parametrize("batch", ["00012345", "12E45678", "1234567D", "20240101", "true"])
def test_batch_ids_stay_text(spark, tmp_path, batch):
    path = str(tmp_path / "t")
    land_batch(rows(spark, 0, 5), "public.t", path, batch, DAY)
    assert {r[0] for r in ids(spark, path)} == {batch}
    assert newest_batch(spark, path) == batch
    assert read_bronze(spark, path).filter(F.col("_batch_id") == batch).count() == 5


def test_an_empty_batch_is_no_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    land_batch(rows(spark, 0, 5), "public.t", path, "F1", DAY, is_full=True)
    land_batch(rows(spark, 0, 0), "public.t", path, "I1", DAY + timedelta(days=1))
    assert newest_batch(spark, path) == snapshot_batch(spark, path) == "F1"
    land_batch(rows(spark, 5, 6), "public.t", path, "I2", DAY + timedelta(days=2))
    assert newest_batch(spark, path) == "I2" and snapshot_batch(spark, path) is None


def test_silver_survives_an_empty_last_batch_and_the_log_tells(spark, tmp_path):
    shop, lake, clock = Shop(spark, "/root/testdata/sf0.001"), str(tmp_path), ticking()
    names = ("users", "products", "orders", "order_items", "transactions")
    sources = {name: shop.source(name) for name in names}
    run_full(spark, sources, lake, "F1", datetime(2024, 1, 2), date(2024, 1, 31), clock)
    before = spark.read.parquet(f"{lake}/silver/orders").count()
    timed = {"orders": sources["orders"], "transactions": sources["transactions"]}
    log = run_incremental(spark, timed, lake, "I1", datetime(2024, 1, 3), clock)
    # The full load set the marks: there is nothing new.
    assert {r.rows_loaded for r in log.filter("status = 'SUCCESS'").collect()} == {0}
    days = (date(2000, 1, 1), date(2040, 12, 31))
    refresh(spark, lake, datetime(2024, 1, 3), date(2024, 2, 1), clock=clock, calendar=days)
    assert spark.read.parquet(f"{lake}/silver/orders").count() == before > 0
    assert spark.read.parquet(f"{lake}/gold/dim_date").count() == (days[1] - days[0]).days + 1
    steps = spark.read.parquet(f"{lake}/control/etl_log")
    told = {(r.layer, r.status): r[0] for r in steps.groupBy("layer", "status").count().select("count", "layer", "status").collect()}
    assert told == {(layer, s): 2 for layer in ("SILVER", "GOLD") for s in ("STARTED", "COMPLETED")}
    assert steps.filter("status = 'COMPLETED' AND end_time > start_time AND rows_processed > 0").count() == 4


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/gold/t"
    overwrite(spark.range(5), path)
    broken = spark.range(9).withColumn("id", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        overwrite(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert overwrite(spark.range(7), path).count() == 7
    assert spark.read.parquet(f"{tmp_path}/gold/*").count() == 7


def test_only_a_missing_path_reads_as_none(spark, tmp_path):
    assert if_stored(lambda: spark.read.parquet(f"{tmp_path}/none")) is None
    with pytest.raises(AnalysisException):
        if_stored(lambda: spark.range(1).select("missing"))


def test_keys_beyond_32_bits_and_unreadable_ones(spark):
    items = spark.createDataFrame(
        [("21474836481", "2147483649", "1", "2", "1.50"), ("x", "1", "1", "1", "1"), ("3", "y", "1", "1", "1")],
        "item_id string, order_id string, product_id string, quantity string, unit_price string",
    )
    orders = spark.createDataFrame(
        [("2147483649", "9999999999", "2024-01-01", "new", "Hue", "5", "0")],
        "order_id string, user_id string, order_date string, status string, shipping_city string, "
        "total_amount string, discount string",
    )

    def bronze(df):
        return with_bronze_id(to_bronze(df, "public.t", "A", DAY))

    clean = clean_order_items(bronze(items), clean_orders(bronze(orders), "A"), "A").collect()
    assert [(r.item_id, r.order_id) for r in clean] == [(21474836481, 2147483649)]
    assert {r.item_id for r in rejected_rows(bronze(items), "order_items").collect()} == {"x", "3"}
