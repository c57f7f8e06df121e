"""The CRM track on the sample with its golden results."""

from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from sample import frames

from tidemark.operators import sales
from tidemark.operators.scd2 import history
from tidemark.plans.crm import AS_OF, CLEANERS, Crm, run_load
from tidemark.schemas import ETL_LOG


@pytest.fixture(scope="module")
def crm(spark):
    data = frames(spark)
    return Crm(spark, data.__getitem__)


@pytest.fixture(scope="module")
def fact(crm):
    return crm.fact_sales().cache()


def rows(df):
    return [tuple(int(v) if isinstance(v, Decimal) and v == int(v) else v for v in r) for r in df.collect()]


def test_silver_keeps_all_rows_with_full_score(crm):
    counts = {name: crm.silver(name).count() for name in CLEANERS}
    assert list(counts.values()) == [5, 5, 10, 5, 4, 5]
    for name in CLEANERS:
        assert {r[0] for r in crm.silver(name).select("data_quality_score").collect()} == {Decimal("1.00")}


def test_dimension_sizes(crm):
    counts = sales.dim_counts(
        {"c": crm.dim_customers(), "p": crm.dim_products(), "d": crm.dim_date()}
    )
    assert rows(counts) == [("c", 5, 5, 0), ("p", 5, 5, 0), ("d", 4018, 4018, 0)]


def test_keys_are_one_to_n(crm):
    keys = sorted(r[0] for r in crm.dim_customers().select("customer_key").collect())
    assert keys == [1, 2, 3, 4, 5]


def test_discounts(fact):
    given = {
        r.transaction_id: int(r.discount_amount) for r in fact.filter("discount_amount > 0").collect()
    }
    assert given == {
        "TXN001": 1250000,
        "TXN003": 4400000,
        "TXN005": 750000,
        "TXN006": 800000,
        "TXN008": 3000000,
        "TXN010": 1100000,
    }


def test_top_customers_and_products(crm, fact):
    got = [(r[2], r[3], r[4]) for r in rows(sales.top_customers(fact, crm.dim_customers()))]
    assert got == [
        ("CENTRAL", 2, 73260000),
        ("NORTH", 2, 60500000),
        ("SOUTH", 2, 42845000),
        ("SOUTH", 2, 38665000),
        ("SOUTH", 2, 25300000),
    ]
    got = [r[3:] for r in rows(sales.top_products_sold(fact, crm.dim_products()))]
    assert got == [
        (2, 3, 66550000),
        (2, 2, 62700000),
        (2, 2, 53625000),
        (2, 2, 32175000),
        (2, 3, 25520000),
    ]


def test_months_regions_categories(crm, fact):
    assert rows(sales.monthly_trend(fact, crm.dim_date())) == [
        (2024, 1, "January", 5, 127160000),
        (2024, 2, "February", 5, 113410000),
    ]
    assert rows(sales.sales_by_region(fact, crm.dim_customers())) == [
        ("SOUTH", 3, 6, 106810000, Decimal("17801666.67")),
        ("CENTRAL", 1, 2, 73260000, 36630000),
        ("NORTH", 1, 2, 60500000, 30250000),
    ]
    assert rows(sales.category_performance(fact, crm.dim_products())) == [
        ("ELECTRONICS", 4, 8, 9, 215050000, 26881250),
        ("AUDIO", 1, 2, 3, 25520000, 12760000),
    ]


def test_segments_payments_weekends_summary(crm, fact):
    assert rows(sales.customer_segments(fact, crm.dim_customers())) == [
        ("RETAIL", 3, 6, Decimal("21440833.33"), 128645000),
        ("WHOLESALE", 2, 4, 27981250, 111925000),
    ]
    assert rows(sales.payment_methods(fact)) == [
        ("BANK_TRANSFER", 4, 99165000, 24791250),
        ("CASH", 2, 73260000, 36630000),
        ("CREDIT_CARD", 4, 68145000, 17036250),
    ]
    assert sorted(rows(sales.weekend_split(fact, crm.dim_date()))) == [
        ("Weekday", 9, 210870000, 23430000),
        ("Weekend", 1, 29700000, 29700000),
    ]
    assert rows(sales.fact_summary(fact)) == [
        (10, 12, 240570000, 24057000, 8800000, 43560000)
    ]


def test_stored_load_is_idempotent(spark, tmp_path):
    data = frames(spark)
    for _ in range(2):
        run_load(spark, data, str(tmp_path), AS_OF)
    for name, expected in {"dim_customers": 5, "dim_products": 5, "dim_date": 4018, "fact_sales": 10}.items():
        assert spark.read.parquet(f"{tmp_path}/gold/{name}").count() == expected


def test_a_changed_customer_gets_a_second_version(spark, tmp_path):
    """Two records after a reload, the calendar's own days, and both procedures in the log."""
    data, lake = frames(spark), str(tmp_path)
    days = (date(2019, 1, 1), date(2019, 12, 31))
    run_load(spark, data, lake, AS_OF, calendar=days)
    first = data["crm_cust_info"]
    moved = F.when(F.trim("cust_id") == "CUST001", "newemail@example.com").otherwise(F.col("email"))
    later = {**data, "crm_cust_info": first.withColumn("email", moved)}
    run_load(spark, later, lake, AS_OF + timedelta(days=3), calendar=days)
    run_load(spark, later, lake, AS_OF + timedelta(days=3), calendar=days)
    dim = spark.read.parquet(f"{lake}/gold/dim_customers")
    found = history(dim, "customer_id", "CUST001").collect()
    assert [(r.email == "newemail@example.com", r.is_current) for r in found] == [(False, False), (True, True)]
    assert found[0].end_date == AS_OF + timedelta(days=2) and dim.count() == 6
    assert spark.read.parquet(f"{lake}/gold/fact_sales").count() == 10
    assert spark.read.parquet(f"{lake}/gold/dim_date").count() == 365
    log = spark.read.schema(ETL_LOG).parquet(f"{lake}/control/etl_log").collect()
    assert Counter((r.procedure_name, r.status) for r in log) == {
        (name, status): 3 for name in ("sp_load_silver", "sp_load_gold") for status in ("STARTED", "COMPLETED")
    }
    with pytest.raises(ValueError):
        run_load(spark, data, lake, AS_OF, changes="other")


def test_a_failing_load_is_logged(spark, tmp_path):
    broken = {**frames(spark), "crm_sales_details": spark.range(1)}
    with pytest.raises(Exception):  # noqa: B017
        run_load(spark, broken, str(tmp_path), AS_OF)
    log = spark.read.schema(ETL_LOG).parquet(f"{tmp_path}/control/etl_log")
    assert {r.status for r in log.collect()} == {"STARTED", "FAILED"}
