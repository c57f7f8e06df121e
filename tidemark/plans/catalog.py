"""The registered queries: one per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import date_key
from tidemark.operators import marts, observe, quality, sales
from tidemark.operators.dedup import keep_best, latest_batch
from tidemark.operators.dims import dim_customers
from tidemark.operators.facts import fact_orders
from tidemark.operators.scd2 import history, scd2_stats
from tidemark.operators.silver_crm import clean_crm_cust
from tidemark.operators.silver_shop import (
    clean_order_items,
    clean_orders,
    clean_products,
    clean_transactions,
    clean_users,
    dedup_users,
    normalise_phones,
    rejected_rows,
    standardise_dates,
    validate_emails,
)
from tidemark.plans.crm import AS_OF as CRM_AS_OF
from tidemark.plans.crm import CLEANERS, Crm
from tidemark.plans.revenue import ITEM, add_batch, revenue
from tidemark.plans.shop import KEYS, RUN_AT, Shop, merge_silver, recency, run_incremental, undo_silver
from tidemark.session import new_folder, prepare
from tidemark.sources.bronze import (
    batch_summary,
    drop_batch,
    incremental,
    ingest_all,
    land_batch,
    read_bronze,
    rollback_batch,
    with_bronze_id,
)
from tidemark.sources.keyed import read_keyed
from tidemark.sources.tables import append_new, overwrite, read_table
from tidemark.sources.watermarks import (
    advance_watermarks,
    etl_log_report,
    loaded_marks,
    read_watermarks,
    run_log,
)
from tidemark.streaming.apply import apply_changes
from tidemark.streaming.changes import (
    capture,
    envelope,
    explode_rows,
    read_changes,
    route,
    write_changes,
)
from tidemark.streaming.ingest import stream_to_bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WATERMARK = datetime(2022, 1, 1)
WIDE = 1 << 33  # lifts the test keys beyond 32 bits
OBSERVED_AT = datetime(2024, 1, 31)


def rendered(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as doubles, days and times as ISO text."""
    columns = []
    for field in df.schema.fields:
        value = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType):
            value = f"CAST({value} AS DOUBLE)"
        elif isinstance(field.dataType, T.DateType):
            value = f"CAST({value} AS STRING)"
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            value = f"date_format({value}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        columns.append(f"{value} AS `{field.name}`")
    return df.selectExpr(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: rendered(build(prepare(spark), folder))
        return build

    return register


def _shop(name: str, build: Callable[[Shop], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(Shop(spark, folder)))


def _crm(name: str, build: Callable[[Crm], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(Crm.over(spark, folder)))


# --- sources, sinks, ingest -------------------------------------------------------------

_shop("s1_full_extract", lambda s: s.bronze("orders"))
_shop("s3_bronze_id", lambda s: with_bronze_id(s.bronze("users"), ["_batch_id", "user_id"]))


@query("s4_ingest_all")
def _ingest_all(spark: SparkSession, folder: str) -> DataFrame:
    """Five sources written to Bronze; the counts come from the stored rows."""
    shop, lake = Shop(spark, folder), new_folder(spark, "bronze")
    ingest_all(
        spark, {f"public.{n}": shop.source(n) for n in KEYS}, lake, "B1", datetime(2024, 1, 1)
    )
    stored = [batch_summary(read_bronze(spark, f"{lake}/{name}")) for name in KEYS]
    return reduce(DataFrame.unionByName, stored)


@query("s5_batch_summary")
def _batch_summary(spark: SparkSession, folder: str) -> DataFrame:
    shop = Shop(spark, folder)
    lineage = ["_source_table", "_batch_id"]
    rows = shop.bronze("users").select(lineage)
    for entity in ("products", "orders", "order_items", "transactions"):
        rows = rows.unionByName(shop.bronze(entity).select(lineage))
    return batch_summary(rows)


_shop("s6_incremental_extract", lambda s: incremental(s.source("orders"), WATERMARK))
_shop("s6b_full_without_time", lambda s: incremental(s.source("order_items"), WATERMARK))


@query("s6c_incremental_rerun")
def _incremental_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """A first batch, then a second one that runs again after the source has grown."""
    orders, lake = Shop(spark, folder).source("orders"), new_folder(spark, "rerun")

    def until(days: int) -> dict[str, DataFrame]:
        last = F.lit(WATERMARK + timedelta(days=days))
        return {"orders": orders.filter(F.col("created_at") <= last)}

    run_incremental(spark, until(0), lake, "00012345", datetime(2024, 1, 1))
    run_incremental(spark, until(200), lake, "12E45678", datetime(2024, 1, 2))
    run_incremental(spark, {"orders": orders}, lake, "12E45678", datetime(2024, 1, 2))
    return (
        read_bronze(spark, f"{lake}/bronze/orders")
        .groupBy("_batch_id")
        .agg(F.count("*").alias("batch_rows"), F.count_distinct("order_id").alias("orders"))
    )


@query("s6d_overlap")
def _overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Every eleventh order of the days before the first load's end is committed after that load."""
    orders, lake = Shop(spark, folder).source("orders"), new_folder(spark, "overlap")
    made, first = F.col("created_at"), F.lit(WATERMARK)
    late = (F.col("order_id") % 11 == 0) & (made > F.lit(WATERMARK - timedelta(days=20)))
    loads = (orders.filter((made <= first) & ~late), orders.filter(made <= F.lit(WATERMARK + timedelta(days=200))), orders)
    for number, (source, batch_id) in enumerate(zip(loads, ("A", "B", "C"), strict=True), 1):
        run_incremental(
            spark, {"orders": source}, lake, batch_id, datetime(2024, 1, number), overlap=timedelta(days=30)
        )
    return (
        read_bronze(spark, f"{lake}/bronze/orders")
        .groupBy("_batch_id")
        .agg(F.count("*").alias("batch_rows"), F.count_distinct("order_id").alias("orders"))
    )


def watermark_state(shop: Shop) -> tuple[DataFrame, DataFrame]:
    """Marks after a first load up to a date, and the marks of the load that follows it."""
    orders, payments = shop.source("orders"), shop.source("transactions")
    products = shop.source("products")
    before = orders.filter(F.col("created_at") <= F.lit(WATERMARK))

    def batch(df: DataFrame, batch_id: str) -> DataFrame:
        return df.withColumn("_batch_id", F.lit(batch_id))

    times = {"public.orders": "created_at", "public.transactions": "created_at"}
    first = loaded_marks(
        {"public.orders": batch(before, "A"), "public.products": batch(products, "A")}, times
    )
    second = loaded_marks(
        {
            "public.orders": batch(incremental(orders, WATERMARK), "B"),
            "public.transactions": batch(payments, "B"),
        },
        times,
    )
    state = first.withColumn("updated_at", F.lit(datetime(2024, 1, 30)).cast("timestamp_ntz"))
    return state, second


@query("s7_watermarks")
def _watermarks(spark: SparkSession, folder: str) -> DataFrame:
    state, loaded = watermark_state(Shop(spark, folder))
    advanced = advance_watermarks(state, loaded, RUN_AT)
    return read_watermarks(state.unionByName(advanced))


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """A start event per run and, but for runs still going, an end event."""
    runs = Shop(spark, folder).source("run_log")
    started = runs.select(
        "log_id",
        "batch_id",
        "table_name",
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("bigint").alias("rows_loaded"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("started_at").alias("event_at"),
    )
    failed = F.col("status").isin("FAILED", "ROLLED_BACK")
    seconds = F.make_dt_interval(secs=F.col("log_id") % 90)
    ended = runs.filter(F.col("status") != "RUNNING").select(
        "log_id",
        "batch_id",
        "table_name",
        "status",
        F.when(~failed, F.col("rows_loaded")).alias("rows_loaded"),
        F.when(failed, F.concat(F.lit("load failed: "), "table_name")).alias("error_message"),
        (F.col("started_at") + seconds).alias("event_at"),
    )
    return started.unionByName(ended)


query("s8_run_log")(lambda spark, folder: run_log(run_events(spark, folder)))
_shop("s9_rollback_batch", lambda s: rollback_batch(s.bronze("users"), "B"))
query("s10_etl_log")(lambda spark, folder: etl_log_report(Shop(spark, folder).source("etl_log")))


@query("s11_full_refresh")
def _full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Silver products written and read back."""
    return overwrite(Shop(spark, folder).products(), new_folder(spark, "silver-products"))


def _append_new(s: Shop) -> DataFrame:
    orders = s.source("orders")
    loaded = orders.filter(F.col("created_at") <= F.lit(WATERMARK))
    return append_new(loaded, orders, ["order_id"])


_shop("s12_append_new", _append_new)

# --- silver, shop track -----------------------------------------------------------------

_shop("c1_latest_batch", lambda s: latest_batch(s.bronze("users")))
_shop("c2_dedup_users", lambda s: dedup_users(s.bronze("users"), recency=recency("users")))
_shop(
    "c2b_dedup_users_keep_null",
    lambda s: dedup_users(s.bronze("users"), recency=recency("users"), keep_null_keys=True),
)
_shop(
    "c3_dedup_items",
    lambda s: keep_best(
        latest_batch(s.bronze("order_items")), ["item_id"], recency("order_items")
    ),
)
_shop(
    "c3b_latest_per_key_items",
    lambda s: clean_order_items(
        s.bronze("order_items"), None, mode="latest_per_key", recency=recency("order_items")
    ),
)


def _three_batches(spark: SparkSession, folder: str) -> str:
    """Items landed in three batches and merged into Silver one after another; the lake's folder.

    The second batch changes every seventh item's quantity, the third brings every fifth item.
    """
    shop, lake = Shop(spark, folder), new_folder(spark, "delta")
    items, item = shop.source("order_items"), F.col("item_id")
    more = items.filter(item % 7 == 0).withColumn("quantity", F.col("quantity") + 1)
    batches = {"A": items.filter(item % 5 != 0), "B": more, "C": items.filter(item % 5 == 0)}
    for number, (batch_id, rows) in enumerate(batches.items(), 1):
        land_batch(rows, "public.order_items", f"{lake}/bronze/order_items", batch_id, datetime(2024, 1, number))
        merge_silver(spark, lake, "order_items", batch_id, recency("order_items"))
    return lake


@query("c3c_merge_delta")
def _merge_delta(spark: SparkSession, folder: str) -> DataFrame:
    return read_keyed(spark, f"{_three_batches(spark, folder)}/silver_by_key/order_items")


@query("s9b_rollback_silver")
def _rollback_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The second batch taken out of Bronze, and out of Silver by its own keys only."""
    lake = _three_batches(spark, folder)
    drop_batch(spark, f"{lake}/bronze/order_items", "B")
    undo_silver(spark, lake, "order_items", "B", recency("order_items"))
    return read_keyed(spark, f"{lake}/silver_by_key/order_items")


_shop("c4_clean_users", lambda s: clean_users(s.bronze("users"), recency=recency("users")))
_shop(
    "c5_clean_products",
    lambda s: clean_products(s.bronze("products"), recency=recency("products")),
)
_shop("c6_clean_orders", lambda s: clean_orders(s.bronze("orders"), recency=recency("orders")))
_shop(
    "c7_clean_order_items",
    lambda s: clean_order_items(
        s.bronze("order_items"),
        clean_orders(s.bronze("orders"), recency=recency("orders")),
        recency=recency("order_items"),
    ),
)


def _wide_items(shop: Shop) -> DataFrame:
    """Items whose own and order keys are beyond 32 bits; every 97th order key is no number."""
    order = F.col("order_id").cast("bigint")
    return shop.bronze("order_items").withColumns(
        {
            "item_id": (F.col("item_id").cast("bigint") + WIDE).cast("string"),
            "order_id": F.when(order % 97 == 0, F.concat(F.lit("#"), "order_id")).otherwise(
                (order + WIDE).cast("string")
            ),
        }
    )


_shop(
    "c7b_wide_keys",
    lambda s: clean_order_items(_wide_items(s), None, recency=recency("order_items")),
)
_shop(
    "c7c_rejected_items",
    lambda s: rejected_rows(latest_batch(_wide_items(s)), "order_items").select(
        "item_id", "order_id", "product_id", "_batch_id"
    ),
)


def _wide_amounts(shop: Shop) -> DataFrame:
    """Items with large, fractional and tiny numbers, by the remainder of their key."""
    item = F.col("item_id").cast("bigint")

    def chosen(column: str, values: dict[int, str]) -> Column:
        cases = F.col(column)
        for remainder, value in values.items():
            cases = F.when(item % 11 == remainder, F.lit(value)).otherwise(cases)
        return cases

    return latest_batch(shop.bronze("order_items")).withColumns(
        {
            "quantity": chosen("quantity", {0: "3000000000", 1: "2.0", 5: "2.5", 6: "9" * 18, 7: "9" * 20}),
            "unit_price": chosen(
                "unit_price",
                {2: "10000000000000000.00", 3: "1000000000000000", 4: "0.004", 6: "9" * 20, 8: "9" * 40},
            ),
        }
    )


_shop(
    "c7d_wide_amounts",
    lambda s: clean_order_items(_wide_amounts(s), None, recency=recency("order_items")),
)
_shop(
    "c7e_rejected_amounts",
    lambda s: rejected_rows(_wide_amounts(s), "order_items").select(
        "item_id", "quantity", "unit_price", "_batch_id"
    ),
)
_shop(
    "c8_clean_transactions",
    lambda s: clean_transactions(s.bronze("transactions"), recency=recency("transactions")),
)
_shop(
    "c9_standardise_dates",
    lambda s: standardise_dates(s.source("orders").select("order_id", "order_date"), "order_date"),
)


def _timed_dates(shop: Shop) -> DataFrame:
    """Every order's creation time in one of five shapes with a time or single digits."""
    made, shapes = F.col("created_at"), ("yyyy-MM-dd HH:mm:ss", "yyyy-M-d", "d/M/yyyy", "d MMM yyyy")
    texts = [F.date_format(made, shape) for shape in shapes]
    texts.append(F.concat(F.date_format(made, "yyyy-MM-dd"), F.lit("T10:30")))
    chosen = F.get(F.array(*texts), (F.col("order_id") % len(texts)).cast("int"))
    return shop.source("orders").select("order_id", chosen.alias("made"))


_shop("c9b_timed_dates", lambda s: standardise_dates(_timed_dates(s), "made"))
_shop(
    "c10_validate_emails",
    lambda s: validate_emails(s.source("users").select("user_id", "email"), "email"),
)
_shop(
    "c11_normalise_phones",
    lambda s: normalise_phones(s.source("users").select("user_id", "phone"), "phone"),
)


def _dq_report(s: Shop) -> DataFrame:
    entities = ("users", "products", "orders", "transactions")
    return quality.dq_report(
        {name: s.bronze(name) for name in entities}, {name: getattr(s, name)() for name in entities}
    )


_shop("c12_dq_report", _dq_report)

# --- silver, CRM track ------------------------------------------------------------------

for _key, _name in {
    "m1_clean_crm_cust": "crm_cust_info",
    "m2_clean_crm_prd": "crm_prd_info",
    "m3_clean_crm_sales": "crm_sales_details",
    "m4_clean_erp_cust": "erp_cust_az12",
    "m5_clean_erp_loc": "erp_loc_a101",
    "m6_clean_erp_px": "erp_px_cat_g1v2",
}.items():
    _crm(_key, lambda c, name=_name: c.silver(name))
_crm(
    "m1b_clean_crm_cust_all", lambda c: clean_crm_cust(c.bronze("crm_cust_info"), validate_email=False)
)

# --- dimensions -------------------------------------------------------------------------


def _dim_date_orders(s: Shop) -> DataFrame:
    """The calendar with the orders placed on each day."""
    per_day = (
        s.source("orders")
        .groupBy(date_key("created_at").alias("date_key"))
        .agg(F.count("*").alias("orders"))
    )
    days = s.dim_date().join(per_day, "date_key", "left")
    return days.withColumn("orders", F.coalesce("orders", F.lit(0)))


def _dim_date_sales(c: Crm) -> DataFrame:
    """The fiscal calendar with the sales of each day."""
    per_day = (
        c.bronze("crm_sales_details")
        .groupBy(date_key("transaction_date").alias("date_key"))
        .agg(F.count("*").alias("sales"))
    )
    days = c.dim_date().join(per_day, "date_key", "left")
    return days.withColumn("sales", F.coalesce("sales", F.lit(0)))


_shop("d1_dim_date", _dim_date_orders)
_crm("d2_dim_date_fiscal", _dim_date_sales)
_shop("d3_dim_users", lambda s: s.dim_users())
for _key, _action in {"d4_scd2_close": "closed", "d5_scd2_reopen": "reopened", "d6_scd2_new": "new"}.items():
    _shop(_key, lambda s, action=_action: s.user_changes().filter(F.col("_action") == action))
_shop("d4_scd2_upsert", lambda s: s.dim_users_history())
_shop("d7_scd2_stats", lambda s: scd2_stats(s.user_changes()))
_shop("d8_dim_products", lambda s: s.dim_products())
_crm("d9_dim_customers", lambda c: c.dim_customers())
_crm("d9b_dim_customers_full_outer", lambda c: c.dim_customers("full_outer"))
_crm("d10_dim_products_crm", lambda c: c.dim_products())
_crm("d10b_dim_products_full_outer", lambda c: c.dim_products("full_outer"))


def _second_customer_load(c: Crm, mode: str) -> DataFrame:
    """Insert into a dimension that was first loaded before the ERP system was connected."""
    erp = c.silver("erp_cust_az12")
    before = dim_customers(
        c.silver("crm_cust_info"), erp.filter(F.lit(False)), c.silver("erp_loc_a101"), CRM_AS_OF
    )
    return c.dim_customers(mode, before)


_crm("d9c_dim_customers_second_load", lambda c: _second_customer_load(c, "union"))
_crm("d9d_dim_customers_scd2", lambda c: c.customer_changes())
_shop("d11_history", lambda s: history(s.dim_users_history(), "user_id"))
_shop("d11b_history_of_one", lambda s: history(s.dim_users_history(), "user_id", 15))

# --- facts ------------------------------------------------------------------------------

_shop("f1_fact_orders", lambda s: s.fact_orders())
_shop("f1b_fact_orders_as_of", lambda s: s.fact_orders_as_of())
_shop("f1c_as_of_merge", lambda s: s.fact_orders_as_of("as_of_merge"))
_shop("f2_fact_transactions", lambda s: s.fact_transactions())
_crm("f3_fact_sales", lambda c: c.fact_sales())


def _second_sales_load(c: Crm) -> DataFrame:
    loaded = c.silver("crm_sales_details").filter(F.col("transaction_date") <= F.lit(WATERMARK))
    return c.fact_sales(loaded.select("transaction_id"))


_crm("f3b_fact_sales_second_load", _second_sales_load)

# --- views and analytic queries ---------------------------------------------------------


def _revenue(s: Shop) -> DataFrame:
    return marts.revenue_by_month_category(s.fact_orders(), s.dim_date(), s.dim_products())


def _gold_counts(s: Shop) -> DataFrame:
    return marts.row_counts(
        {
            "gold.dim_date": s.dim_date(),
            "gold.dim_users": s.dim_users(),
            "gold.dim_products": s.dim_products(),
            "gold.fact_orders": s.fact_orders(),
            "gold.fact_transactions": s.fact_transactions(),
        }
    )


def _best_months(s: Shop) -> DataFrame:
    revenue = _revenue(s)
    order = [F.col("net_revenue").desc(), "month_num", "category"]
    return marts.sample(revenue, revenue.columns, F.col("year") == 2024, 5, order)


_shop("v1_revenue_by_month_category", _revenue)


@query("v1b_revenue_by_batches")
def _revenue_by_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The mart of three batches of the fact; the first one held some of the orders as cancelled."""
    shop, path = Shop(spark, folder), new_folder(spark, "revenue")
    category = shop.dim_products().select("product_sk", "category")
    joined = shop.fact_orders().join(category, "product_sk").select(*ITEM)
    facts = overwrite(joined, new_folder(spark, "revenue-facts"))
    item = F.col("order_item_sk")
    wrong = F.when(item % 9 == 0, "cancelled").otherwise(F.col("order_status"))
    batches = (
        facts.filter(item % 3 != 0).withColumn("order_status", wrong),
        facts.filter(item % 3 == 0).withColumn("order_status", wrong),
        facts.filter(item % 9 == 0),
    )
    for number, batch in enumerate(batches, 1):
        add_batch(spark, path, batch, f"B{number}", number)
    return revenue(spark, path, shop.dim_date())


_shop("v2_user_orders_by_city", lambda s: marts.user_orders_by_city(s.fact_orders(), s.dim_users()))
_shop("v3_payment_summary", lambda s: marts.payment_summary(s.fact_transactions()))
_shop("v4_top_products", lambda s: marts.top_products(s.fact_orders(), s.dim_products()))
_shop("v5_row_counts", _gold_counts)
_shop("v6_view_slice", _best_months)

_crm("q1_top_customers", lambda c: sales.top_customers(c.fact_sales(), c.dim_customers()))
_crm(
    "q1b_top_customers_by_city",
    lambda c: sales.top_customers(c.fact_sales(), c.dim_customers(), by=("customer_name", "city")),
)
_crm("q2_top_products", lambda c: sales.top_products_sold(c.fact_sales(), c.dim_products()))
_crm("q3_monthly_trend", lambda c: sales.monthly_trend(c.fact_sales(), c.dim_date()))
_crm("q4_sales_by_region", lambda c: sales.sales_by_region(c.fact_sales(), c.dim_customers()))
_crm(
    "q5_category_performance",
    lambda c: sales.category_performance(c.fact_sales(), c.dim_products()),
)
_crm(
    "q5b_category_brand_sales",
    lambda c: sales.category_brand_sales(c.fact_sales(), c.dim_products()),
)
_crm("q6_customer_segments", lambda c: sales.customer_segments(c.fact_sales(), c.dim_customers()))
_crm("q7_payment_methods", lambda c: sales.payment_methods(c.fact_sales()))
_crm("q8_weekend_split", lambda c: sales.weekend_split(c.fact_sales(), c.dim_date()))
_crm("q9_fact_summary", lambda c: sales.fact_summary(c.fact_sales()))
_crm(
    "q10_dim_counts",
    lambda c: sales.dim_counts(
        {
            "dim_customers": c.dim_customers(),
            "dim_products": c.dim_products(),
            "dim_date": c.dim_date(),
        }
    ),
)
_crm(
    "q11_quality_summary",
    lambda c: sales.quality_summary({f"clean_{name}": c.silver(name) for name in CLEANERS}),
)
_crm("q12_quality_buckets", lambda c: sales.quality_buckets(c.silver("crm_cust_info")))
_crm(
    "q12b_quality_buckets_pct",
    lambda c: sales.quality_buckets(c.silver("crm_cust_info"), with_pct=True),
)
_crm(
    "q13_sample_bronze",
    lambda c: marts.sample(
        c.bronze("crm_cust_info"),
        ["cust_id", "cust_name", "email", "city", "customer_type", "status"],
        n=3,
        order=["cust_id"],
    ),
)
_crm(
    "q13b_sample_silver",
    lambda c: marts.sample(
        c.silver("crm_cust_info"),
        ["cust_id", "cust_name", "email", "city", F.round("data_quality_score", 2).alias("quality_score")],
        n=3,
        order=["cust_id"],
    ),
)
_crm(
    "q13c_sample_gold",
    lambda c: marts.sample(
        c.dim_customers(),
        ["customer_id", "customer_name", "city", "region", "is_current"],
        "is_current",
        3,
        ["customer_id", "region"],
    ),
)

# --- verification, rules, metrics -------------------------------------------------------

_shop("x1_batch_audit", lambda s: quality.batch_audit(s.bronze("users")))
_shop("x2_bad_emails", lambda s: quality.dirty_rows(s.bronze("users"), "bad_email", "email"))
_shop("x2b_bad_dates", lambda s: quality.dirty_rows(s.bronze("orders"), "bad_date", "order_date"))
_shop("x2c_negatives", lambda s: quality.dirty_rows(s.bronze("transactions"), "negative", "amount"))
_shop("x2d_null_phones", lambda s: quality.dirty_rows(s.bronze("users"), "null", "phone"))
_shop("x3_duplicate_keys", lambda s: quality.duplicate_keys(s.bronze("users"), "email"))
_shop("x4_schema_table", lambda s: quality.schema_table(s.bronze("users")))


def checked_tables(s: Shop) -> dict[str, DataFrame]:
    return {
        "bronze.users": s.bronze("users"),
        "bronze.orders": s.bronze("orders"),
        "silver.users": s.users(),
        "silver.orders": s.orders(),
        "gold.fact_orders": s.fact_orders(),
    }


_shop("x5_dq_checks", lambda s: quality.run_dq(checked_tables(s)))
_shop("x5b_dq_totals", lambda s: quality.dq_totals(quality.run_dq(checked_tables(s))))


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    tables = checked_tables(Shop(spark, folder))
    return observe.run_alerts(tables, Shop(spark, folder).source("run_log"), OBSERVED_AT)


query("x6_alerts")(_alerts)
query("x6b_alert_summary")(lambda spark, folder: observe.alert_summary(_alerts(spark, folder)))


def _constraints(s: Shop) -> DataFrame:
    """The star schema's declared constraints, as counts of violating rows."""
    history_rows = s.dim_users_history()
    dims = quality.check_constraints(
        history_rows,
        [
            quality.Unique("dim_users key", ("user_sk",)),
            quality.Unique("dim_users user and start", ("user_id", "effective_from")),
            quality.NotNull("dim_users user_id", "user_id"),
            quality.Check("dim_users interval", "effective_to >= effective_from"),
        ],
    )
    facts = quality.check_constraints(
        s.fact_orders(),
        [
            quality.Unique("fact_orders key", ("order_item_sk",)),
            quality.Check("fact_orders quantity", "quantity > 0"),
            quality.NotNull("fact_orders user", "user_sk"),
            quality.ForeignKey("fact_orders product", "product_sk", s.dim_products(), "product_sk"),
            quality.ForeignKey("fact_orders date", "order_date_key", s.dim_date(), "date_key"),
        ],
    )
    return dims.unionByName(facts)


_shop("x7_constraints", _constraints)


def _crm_constraints(c: Crm) -> DataFrame:
    """The CRM track's declared constraints, as counts of violating rows."""
    keys = {
        "crm_cust_info": "cust_id",
        "crm_prd_info": "product_id",
        "crm_sales_details": "transaction_id",
        "erp_cust_az12": "customer_code",
        "erp_loc_a101": "location_id",
        "erp_px_cat_g1v2": "product_code",
    }
    parts = []
    for name, key in keys.items():
        rules = [quality.Unique(f"{name} key", (key,)), quality.NotNull(f"{name} {key}", key)]
        if name == "crm_sales_details":
            rules.append(quality.Check(f"{name} quantity", "quantity > 0"))
        parts.append(quality.check_constraints(c.silver(name), rules))
    customers, products = c.dim_customers(), c.dim_products()
    once_a_day = quality.Unique("dim_customers customer and start", ("customer_id", "effective_date"))
    parts.append(quality.check_constraints(customers, [once_a_day]))
    parents = {
        "date_key": c.dim_date(),
        "customer_key": customers,
        "product_key": products,
    }
    rules = [quality.Unique("fact_sales transaction", ("transaction_id",))]
    for key, parent in parents.items():
        rules.append(quality.NotNull(f"fact_sales {key}", key))
        rules.append(quality.ForeignKey(f"fact_sales parent of {key}", key, parent, key))
    parts.append(quality.check_constraints(c.fact_sales(), rules))
    return reduce(DataFrame.unionByName, parts)


_crm("x7b_crm_constraints", _crm_constraints)


def _inventory(s: Shop) -> DataFrame:
    tables = {f"bronze.{name}": s.bronze(name) for name in KEYS}
    orders = s.orders()
    silver = {
        "users": s.users(),
        "products": s.products(),
        "orders": orders,
        "order_items": s.order_items(orders),
        "transactions": s.transactions(),
    }
    gold = {
        "dim_date": s.dim_date(),
        "dim_users": s.dim_users(),
        "dim_products": s.dim_products(),
        "fact_orders": s.fact_orders(),
        "fact_transactions": s.fact_transactions(),
    }
    tables |= {f"silver.{name}": df for name, df in silver.items()}
    tables |= {f"gold.{name}": df for name, df in gold.items()}
    return observe.layer_inventory(tables)


_shop("x8_layer_inventory", _inventory)
query("x9_recent_runs")(
    lambda spark, folder: observe.recent_runs(run_log(run_events(spark, folder)))
)
_shop(
    "x10_watermarks",
    lambda s: observe.watermark_listing(advance_watermarks(*watermark_state(s), RUN_AT)),
)
query("x11_success_rate")(
    lambda spark, folder: observe.success_rate(Shop(spark, folder).source("run_log"), OBSERVED_AT)
)
_shop("x12_kpis", lambda s: observe.kpis(_inventory(s)))

# --- streams ----------------------------------------------------------------------------


def as_change_events(events: DataFrame) -> DataFrame:
    """The ``events`` table, batch or stream, as change events of one to three rows each."""

    kind = (
        F.when(F.col("event_id") % 3 == 0, "INSERT")
        .when(F.col("event_id") % 3 == 1, "UPDATE")
        .otherwise("DELETE")
    )
    table = (
        F.when(F.col("event_id") % 4 == 0, "crm_cust_info")
        .when(F.col("event_id") % 4 == 1, "crm_sales_details")
        .when(F.col("event_id") % 4 == 2, "cdc_test")
        .otherwise("unwatched")
    )
    schema = F.when(F.col("event_id") % 7 == 3, "silver").otherwise("bronze")
    new, old = F.col("event_type"), F.concat(F.lit("old "), "event_type")

    def row(i):
        def images(status):
            return F.struct((F.col("user_id") + i).alias("row_id"), status.alias("status"))

        update = F.col("event_id") % 3 == 1
        return F.struct(
            F.when(~update, images(new)).alias("values"),
            F.when(update, images(old)).alias("before_values"),
            F.when(update, images(new)).alias("after_values"),
        )

    rows = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 5 % 3), row)
    # Before event_type takes its new meaning: the row images hold the table's own.
    return events.withColumn("rows", rows).select(
        "event_id", kind.alias("event_type"), schema.alias("schema"), table.alias("table"), "rows"
    )


def _events_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = read_table(spark, folder, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )


@query("t1_change_stream")
def _change_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Change files written as JSON lines, then read, routed, exploded, wrapped and stored."""
    work = new_folder(spark, "changes")
    events = as_change_events(read_table(spark, folder, "events"))
    events.write.json(f"{work}/in")
    changes = read_changes(spark, f"{work}/in", events.schema)
    write_changes(capture(changes), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out").drop("timestamp")


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    return as_change_events(read_table(spark, folder, "events"))


query("t2_route")(lambda spark, folder: route(_changes(spark, folder)).drop("rows"))
query("t3_envelope")(
    lambda spark, folder: envelope(explode_rows(_changes(spark, folder))).drop("timestamp")
)
query("t5_explode_rows")(
    lambda spark, folder: explode_rows(_changes(spark, folder)).select(
        "event_id",
        "row_no",
        F.coalesce("row.values.row_id", "row.after_values.row_id").alias("row_id"),
    )
)


@query("t4_resume")
def _resume(spark: SparkSession, folder: str) -> DataFrame:
    """The stream started twice on one checkpoint, with a second file landed in between."""
    work, events = new_folder(spark, "resume"), read_table(spark, folder, "events")
    late = F.col("ts") >= F.lit(datetime(2024, 1, 5))
    for part in (~late | F.col("ts").isNull(), late):
        events.filter(part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        changes = capture(as_change_events(stream))
        write_changes(changes, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{work}/out").drop("timestamp")


@query("t7_apply_changes")
def _apply_changes(spark: SparkSession, folder: str) -> DataFrame:
    """One table's events merged into its state; the later ones are delivered first."""
    work, events = new_folder(spark, "apply"), read_table(spark, folder, "events")
    late = F.col("ts") >= F.lit(datetime(2024, 1, 5))
    for part in (late, ~late | F.col("ts").isNull()):
        events.filter(part).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        rows = explode_rows(route(as_change_events(stream), {"bronze": ["cdc_test"]}))
        apply_changes(rows, f"{work}/state", f"{work}/checkpoint", ["row_id"]).awaitTermination()
    return read_keyed(spark, f"{work}/state")


@query("t6_stream_to_bronze")
def _stream_to_bronze(spark: SparkSession, folder: str) -> DataFrame:
    work = new_folder(spark, "stream-bronze")
    stream = _events_stream(spark, folder)
    stream_to_bronze(
        stream, "public.events", f"{work}/events", f"{work}/checkpoint", ingested_at=RUN_AT
    ).awaitTermination()
    return read_bronze(spark, f"{work}/events").drop("_bronze_id")
