"""CRM-track analytic queries over the sales star.

Sales are summed per dimension key before the dimension is joined: counts, sums and
distinct keys all survive that step, and the join then moves one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_avg, percentage, ratio_of


def _cents(amount: Column) -> Column:
    return F.round(amount, 2).cast("decimal(38,2)")


SALES, UNITS, AMOUNT = "_sales", "_units", "_amount"


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count("*").alias(SALES),
        F.sum("quantity").alias(UNITS),
        F.sum("total_amount").alias(AMOUNT),
    )


def _by_current(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    current = dim.filter("is_current").select(key, *columns)
    return _per_key(fact, key).join(current, key)


def _count() -> Column:
    return F.sum(SALES)


def _revenue() -> Column:
    return _cents(F.sum(AMOUNT))


def _average() -> Column:
    return _cents(ratio_of(F.col(AMOUNT), F.col(SALES)))


def top_customers(
    fact: DataFrame,
    customers: DataFrame,
    n: int = 5,
    by: Sequence[str] = ("customer_name", "city", "region"),
) -> DataFrame:
    return (
        _by_current(fact, customers, "customer_key", by)
        .groupBy(*by)
        .agg(_count().alias("total_purchases"), _revenue().alias("total_spent"))
        .orderBy(F.col("total_spent").desc(), *by)
        .limit(n)
    )


def top_products_sold(fact: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    by = ["product_name", "category", "brand"]
    return (
        _by_current(fact, products, "product_key", by)
        .groupBy(*by)
        .agg(
            _count().alias("times_sold"),
            F.sum(UNITS).alias("total_quantity"),
            _revenue().alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), *by)
        .limit(n)
    )


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "year", "month", "month_name")
    return (
        _per_key(fact, "date_key")
        .join(F.broadcast(days), "date_key")
        .groupBy("year", "month", "month_name")
        .agg(_count().alias("transaction_count"), _revenue().alias("monthly_revenue"))
        .orderBy("year", "month")
    )


def sales_by_region(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _by_current(fact, customers, "customer_key", ["region"])
        .groupBy("region")
        .agg(
            F.count("customer_key").alias("unique_customers"),
            _count().alias("total_transactions"),
            _revenue().alias("total_revenue"),
            _average().alias("avg_transaction_value"),
        )
        .orderBy(F.col("total_revenue").desc(), "region")
    )


def category_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _by_current(fact, products, "product_key", ["category"])
        .groupBy("category")
        .agg(
            F.count("product_key").alias("product_count"),
            _count().alias("total_sales"),
            F.sum(UNITS).alias("units_sold"),
            _revenue().alias("revenue"),
            _average().alias("avg_sale_value"),
        )
        .orderBy(F.col("revenue").desc(), "category")
    )


def category_brand_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _by_current(fact, products, "product_key", ["category", "brand"])
        .groupBy("category", "brand")
        .agg(
            _count().alias("total_sales"),
            F.sum(UNITS).alias("total_quantity"),
            _revenue().alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), "category", "brand")
    )


def customer_segments(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _by_current(fact, customers, "customer_key", ["customer_type"])
        .groupBy("customer_type")
        .agg(
            F.count("customer_key").alias("customer_count"),
            _count().alias("total_purchases"),
            _average().alias("avg_purchase_value"),
            _revenue().alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), "customer_type")
    )


def payment_methods(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("payment_method")
        .agg(
            F.count("*").alias("transaction_count"),
            _cents(F.sum("total_amount")).alias("total_amount"),
            _cents(exact_avg(F.col("total_amount"))).alias("avg_amount"),
        )
        .orderBy(F.col("total_amount").desc(), "payment_method")
    )


def weekend_split(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    day_type = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type")
    return (
        _per_key(fact, "date_key")
        .join(F.broadcast(dim_date.select("date_key", "is_weekend")), "date_key")
        .groupBy(day_type)
        .agg(
            _count().alias("transactions"),
            _revenue().alias("revenue"),
            _average().alias("avg_transaction"),
        )
    )


def fact_summary(fact: DataFrame) -> DataFrame:
    amount = F.col("total_amount")
    return fact.agg(
        F.count("*").alias("total_transactions"),
        F.sum("quantity").alias("total_items_sold"),
        _cents(F.sum(amount)).alias("total_revenue"),
        _cents(exact_avg(amount)).alias("avg_transaction"),
        _cents(F.min(amount)).alias("min_transaction"),
        _cents(F.max(amount)).alias("max_transaction"),
    )


def dim_counts(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Total, current and historical rows; a dimension without versions is all current."""
    result = None
    for name, dim in dims.items():
        current = F.col("is_current") if "is_current" in dim.columns else F.lit(True)
        row = dim.agg(
            F.count("*").alias("total_records"),
            F.count_if(current).alias("current_records"),
            F.count_if(~current).alias("historical_records"),
        ).select(F.lit(name).alias("dimension"), "*")
        result = row if result is None else result.unionByName(row)
    return result


def quality_summary(silver: Mapping[str, DataFrame]) -> DataFrame:
    result = None
    for name, df in silver.items():
        row = df.agg(
            F.count("*").alias("row_count"),
            _cents(exact_avg(F.col("data_quality_score"))).alias("avg_quality"),
        ).select(F.lit(name).alias("table_name"), "*")
        result = row if result is None else result.unionByName(row)
    return result


def quality_buckets(silver: DataFrame, with_pct: bool = False) -> DataFrame:
    """Rows per quality level, best first; optionally with their share of all rows."""
    score = F.col("data_quality_score")
    level = (
        F.when(score >= 0.9, "Excellent (>=0.9)")
        .when(score >= 0.7, "Good (0.7-0.9)")
        .when(score >= 0.5, "Fair (0.5-0.7)")
        .otherwise("Poor (<0.5)")
    )
    buckets = silver.groupBy(level.alias("quality_level")).agg(
        F.count("*").alias("record_count"), F.min(score).alias("_lowest")
    )
    columns = ["quality_level", "record_count"]
    if with_pct:
        # A window over the (at most four) levels, not a second pass over the rows.
        total = F.sum("record_count").over(Window.partitionBy())
        share = percentage(F.col("record_count"), total)
        buckets = buckets.withColumn("percentage", share.cast("decimal(5,2)"))
        columns.append("percentage")
    return buckets.orderBy(F.col("_lowest").desc()).select(*columns)
