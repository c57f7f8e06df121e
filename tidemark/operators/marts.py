"""Shop-track BI views. Facts are aggregated to the dimension key before the join where
the measures allow it, so hot keys and wide attributes never cross the network row by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_avg, ratio_of

# Order states that do not count as revenue.
NOT_SOLD = ("cancelled", "returned")


def whole(amount: Column) -> Column:
    return F.round(amount, 0).cast("decimal(38,0)")


def revenue_by_month_category(
    fact_orders: DataFrame, dim_date: DataFrame, dim_products: DataFrame
) -> DataFrame:
    """Orders, quantity and revenue per month and category.

    Each order is first summed per category and day (an order has one), which leaves
    the number of orders a plain count.
    """
    sold = fact_orders.filter(~F.col("order_status").isin(*NOT_SOLD))
    products = dim_products.select("product_sk", "category")
    per_order = (
        sold.join(products, "product_sk")
        .groupBy("category", "order_date_key", "order_id")
        .agg(
            F.sum("quantity").alias("qty"),
            F.sum("gross_amount").alias("gross"),
            F.sum("discount_amount").alias("discount"),
            F.sum("net_amount").alias("net"),
        )
    )
    return by_month(per_order.withColumn("orders", F.lit(1)), dim_date)


def by_month(sums: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sums of (category, day, orders, qty, gross, discount, net) per month and category."""
    months = dim_date.select(
        F.col("date_key").alias("order_date_key"), "year", "quarter_name", "month_num", "month_name"
    )
    return (
        sums.join(F.broadcast(months), "order_date_key")
        .groupBy("year", "quarter_name", "month_num", "month_name", "category")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("qty").alias("total_qty"),
            whole(F.sum("gross")).alias("gross_revenue"),
            whole(F.sum("discount")).alias("total_discount"),
            whole(F.sum("net")).alias("net_revenue"),
        )
        .orderBy("year", "month_num", "category")
    )


def user_orders_by_city(fact_orders: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Buyers, orders and revenue per city; the average is per order item.

    Items shrink to one row per order, and orders to one row per user, before the join:
    an order has one user and a user one city, so both counts are plain sums.
    """
    per_order = (
        fact_orders.filter(~F.col("order_status").isin(*NOT_SOLD) & F.col("user_sk").isNotNull())
        .groupBy("user_sk", "order_id")
        .agg(F.sum("net_amount").alias("net"), F.count("net_amount").alias("items"))
    )
    per_user = per_order.groupBy("user_sk").agg(
        F.count("order_id").alias("orders"),
        F.sum("net").alias("net"),
        F.sum("items").alias("items"),
    )
    return (
        per_user.join(dim_users.select("user_sk", "city", "country"), "user_sk")
        .groupBy("city", "country")
        .agg(
            F.count("user_sk").alias("unique_buyers"),
            F.sum("orders").alias("total_orders"),
            whole(F.sum("net")).alias("total_revenue"),
            whole(ratio_of(F.col("net"), F.col("items"))).alias("avg_order_value"),
        )
        .orderBy(F.col("total_revenue").desc(), "city", "country")
    )


def payment_summary(fact_transactions: DataFrame) -> DataFrame:
    return (
        fact_transactions.groupBy("payment_method", "currency", "txn_status")
        .agg(
            F.count("*").alias("txn_count"),
            whole(F.sum("amount_vnd")).alias("total_amount_vnd"),
            whole(exact_avg(F.col("amount_vnd"))).alias("avg_amount_vnd"),
        )
        .orderBy(F.col("total_amount_vnd").desc(), "payment_method", "currency", "txn_status")
    )


def top_products(fact_orders: DataFrame, dim_products: DataFrame, n: int = 10) -> DataFrame:
    """Best delivered products by net revenue."""
    per_product = (
        fact_orders.filter(F.col("order_status") == "delivered")
        .groupBy("product_sk")
        .agg(
            F.sum("quantity").alias("qty"),
            F.sum("net_amount").alias("net"),
            F.sum("unit_price").alias("price"),
            F.count("unit_price").alias("items"),
        )
    )
    names = ["product_name", "category", "subcategory", "gross_margin_pct"]
    return (
        per_product.join(dim_products.select("product_sk", *names), "product_sk")
        .groupBy(*names)
        .agg(
            F.sum("qty").alias("total_qty_sold"),
            whole(F.sum("net")).alias("total_net_revenue"),
            whole(ratio_of(F.col("price"), F.col("items"))).alias("avg_selling_price"),
        )
        .orderBy(F.col("total_net_revenue").desc(), *names)
        .limit(n)
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def sample(
    df: DataFrame,
    columns: Sequence[str | Column],
    where: Column | str | None = None,
    n: int | None = None,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """First ``n`` rows of a projection in a stated order (top-n, no full sort)."""
    rows = df if where is None else df.filter(where)
    rows = rows.orderBy(*order) if order else rows
    rows = rows.select(*columns)
    return rows if n is None else rows.limit(n)
