"""Gold facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.functions.numbers import MONEY, percent_of
from tidemark.sources.tables import absent_from

# Demo exchange rates to VND.
VND_RATES = {"USD": 24500, "EUR": 26800}


def with_user_sk(
    df: DataFrame, dim_users: DataFrame, day: str | None = None
) -> DataFrame:
    """Left-join the user's surrogate: the current version, or the one valid on ``day``."""
    if day is None:
        versions = dim_users.filter("is_current").select("user_id", "user_sk")
        return df.join(versions, "user_id", "left")
    versions = dim_users.select(
        F.col("user_id").alias("_id"), "user_sk", "effective_from", "effective_to"
    )
    valid = (F.col("effective_from") <= F.col(day)) & (
        F.col("effective_to").isNull() | (F.col(day) <= F.col("effective_to"))
    )
    return df.join(versions, (F.col("user_id") == F.col("_id")) & valid, "left").select(
        *df.columns, "user_sk"
    )


SPAN_DAYS = 32  # days of a key that one task orders


def with_user_sk_by_time(df: DataFrame, dim_users: DataFrame, day: str, span: int = SPAN_DAYS) -> DataFrame:
    """Left-join the surrogate of the version valid on ``day``, by merging along time.

    The result of ``with_user_sk`` for versions that do not overlap, at a cost that does
    not grow with facts times versions of a key: facts and versions are put in one order
    within (key, span of days), where each fact takes the last version that began, and a
    span without one takes it over from the spans before. A key with very many versions or
    facts is spread over its spans. Versions that end before they start are never valid.
    """
    version = F.struct("user_sk", F.col("effective_to").alias("until"))
    kind = df.schema["user_id"].dataType.simpleString()
    versions = dim_users.filter("effective_to IS NULL OR effective_to >= effective_from").select(
        F.col("user_id").cast(kind).alias("key"), F.col("effective_from").alias("at"), version.alias("version")
    )
    dated = F.col("user_id").isNotNull() & F.col(day).isNotNull()
    facts = df.filter(dated).select(
        F.col("user_id").alias("key"), F.col(day).cast("date").alias("at"), F.struct("*").alias("row")
    )
    place = F.floor(F.unix_date("at") / span)
    both = (
        versions.filter("key IS NOT NULL AND at IS NOT NULL")
        .unionByName(facts, allowMissingColumns=True)
        .withColumn("place", place)
    )
    begun = F.when(F.col("version").isNotNull(), F.struct("at", "version.user_sk"))
    ends = both.groupBy("key", "place").agg(F.max_by("version", begun).alias("last"))
    earlier = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "place", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    # At one instant versions come before facts.
    within = Window.partitionBy("key", "place").orderBy("at", F.col("row").isNotNull(), "version.user_sk")
    found = F.last("version", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    told = both.withColumn("found", found).filter(F.col("row").isNotNull()).join(carried, ["key", "place"])
    valid = F.coalesce("found", "carried")
    surrogate = F.when(valid["until"].isNull() | (F.col("at") <= valid["until"]), valid["user_sk"])
    rest = df.filter(~dated).withColumn("user_sk", F.lit(None).cast("bigint"))
    return told.select("row.*", surrogate.alias("user_sk")).unionByName(rest)


def fact_orders(
    items: DataFrame, orders: DataFrame, dim_users: DataFrame, lookup: str = "current"
) -> DataFrame:
    """Grain: order item. The user is looked up per order, before the join fans out to items.

    ``lookup`` takes the user's 'current' version, or the one valid on the day of the order: 'as_of' by
    a join on the key, 'as_of_merge' along time, for users with very many versions.
    """
    usable = orders.filter(F.col("order_date").isNotNull() & F.col("total_amount").isNotNull())
    narrow = usable.select("order_id", "user_id", "order_date", "status", "shipping_city", "discount_pct")
    if lookup == "as_of_merge":
        o = with_user_sk_by_time(narrow, dim_users, "order_date")
    else:
        o = with_user_sk(narrow, dim_users, "order_date" if lookup == "as_of" else None)
    gross, discount = "subtotal_calculated", "coalesce(discount_pct, 0)"
    return items.join(o, "order_id").select(
        F.col("item_id").alias("order_item_sk"),
        "order_id",
        date_key("order_date").alias("order_date_key"),
        "user_sk",
        F.col("product_id").alias("product_sk"),
        F.col("status").alias("order_status"),
        "shipping_city",
        "quantity",
        "unit_price",
        F.col(gross).alias("gross_amount"),
        percent_of(gross, discount).alias("discount_amount"),
        percent_of(gross, f"(100 - {discount})").alias("net_amount"),
    )


def fact_transactions(
    transactions: DataFrame, dim_users: DataFrame, rates: Mapping[str, int] = VND_RATES
) -> DataFrame:
    """Grain: payment. Amounts in a listed currency are converted and rounded to whole VND."""
    usable = transactions.filter(F.col("txn_date").isNotNull() & F.col("amount").isNotNull())
    amount_vnd = F.col("amount")
    for currency, rate in rates.items():
        amount_vnd = F.when(
            F.col("currency") == currency,
            F.round(F.col("amount") * F.lit(rate), 0).cast("decimal(38,2)"),
        ).otherwise(amount_vnd)
    return with_user_sk(usable, dim_users).select(
        F.col("txn_id").alias("txn_sk"),
        "order_id",
        date_key("txn_date").alias("txn_date_key"),
        "user_sk",
        "payment_method",
        F.col("status").alias("txn_status"),
        "currency",
        "amount",
        amount_vnd.alias("amount_vnd"),
    )


def fact_sales(
    sales: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Grain: sale. Rows to insert: known current customer and product, transaction not loaded."""
    new = sales if existing is None else absent_from(sales, existing, ["transaction_id"])
    customers = dim_customers.filter("is_current").select(
        F.col("customer_id").alias("cust_id"), "customer_key"
    )
    products = dim_products.filter("is_current").select("product_id", "product_key")
    full_price = f"CAST(unit_price * quantity AS {MONEY})"
    return (
        new.join(customers, "cust_id")
        .join(products, "product_id")
        .select(
            "transaction_id",
            date_key("transaction_date").alias("date_key"),
            "customer_key",
            "product_key",
            "quantity",
            "unit_price",
            percent_of(full_price, "discount_pct").alias("discount_amount"),
            "tax_amount",
            "total_amount",
            "payment_method",
        )
    )
