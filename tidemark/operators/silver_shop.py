"""Silver cleaning of the shop track: snapshot, dedup, typed projection with flags.

``recency`` orders the rows of one key, best first, and must be a total order; the
default is the Bronze surrogate. ``mode='latest_per_key'`` reads all batches and
keeps the newest version of each key, which is what incremental batches need;
``'latest_batch'`` reads the newest batch only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_date
from tidemark.functions.numbers import (
    MONEY,
    lost_as_money,
    lost_as_number,
    lost_as_whole,
    money,
    positive_or_null,
    product,
    typed_key,
    whole,
)
from tidemark.functions.text import (
    blank_to,
    flag,
    is_valid_email,
    normalise_phone,
    parse_bool,
    replace_values,
    valid_email,
)
from tidemark.operators.dedup import keep_best, latest_batch, newest_bronze_row

# Misspelt order states and currency codes.
STATUS_TYPOS = {
    "peding": "pending",
    "shiped": "shipped",
    "deliverd": "delivered",
    "canceld": "cancelled",
}
CURRENCY_ALIASES = {"VN": "VND", "US": "USD"}


def _rows_per_key(
    bronze: DataFrame,
    key: str,
    batch_id: str | None,
    mode: str,
    recency: Sequence[Column] | None,
    entity: str,
) -> DataFrame:
    """The snapshot with one row per key; callers type the key in their projection.

    Typing the key after the dedup makes later joins shuffle anew. That costs a shuffle of the
    projected columns, and lets adaptive execution split a hot key in those joins:
    it cannot split a partition that the dedup's window was built on.
    """
    order = list(recency or newest_bronze_row())
    if mode == "latest_per_key":
        rows, order = bronze, [F.col("_ingested_at").desc(), *order]
    else:
        rows = latest_batch(bronze, batch_id)
    return keep_best(_readable(rows, entity), [key], order)


# The key columns of each source, its own key first.
ENTITY_KEYS = {
    "users": ("user_id",),
    "products": ("product_id",),
    "orders": ("order_id", "user_id"),
    "order_items": ("item_id", "order_id", "product_id"),
    "transactions": ("txn_id", "order_id", "user_id"),
}


# Numbers of each source that Silver would have to change to store them.
LOST_NUMBERS = {
    "users": (),
    "products": (lost_as_money("unit_price"), lost_as_money("cost_price"), lost_as_whole("stock_qty")),
    "orders": (lost_as_money("total_amount"), lost_as_number("discount")),
    "order_items": (
        lost_as_whole("quantity"),
        lost_as_money("unit_price"),
        f"{product(whole('quantity'), money('unit_price'))} IS NULL "
        "AND quantity IS NOT NULL AND unit_price IS NOT NULL",
    ),
    "transactions": (lost_as_money("amount"),),
}


def _unreadable(entity: str) -> Column:
    """Whether a row has a key that is there but no whole number, or a number that Silver cannot keep."""
    bad = [f"({k} IS NOT NULL AND {typed_key(k)} IS NULL)" for k in ENTITY_KEYS[entity]]
    return F.expr(" OR ".join(f"coalesce({x}, false)" for x in (*bad, *LOST_NUMBERS[entity])))


def rejected_rows(bronze: DataFrame, entity: str) -> DataFrame:
    """The Bronze rows that Silver leaves out because a key or number cannot be read or kept.

    Silver never replaces such a number by another value. An older row of the same key
    that can be kept stays in Silver.
    """
    return bronze.filter(_unreadable(entity))


def _readable(rows: DataFrame, entity: str) -> DataFrame:
    """Rows fit for Silver; the rest is what ``rejected_rows`` returns."""
    return rows.filter(~_unreadable(entity))


def _in_silver(rows: DataFrame, condition: str, left_out: str | None) -> DataFrame:
    """The rows that meet a condition, or all of them with a flag on those that do not."""
    if left_out is None:
        return rows.filter(condition)
    return rows.withColumn(left_out, F.expr(f"NOT ({condition})"))


def _named(left_out: str | None) -> list[str]:
    return [] if left_out is None else [left_out]


def dedup_users(
    bronze: DataFrame,
    batch_id: str | None = None,
    mode: str = "latest_batch",
    recency: Sequence[Column] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per e-mail, the most complete first.

    All rows without an e-mail count as one key unless ``keep_null_keys``.
    """
    order = list(recency or newest_bronze_row())
    if mode == "latest_per_key":
        rows = _rows_per_key(bronze, "user_id", None, mode, order, "users")
    else:
        rows = _readable(latest_batch(bronze, batch_id), "users")
    email = F.lower(F.trim("email"))
    key = [email]
    if keep_null_keys:
        key.append(F.when(email.isNull(), F.col("user_id")))
    complete_first = [F.col(name).isNotNull().desc() for name in ("phone", "city", "country")]
    return keep_best(rows, key, [*complete_first, *order])


def clean_users(
    bronze: DataFrame,
    batch_id: str | None = None,
    mode: str = "latest_batch",
    recency: Sequence[Column] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    rows = dedup_users(bronze, batch_id, mode, recency, keep_null_keys)
    email = "lower(trim(email))"
    return rows.select(
        F.expr(typed_key("user_id")).alias("user_id"),
        F.initcap(F.trim("full_name")).alias("full_name"),
        valid_email(email).alias("email"),
        normalise_phone("phone").alias("phone"),
        blank_to("city", "Unknown").alias("city"),
        blank_to("country", "Unknown").alias("country"),
        parse_date("created_at").alias("created_date"),
        parse_bool("is_active").alias("is_active"),
        F.col("_batch_id").alias("_source_batch_id"),
        flag(f"NOT {is_valid_email(email)}").alias("_flag_bad_email"),
        F.col("phone").alias("_raw_phone"),
    ).selectExpr(
        "* EXCEPT (_raw_phone)",
        "if(created_date IS NULL, 1, 0) AS _flag_bad_date",
        "if(phone IS NULL AND _raw_phone IS NOT NULL, 1, 0) AS _flag_bad_phone",
    )


def clean_products(
    bronze: DataFrame,
    batch_id: str | None = None,
    mode: str = "latest_batch",
    recency: Sequence[Column] | None = None,
) -> DataFrame:
    price = money("unit_price")
    return _rows_per_key(bronze, "product_id", batch_id, mode, recency, "products").select(
        F.expr(typed_key("product_id")).alias("product_id"),
        F.trim("product_name").alias("product_name"),
        blank_to("category", "Uncategorized").alias("category"),
        blank_to("subcategory", "Other").alias("subcategory"),
        positive_or_null(price).alias("unit_price"),
        positive_or_null(money("cost_price")).alias("cost_price"),
        F.expr(f"greatest({whole('stock_qty')}, 0)").alias("stock_qty"),
        blank_to("supplier", "Unknown").alias("supplier"),
        F.col("_batch_id").alias("_source_batch_id"),
        flag(f"{price} <= 0").alias("_flag_negative_price"),
    )


def clean_orders(
    bronze: DataFrame,
    batch_id: str | None = None,
    mode: str = "latest_batch",
    recency: Sequence[Column] | None = None,
    left_out: str | None = None,
) -> DataFrame:
    """Orders with a user; the discount is forced into 0..100 and a missing one is 0.

    ``left_out`` names a flag to be set on newest rows without a user, instead of leaving them out.
    """
    amount = money("total_amount")
    # A discount too large for the decimal is still more than 100, or less than 0.
    far = "if(try_cast(discount AS double) > 0, 100, 0)"
    discount = f"coalesce(try_cast(discount AS decimal(18,6)), {far})"
    return (
        _rows_per_key(bronze, "order_id", batch_id, mode, recency, "orders")
        .transform(_in_silver, "user_id IS NOT NULL", left_out)
        .select(
            F.expr(typed_key("order_id")).alias("order_id"),
            F.expr(typed_key("user_id")).alias("user_id"),
            parse_date("order_date").alias("order_date"),
            replace_values("lower(trim(status))", STATUS_TYPOS).alias("status"),
            blank_to("shipping_city", "Unknown").alias("shipping_city"),
            positive_or_null(amount).alias("total_amount"),
            F.expr(f"CAST(round(least(greatest({discount}, 0), 100), 2) AS decimal(5,2))").alias(
                "discount_pct"
            ),
            F.col("_batch_id").alias("_source_batch_id"),
            *_named(left_out),
            flag(f"{amount} <= 0").alias("_flag_negative_amount"),
        )
        .withColumn("_flag_bad_date", flag("order_date IS NULL"))
    )


def clean_order_items(
    bronze: DataFrame,
    orders: DataFrame | None,
    batch_id: str | None = None,
    mode: str = "latest_batch",
    recency: Sequence[Column] | None = None,
    left_out: str | None = None,
) -> DataFrame:
    """Items of clean orders, with the subtotal recomputed from quantity and price.

    ``orders=None`` leaves the order check to a caller that joins to the clean
    orders anyway, which saves the semi join. ``left_out`` names a flag to be set on newest
    rows without an order or product, instead of leaving them out.
    """
    items = (
        _rows_per_key(bronze, "item_id", batch_id, mode, recency, "order_items")
        .transform(_in_silver, "order_id IS NOT NULL AND product_id IS NOT NULL", left_out)
        .select(
            F.expr(typed_key("item_id")).alias("item_id"),
            F.expr(typed_key("order_id")).alias("order_id"),
            F.expr(typed_key("product_id")).alias("product_id"),
            F.expr(f"greatest({whole('quantity')}, 1)").alias("quantity"),
            F.expr(f"CAST(greatest({money('unit_price')}, 0) AS {MONEY})").alias("unit_price"),
            F.col("_batch_id").alias("_source_batch_id"),
            *_named(left_out),
        )
        .withColumn("subtotal_calculated", F.expr(product("quantity", "unit_price")))
    )
    if orders is None:
        return items
    return items.join(orders.select("order_id"), "order_id", "left_semi").select(items.columns)


def clean_transactions(
    bronze: DataFrame,
    batch_id: str | None = None,
    mode: str = "latest_batch",
    recency: Sequence[Column] | None = None,
) -> DataFrame:
    amount = money("amount")
    return (
        _rows_per_key(bronze, "txn_id", batch_id, mode, recency, "transactions")
        .select(
            F.expr(typed_key("txn_id")).alias("txn_id"),
            F.expr(typed_key("order_id")).alias("order_id"),
            F.expr(typed_key("user_id")).alias("user_id"),
            parse_date("txn_date").alias("txn_date"),
            positive_or_null(amount).alias("amount"),
            F.lower(F.trim("payment_method")).alias("payment_method"),
            F.lower(F.trim("status")).alias("status"),
            replace_values("upper(trim(currency))", CURRENCY_ALIASES).alias("currency"),
            F.col("_batch_id").alias("_source_batch_id"),
                flag(f"{amount} <= 0").alias("_flag_negative_amount"),
        )
        .withColumn("_flag_bad_date", flag("txn_date IS NULL"))
    )


def standardise_dates(df: DataFrame, column: str, order: str = "declared") -> DataFrame:
    """Add ``<column>_parsed`` and ``<column>_bad``; blank or missing input counts as bad."""
    parsed = f"{column}_parsed"
    return df.withColumn(parsed, parse_date(column, order)).withColumn(
        f"{column}_bad", flag(f"{parsed} IS NULL")
    )


def validate_emails(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_valid`` (lower-case address or NULL) and ``<column>_bad``; NULL is not bad."""
    email = f"lower(trim({column}))"
    return df.withColumn(f"{column}_valid", valid_email(email)).withColumn(
        f"{column}_bad", flag(f"NOT {is_valid_email(email)}")
    )


def normalise_phones(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_normal`` and ``<column>_bad``; NULL is not bad."""
    normal = f"{column}_normal"
    return df.withColumn(normal, normalise_phone(column)).withColumn(
        f"{column}_bad", flag(f"{normal} IS NULL AND {column} IS NOT NULL")
    )
