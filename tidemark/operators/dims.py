"""Gold dimensions. Their size follows the data, so joins to them carry no broadcast hint:
Spark broadcasts a side below its measured threshold and shuffles (splitting skew) beyond it."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import dense_keys
from tidemark.operators.scd2 import USERS, scd2_init
from tidemark.sources.tables import absent_from


def dim_users_init(users: DataFrame, as_of: date) -> DataFrame:
    """First load: every clean user is current since its creation (or the load) date."""
    return scd2_init(users, as_of, USERS)


def dim_products(products: DataFrame) -> DataFrame:
    """Shop products; the natural key serves as surrogate."""
    price, cost = F.col("unit_price"), F.col("cost_price")
    # Scaled before the division, which keeps six digits behind the point only.
    margin = (F.round((price - cost) * 10_000 / price, 0) * F.lit(Decimal("0.01"))).cast("decimal(38,2)")
    return products.select(
        F.col("product_id").alias("product_sk"),
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "unit_price",
        "cost_price",
        F.when(price > 0, margin).alias("gross_margin_pct"),
        "stock_qty",
        "supplier",
    )


def _insert_new(
    rows: DataFrame, existing: DataFrame | None, mode: str, name: str, key: str, as_of: date
) -> DataFrame:
    """Open one version for each distinct row whose key the dimension lacks, and number them.

    The bucket for numbering is taken from the whole row: rows are distinct, so the
    buckets stay even although a key may come with very many rows.
    """
    if existing is not None:
        known = existing.filter("is_current") if mode == "full_outer" else existing
        rows = absent_from(rows, known, [key])
    new = rows.distinct().selectExpr(
        "*",
        f"DATE'{as_of.isoformat()}' AS effective_date",
        "CAST(NULL AS DATE) AS end_date",
        "true AS is_current",
    )
    return dense_keys(new, name, rows.columns, after=existing)


def _with_right_only(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> tuple[DataFrame, DataFrame]:
    """Both halves of a full outer join: left rows with their match, and unmatched right rows.

    Unlike one full join, either half can broadcast a small side, and Spark can split
    a hot key in both.
    """
    matched = left.join(right, F.col(left_key) == F.col(right_key), "left")
    alone = absent_from(right, left.select(F.col(left_key).alias(right_key)), [right_key])
    return matched, alone


def customer_rows(crm: DataFrame, erp: DataFrame, loc: DataFrame) -> DataFrame:
    """CRM customers with their ERP match and the city's region, then ERP customers unknown to CRM."""
    crm = crm.drop("data_quality_score")
    # Distinct first: a city with many branches must not multiply its customers.
    regions = loc.select(F.col("city").alias("_city"), "region").distinct()
    matched, alone = _with_right_only(
        crm, erp.drop("data_quality_score"), "cust_id", "customer_code"
    )
    both = matched.join(regions, F.col("city") == F.col("_city"), "left").selectExpr(
        "cust_id AS customer_id",
        "coalesce(cust_name, customer_full_name) AS customer_name",
        "coalesce(email, contact_email) AS email",
        "coalesce(phone, contact_phone) AS phone",
        "full_address",
        "city",
        "state",
        "zip_code",
        "region",
        "customer_type",
        "business_type",
        "credit_limit",
        "registration_date",
        "coalesce(status, account_status) AS status",
    )
    erp_only = alone.selectExpr(
        "customer_code AS customer_id",
        "customer_full_name AS customer_name",
        "contact_email AS email",
        "contact_phone AS phone",
        "business_type",
        "credit_limit",
        "account_status AS status",
    )
    return both.unionByName(erp_only, allowMissingColumns=True)


def dim_customers(
    crm: DataFrame,
    erp: DataFrame,
    loc: DataFrame,
    as_of: date,
    existing: DataFrame | None = None,
    mode: str = "union",
) -> DataFrame:
    """New customer rows to insert.

    ``mode='union'`` skips keys the dimension holds in any version, ``'full_outer'``
    those it holds as current. Changed customers are left as they are; ``scd2_changes`` over
    ``customer_rows`` versions them.
    """
    rows = customer_rows(crm, erp, loc)
    return _insert_new(rows, existing, mode, "customer_key", "customer_id", as_of)


def product_rows(crm: DataFrame, erp: DataFrame, mode: str = "union") -> DataFrame:
    """CRM products with their ERP match, then ERP products unknown to CRM.

    ``'union'`` fills currency 'VND' and status 'ACTIVE', ``'full_outer'`` leaves NULL.
    """
    currency, status = ("'VND'", "'ACTIVE'") if mode == "union" else ("NULL", "NULL")
    matched, alone = _with_right_only(
        crm.drop("data_quality_score"),
        erp.drop("data_quality_score"),
        "product_id",
        "product_code",
    )
    both = matched.selectExpr(
        "product_id",
        "coalesce(product_name, product_desc) AS product_name",
        "description",
        "coalesce(category, category_name) AS category",
        "subcategory",
        "brand",
        "unit_price",
        "unit_cost",
        f"coalesce(currency, {currency}) AS currency",
        f"coalesce(status, {status}) AS status",
    )
    erp_only = alone.selectExpr(
        "product_code AS product_id",
        "product_desc AS product_name",
        "category_name AS category",
        "subcategory",
        "unit_cost",
        f"CAST({currency} AS STRING) AS currency",
        f"CAST({status} AS STRING) AS status",
    )
    return both.unionByName(erp_only, allowMissingColumns=True)


def dim_products_crm(
    crm: DataFrame,
    erp: DataFrame,
    as_of: date,
    existing: DataFrame | None = None,
    mode: str = "union",
) -> DataFrame:
    """New product rows to insert; modes as in ``dim_customers`` and ``product_rows``."""
    rows = product_rows(crm, erp, mode)
    return _insert_new(rows, existing, mode, "product_key", "product_id", as_of)
