"""Silver cleaning of the CRM + ERP track: distinct trimmed rows with a quality score.

Scores judge the raw columns, before trimming and defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.text import is_valid_email


def _upper(name: str) -> str:
    return f"trim(upper({name})) AS {name}"


def _trim(name: str, alias: str | None = None) -> str:
    return f"trim({name}) AS {alias or name}"


def _lower(name: str) -> str:
    return f"lower(trim({name})) AS {name}"


def _digits(name: str) -> str:
    return f"regexp_replace({name}, '[^0-9]', '') AS {name}"


def _default(name: str, value: str) -> str:
    return f"coalesce({name}, {value}) AS {name}"


def _score(first: str, second: str, lowest: str) -> str:
    """1.0 when both hold, 0.8 when one does, else the table's lowest score."""
    met = f"if({first}, 1, 0) + if({second}, 1, 0)"
    return (
        f"CAST(element_at(array({lowest}BD, 0.8BD, 1.0BD), {met} + 1) AS decimal(3,2)) "
        "AS data_quality_score"
    )


def _given(name: str) -> str:
    return f"{name} IS NOT NULL"


def clean_crm_cust(bronze: DataFrame, validate_email: bool = True) -> DataFrame:
    """``validate_email`` drops rows whose e-mail is present but malformed."""
    rows = bronze.filter(_given("cust_id"))
    if validate_email:
        rows = rows.filter(f"email IS NULL OR {is_valid_email('email')}")
    return rows.selectExpr(
        _trim("cust_id"),
        _upper("cust_name"),
        _lower("email"),
        _digits("phone"),
        _trim("address", "full_address"),
        _trim("city"),
        _trim("state"),
        _trim("zip_code"),
        "registration_date",
        _default("customer_type", "'UNKNOWN'"),
        _default("status", "'ACTIVE'"),
        _score(_given("email"), _given("phone"), "0.5"),
    ).distinct()


def clean_crm_prd(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter("product_id IS NOT NULL AND unit_price >= 0")
        .selectExpr(
            _trim("product_id"),
            _trim("product_name"),
            _trim("description"),
            _upper("category"),
            _upper("brand"),
            "unit_price",
            _default("currency", "'USD'"),
            _default("status", "'ACTIVE'"),
            _score(_given("description"), _given("brand"), "0.6"),
        )
        .distinct()
    )


def clean_crm_sales(bronze: DataFrame) -> DataFrame:
    linked = "cust_id IS NOT NULL AND product_id IS NOT NULL"
    score = f"CASE WHEN NOT ({linked}) THEN 0.5 WHEN quantity > 0 AND total_amount > 0 THEN 1 ELSE 0.8 END"
    return (
        bronze.filter("transaction_id IS NOT NULL AND quantity > 0 AND total_amount >= 0")
        .selectExpr(
            _trim("transaction_id"),
            "to_date(transaction_date) AS transaction_date",
            _trim("cust_id"),
            _trim("product_id"),
            "quantity",
            "unit_price",
            _default("discount_pct", "CAST(0 AS decimal(5,2))"),
            _default("tax_amount", "CAST(0 AS decimal(18,2))"),
            "total_amount",
            _trim("payment_method"),
            f"CAST({score} AS decimal(3,2)) AS data_quality_score",
        )
        .distinct()
    )


def clean_erp_cust(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter(_given("customer_code"))
        .selectExpr(
            _trim("customer_code"),
            _upper("customer_full_name"),
            _lower("contact_email"),
            _digits("contact_phone"),
            _trim("business_type"),
            _default("credit_limit", "CAST(0 AS decimal(18,2))"),
            _default("account_status", "'ACTIVE'"),
            _score(_given("contact_email"), _given("contact_phone"), "0.6"),
        )
        .distinct()
    )


def clean_erp_loc(bronze: DataFrame) -> DataFrame:
    parts = [f"nullif(trim(address_line{i}), '')" for i in (1, 2)]
    return (
        bronze.filter(_given("location_id"))
        .selectExpr(
            _trim("location_id"),
            _trim("location_name"),
            f"concat_ws(', ', {', '.join(parts)}) AS full_address",
            _trim("city"),
            _trim("state"),
            _trim("country"),
            _trim("postal_code"),
            _upper("region"),
            _score(_given("city"), _given("region"), "0.6"),
        )
        .distinct()
    )


def clean_erp_px(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter(_given("product_code"))
        .selectExpr(
            _trim("product_code"),
            _trim("product_desc"),
            _trim("category_code"),
            _upper("category_name"),
            _upper("subcategory"),
            _default("unit_cost", "CAST(0 AS decimal(18,2))"),
            _default("stock_qty", "0"),
            _default("reorder_level", "0"),
            _score(_given("category_name"), "unit_cost > 0", "0.6"),
        )
        .distinct()
    )
