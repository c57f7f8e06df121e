"""The CRM + ERP track end to end."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dim_date import dim_date
from tidemark.operators.dims import customer_rows, dim_customers, dim_products_crm, product_rows
from tidemark.operators.facts import fact_sales
from tidemark.operators.scd2 import CUSTOMERS, PRODUCTS, Dimension, empty_dimension, scd2_changes, scd2_upsert
from tidemark.operators.silver_crm import (
    clean_crm_cust,
    clean_crm_prd,
    clean_crm_sales,
    clean_erp_cust,
    clean_erp_loc,
    clean_erp_px,
)
from tidemark.plans import once
from tidemark.sources.bindings import bind
from tidemark.sources.tables import if_stored, overwrite, read_table
from tidemark.sources.watermarks import logged_step

CLEANERS = {
    "crm_cust_info": clean_crm_cust,
    "crm_prd_info": clean_crm_prd,
    "crm_sales_details": clean_crm_sales,
    "erp_cust_az12": clean_erp_cust,
    "erp_loc_a101": clean_erp_loc,
    "erp_px_cat_g1v2": clean_erp_px,
}
AS_OF = date(2024, 1, 31)


@dataclass(frozen=True)
class Crm:
    """The layers over six Bronze frames; every method returns a lazy frame."""

    spark: SparkSession
    bronze: Callable[[str], DataFrame]

    @classmethod
    def over(cls, spark: SparkSession, folder: str) -> Crm:
        table = cache(partial(read_table, spark, folder))
        return cls(spark, cache(partial(bind, table)))

    @once
    def silver(self, name: str) -> DataFrame:
        return CLEANERS[name](self.bronze(name))

    @once
    def dim_date(self) -> DataFrame:
        return dim_date(self.spark, style="fiscal")

    @once
    def dim_customers(self, mode: str = "union", existing: DataFrame | None = None) -> DataFrame:
        return dim_customers(
            self.silver("crm_cust_info"),
            self.silver("erp_cust_az12"),
            self.silver("erp_loc_a101"),
            AS_OF,
            existing,
            mode,
        )

    @once
    def dim_products(self, mode: str = "union", existing: DataFrame | None = None) -> DataFrame:
        return dim_products_crm(
            self.silver("crm_prd_info"), self.silver("erp_px_cat_g1v2"), AS_OF, existing, mode
        )

    @once
    def customer_changes(self) -> DataFrame:
        """SCD2 step: every seventh customer is unknown so far, every ninth got a new e-mail address."""
        rows = customer_rows(
            self.silver("crm_cust_info"), self.silver("erp_cust_az12"), self.silver("erp_loc_a101")
        )
        number = F.regexp_extract("customer_id", "[0-9]+", 0).cast("bigint")
        first = scd2_upsert(empty_dimension(rows, CUSTOMERS), rows.filter(number % 7 != 0), AS_OF, kind=CUSTOMERS)
        moved = F.when(number % 9 == 0, F.concat(F.lit("new"), number, F.lit("@example.com")))
        second = rows.withColumn("email", F.coalesce(moved, "email"))
        return scd2_changes(first, second, AS_OF + timedelta(days=1), kind=CUSTOMERS)

    @once
    def fact_sales(self, existing: DataFrame | None = None) -> DataFrame:
        return fact_sales(
            self.silver("crm_sales_details"), self.dim_customers(), self.dim_products(), existing
        )


def run_load(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    lake: str,
    as_of: date,
    clock: Callable[[], datetime] = datetime.now,
    calendar: tuple[date, date] | None = None,
    changes: str = "version",
) -> None:
    """Rebuild Silver and bring Gold up to it; each step reads back what the last one stored.

    A customer or product that changed gets a new version from ``as_of`` on;
    ``changes='insert'`` only adds keys Gold does not hold. Sales are added once, under the
    versions current then. A repeated load adds nothing. ``calendar`` sets the
    first and last day of the date dimension; both procedures write their start and end to
    the ETL log.
    """
    if changes not in ("version", "insert"):
        raise ValueError(f"unknown way with changes: {changes}")
    control = f"{lake}/control"
    with logged_step(spark, control, "sp_load_silver", "SILVER", clock) as step:
        silver = {
            name: overwrite(clean(bronze[name]), f"{lake}/silver/clean_{name}")
            for name, clean in CLEANERS.items()
        }
        step.rows = sum(df.count() for df in silver.values())

    with logged_step(spark, control, "sp_load_gold", "GOLD", clock) as step:
        gold = f"{lake}/gold"
        days = {"start": calendar[0], "end": calendar[1]} if calendar else {}
        overwrite(dim_date(spark, style="fiscal", **days), f"{gold}/dim_date")
        customers, products, sales = (
            if_stored(lambda name=name: spark.read.parquet(f"{gold}/{name}"))
            for name in ("dim_customers", "dim_products", "fact_sales")
        )
        parts = (silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"])
        items = (silver["crm_prd_info"], silver["erp_px_cat_g1v2"])
        if changes == "version":
            customers = _next_state(customer_rows(*parts), customers, CUSTOMERS, f"{gold}/dim_customers", as_of)
            products = _next_state(product_rows(*items), products, PRODUCTS, f"{gold}/dim_products", as_of)
        else:
            customers = _append(dim_customers(*parts, as_of, customers), f"{gold}/dim_customers")
            products = _append(dim_products_crm(*items, as_of, products), f"{gold}/dim_products")
        facts = _append(
            fact_sales(silver["crm_sales_details"], customers, products, sales), f"{gold}/fact_sales"
        )
        step.rows = sum(df.count() for df in (customers, products, facts))


def _next_state(
    rows: DataFrame, stored: DataFrame | None, kind: Dimension, path: str, as_of: date
) -> DataFrame:
    """The dimension after this load, stored in place of the one before."""
    before = empty_dimension(rows, kind) if stored is None else stored
    return overwrite(scd2_upsert(before, rows, as_of, kind=kind), path)


def _append(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)
