"""Bronze verification, data-quality rules and constraint checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import money, percentage


def batch_audit(bronze: DataFrame) -> DataFrame:
    """Ingest window and size of each batch, newest first."""
    return (
        bronze.groupBy("_batch_id", "_source_table")
        .agg(
            F.min("_ingested_at").alias("batch_start"),
            F.max("_ingested_at").alias("batch_end"),
            F.count("*").alias("row_count"),
        )
        .orderBy(F.col("batch_start").desc(), "_batch_id")
    )


def dirty_rows(bronze: DataFrame, kind: str, column: str, n: int | None = 10) -> DataFrame:
    """Evidence that Bronze kept dirty values; ``n`` limits the report, None lists all.

    kind: 'bad_email' (no @), 'bad_date' (not yyyy-mm-dd), 'negative', 'null' (a count).
    """
    value = F.col(column)
    if kind == "null":
        return bronze.agg(F.count_if(value.isNull()).alias(f"null_{column}_count"))
    found = {
        "bad_email": ~value.contains("@"),
        "bad_date": ~value.rlike(r"^\d{4}-\d{2}-\d{2}\z"),
        "negative": F.expr(f"{money(column)} < 0"),
    }[kind]
    rows = bronze.filter(found).select("_batch_id", column)
    return rows if n is None else rows.orderBy("_batch_id", column).limit(n)


def duplicate_keys(bronze: DataFrame, key: str, n: int | None = 10) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    repeated = (
        bronze.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("cnt"))
        .filter("cnt > 1")
        .orderBy(F.col("cnt").desc(), key)
    )
    return repeated if n is None else repeated.limit(n)


def schema_table(df: DataFrame) -> DataFrame:
    """Columns and types in order, with the number of rows that fill each."""
    fields = list(enumerate(df.schema.fields, 1))
    filled = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in fields])
    lines = [
        F.struct(
            F.lit(i).alias("ordinal_position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("filled_rows"),
        )
        for i, f in fields
    ]
    return filled.select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class DqRule:
    layer: str
    table: str
    min_rows: int
    null_col: str | None = None
    max_null_pct: float = 5.0
    dup_col: str | None = None
    max_dup_pct: float = 5.0


# The standard rule set.
DQ_RULES = (
    DqRule("bronze", "bronze.users", 1000, "email", 5.0, "user_id", 10.0),
    DqRule("bronze", "bronze.orders", 5000, "order_date", 5.0, "order_id", 10.0),
    DqRule("silver", "silver.users", 500, "email", 3.0, "user_id", 0.0),
    DqRule("silver", "silver.orders", 4000, "order_date", 2.0, "order_id", 0.0),
    DqRule("gold", "gold.fact_orders", 10000, "order_date_key", 0.0, "order_item_sk", 0.0),
)


def null_percentage(column: str) -> Column:
    return percentage(F.count_if(F.col(column).isNull()), F.count("*"))


def run_dq(tables: Mapping[str, DataFrame], rules: Sequence[DqRule] = DQ_RULES) -> DataFrame:
    """One row per check: layer, table, check, column, value, threshold, status.

    Each table is aggregated once for all of its checks.
    """
    return reduce(DataFrame.unionByName, [_checks(tables[rule.table], rule) for rule in rules])


def _checks(df: DataFrame, rule: DqRule) -> DataFrame:
    measures = [F.count("*").cast("double").alias("rows")]
    checks = [("row_count", None, "rows", float(rule.min_rows), True)]
    if rule.null_col:
        measures.append(null_percentage(rule.null_col).cast("double").alias("nulls"))
        checks.append(("null_pct", rule.null_col, "nulls", rule.max_null_pct, False))
    if rule.dup_col:
        surplus = F.count("*") - F.count_distinct(F.col(rule.dup_col))
        measures.append(percentage(surplus, F.count("*")).cast("double").alias("dups"))
        checks.append(("dup_pct", rule.dup_col, "dups", rule.max_dup_pct, False))
    lines = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).cast("string").alias("column"),
                F.col(value).alias("value"),
                F.lit(threshold).alias("threshold"),
                F.when(
                    F.col(value) >= threshold if at_least else F.col(value) <= threshold, "PASS"
                )
                .otherwise("FAIL")
                .alias("status"),
            )
            for check, column, value, threshold, at_least in checks
        ]
    )
    return df.agg(*measures).select(
        F.lit(rule.layer).alias("layer"), F.lit(rule.table).alias("table"), F.inline(lines)
    )


def dq_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )


# Which flag column feeds which column of the report.
_REPORT_FLAGS = {
    "users": {
        "bad_email": "_flag_bad_email",
        "bad_date": "_flag_bad_date",
        "bad_phone": "_flag_bad_phone",
    },
    "products": {"bad_amount": "_flag_negative_price"},
    "orders": {"bad_date": "_flag_bad_date", "bad_amount": "_flag_negative_amount"},
    "transactions": {"bad_date": "_flag_bad_date", "bad_amount": "_flag_negative_amount"},
}


def dq_report(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts before and after cleaning and flag totals; NULL where a flag does not apply."""
    parts = []
    for entity, flags in _REPORT_FLAGS.items():
        totals = [
            (F.coalesce(F.sum(flags[name]), F.lit(0)) if name in flags else F.first(F.lit(None)))
            .cast("bigint")
            .alias(name)
            for name in ("bad_email", "bad_date", "bad_phone", "bad_amount")
        ]
        parts.append(
            silver[entity]
            .agg(F.count("*").alias("silver_count"), *totals)
            .select(
                F.lit(entity).alias("entity"),
                bronze[entity].agg(F.count("*")).scalar().alias("bronze_count"),
                "*",
            )
        )
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Unique:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str


@dataclass(frozen=True)
class Check:
    """A SQL condition that must not be false; unknown passes, as in a CHECK constraint."""

    name: str
    condition: str


@dataclass(frozen=True)
class ForeignKey:
    name: str
    column: str
    parent: DataFrame
    parent_column: str


def check_constraints(
    df: DataFrame, constraints: Sequence[Unique | NotNull | Check | ForeignKey]
) -> DataFrame:
    """Violating rows per constraint (for Unique: rows beyond the first of each key).

    All constraints are checked in one pass: each row becomes one tagged entry (rule, key,
    count) per constraint, the parents' keys come beside them, and entries are counted
    map-side before the only shuffle. So the table and each parent are read once.
    """
    entries, parents = [], []
    for rule, c in enumerate(constraints):
        key, n = F.lit(None).cast("string"), F.lit(1).cast("bigint")
        if isinstance(c, Unique):
            key = _text_of(c.columns)
        elif isinstance(c, ForeignKey):
            key = F.col(c.column).cast("string")
            n = F.col(c.column).isNotNull().cast("bigint")
            parent = F.col(c.parent_column).cast("string").alias("key")
            parents.append(c.parent.select(F.lit(rule).alias("rule"), parent, _count(0), _count(1, "parents")))
        else:
            n = F.coalesce(_violates(c).cast("bigint"), F.lit(0).cast("bigint"))
        entries.append(F.struct(F.lit(rule).alias("rule"), key.alias("key"), n.alias("n")))
    rows = df.select(F.inline(F.array(*entries))).withColumn("parents", F.lit(0).cast("bigint"))
    # One entry of each rule, so that an empty table has its zeros.
    seeds = df.sparkSession.range(len(constraints)).select(
        F.col("id").cast("int").alias("rule"), F.lit(None).cast("string").alias("key"), _count(0), _count(0, "parents")
    )
    counted = (
        reduce(DataFrame.unionByName, [rows, seeds, *parents])
        .groupBy("rule", "key")
        .agg(F.sum("n").alias("n"), F.sum("parents").alias("parents"))
    )

    def of_kind(kind: type) -> Column:
        numbers = [i for i, c in enumerate(constraints) if isinstance(c, kind)]
        return F.col("rule").isin(numbers) if numbers else F.lit(False)

    zero = F.lit(0).cast("bigint")
    broken = (
        F.when(of_kind(Unique), F.greatest(F.col("n") - 1, zero))
        .when(of_kind(ForeignKey), F.when(F.col("parents") == 0, F.col("n")).otherwise(zero))
        .otherwise(F.col("n"))
    )
    names = F.array(*[F.lit(c.name) for c in constraints])
    return (
        counted.groupBy("rule")
        .agg(F.sum(broken).alias("violations"))
        .select(F.get(names, F.col("rule")).alias("constraint"), "violations")
    )


def _count(value: int, name: str = "n") -> Column:
    return F.lit(value).cast("bigint").alias(name)


def _text_of(columns: Sequence[str]) -> Column:
    """A text that two rows share exactly if they agree in the columns, nulls included."""
    texts = [F.col(name).cast("string") for name in columns]
    parts = [F.coalesce(F.concat(F.length(x), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.concat(*parts)


def _violates(constraint: NotNull | Check) -> Column:
    if isinstance(constraint, NotNull):
        return F.col(constraint.column).isNull()
    return ~F.expr(constraint.condition)
