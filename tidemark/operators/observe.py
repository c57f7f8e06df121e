"""Alert rules and run metrics. ``as_of`` replaces the wall clock."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import percentage
from tidemark.operators.quality import null_percentage


@dataclass(frozen=True)
class AlertRule:
    """A row minimum, a null-share maximum, or (without a table) failed runs in a day."""

    name: str
    severity: str
    table: str | None = None
    min_rows: int = 0
    null_col: str | None = None
    max_null_pct: float = 5.0


# The standard rule set.
ALERT_RULES = (
    AlertRule("bronze_users_volume", "WARNING", "bronze.users", min_rows=1000),
    AlertRule(
        "silver_users_null_email", "CRITICAL", "silver.users", null_col="email", max_null_pct=5.0
    ),
    AlertRule("gold_fact_orders_volume", "CRITICAL", "gold.fact_orders", min_rows=10000),
    AlertRule("pipeline_recent_failure", "CRITICAL"),
)


def _recent(run_log: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    started, until = F.col("started_at"), F.lit(as_of).cast("timestamp_ntz")
    since = F.lit(as_of - timedelta(hours=hours)).cast("timestamp_ntz")
    return run_log.filter((started > since) & (started <= until))


def run_alerts(
    tables: Mapping[str, DataFrame],
    run_log: DataFrame,
    as_of: datetime,
    rules: Sequence[AlertRule] = ALERT_RULES,
    statuses: Sequence[str] = ("FAILED",),
) -> DataFrame:
    """The alerts table: one row per rule with its measured value, verdict and message.

    A rolled-back run is not a failure unless ``statuses`` lists it. Tables named by
    several rules are measured once.
    """
    lines: list[DataFrame] = []
    for table in dict.fromkeys(rule.table for rule in rules):
        of_table = [rule for rule in rules if rule.table == table]
        if table is None:
            recent = _recent(run_log, as_of)
            failed = F.count_if(F.col("status").isin(*statuses))
            measured = recent.agg(*[failed.cast("double").alias(rule.name) for rule in of_table])
        else:
            measured = tables[table].agg(*[_measure(rule).alias(rule.name) for rule in of_table])
        lines.append(measured.select(F.inline(F.array(*[_verdict(rule) for rule in of_table]))))
    return reduce(DataFrame.unionByName, lines)


def _measure(rule: AlertRule) -> Column:
    value = null_percentage(rule.null_col) if rule.null_col else F.count("*")
    return value.cast("double")


def _verdict(rule: AlertRule) -> Column:
    value = F.col(rule.name)
    if rule.table is None:
        threshold, ok = 0.0, value <= 0
        text = F.concat(F.format_number(value, 0), F.lit(" runs failed in the last 24 hours"))
    elif rule.null_col:
        threshold, ok = rule.max_null_pct, value <= rule.max_null_pct
        text = F.concat(
            F.lit(f"{rule.table}.{rule.null_col} is "),
            F.format_number(value, 2),
            F.lit(f"% null (max {rule.max_null_pct:.2f}%)"),
        )
    else:
        threshold, ok = float(rule.min_rows), value >= rule.min_rows
        text = F.concat(
            F.lit(f"{rule.table} has "),
            F.format_number(value, 0),
            F.lit(f" rows (min {rule.min_rows:,})"),
        )
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.table).cast("string").alias("table"),
        F.lit(rule.severity).alias("severity"),
        value.alias("value"),
        F.lit(threshold).alias("threshold"),
        ok.alias("ok"),
        text.alias("message"),
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Passed and failed rules; any failure makes the run CRITICAL."""
    return alerts.agg(
        F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed")
    ).withColumn("severity", F.when(F.col("failed") > 0, "CRITICAL").otherwise("INFO"))


def layer_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (layer, table) for tables named 'layer.table'."""
    parts = []
    for name, df in tables.items():
        layer, table = name.split(".")
        parts.append(
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
            )
        )
    return reduce(DataFrame.unionByName, parts).orderBy("layer", "table_name")


def recent_runs(run_log: DataFrame, n: int = 10) -> DataFrame:
    return (
        run_log.select(
            "log_id", "batch_id", "table_name", "status", "rows_loaded", "duration_sec", "started_at"
        )
        .orderBy(F.col("log_id").desc())
        .limit(n)
    )


def watermark_listing(watermarks: DataFrame) -> DataFrame:
    return watermarks.select("table_name", "last_loaded_at", "last_row_count").orderBy("table_name")


def success_rate(run_log: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """Recent successes, failures (rolled back included), total, rate and its colour band."""
    status = F.col("status")
    counts = _recent(run_log, as_of, hours).agg(
        F.count_if(status == "SUCCESS").alias("success"),
        F.count_if(status.isin("FAILED", "ROLLED_BACK")).alias("failed"),
        F.count("*").alias("total"),
    )
    rate = percentage(F.col("success"), F.col("total"), 1).cast("double")
    band = F.when(F.col("rate") >= 90, "green").when(F.col("rate") >= 70, "orange").otherwise("red")
    return counts.withColumn("rate", rate).withColumn("band", band)


def kpis(inventory: DataFrame) -> DataFrame:
    """Headline totals over the layer inventory: all Bronze rows, all Gold fact rows."""
    is_fact = (F.col("layer") == "gold") & F.col("table_name").contains("fact")
    rows = F.col("row_count")
    return inventory.agg(
        F.coalesce(F.sum(F.when(F.col("layer") == "bronze", rows)), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum(F.when(is_fact, rows)), F.lit(0)).alias("gold_fact_rows"),
    )
