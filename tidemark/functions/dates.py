"""Date parsing and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted source formats after the year-first one, tried in this order.
DATE_FORMATS = (
    "d/M/yyyy",
    "M-d-yyyy",
    "yyyyMMdd",
    "d MMM yyyy",
    "d MMMM yyyy",
)

# A year-first day, with or without a time; one-digit months and days are accepted.
ISO_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$"


def parse_date(raw: str, order: str = "declared") -> Column:
    """Text (a column name or SQL expression) to DATE; blank, 'N/A' and junk give NULL.

    ``order='mdy_first'`` reads slashed dates as month/day before day/month.
    """
    text = f"trim({raw})"
    formats = DATE_FORMATS if order == "declared" else ("M/d/yyyy", *DATE_FORMATS)
    iso = f"if({text} RLIKE '{ISO_DAY}', try_cast({text} AS date), NULL)"
    tries = ", ".join(f"try_to_date({text}, '{fmt}')" for fmt in formats)
    return F.expr(f"if({text} = '' OR upper({text}) = 'N/A', NULL, coalesce({iso}, {tries}))")


def date_key(day: str) -> Column:
    """DATE (a column name or SQL expression) to the integer yyyymmdd."""
    return F.expr(f"year({day}) * 10000 + month({day}) * 100 + day({day})")
