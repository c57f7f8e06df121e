"""Exact money arithmetic: decimals throughout, so sums do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts below 10^28: times a percentage they still fit the 38 digits there are.
MONEY = "decimal(30,2)"


def typed_key(raw: str) -> str:
    """SQL expression: text as a whole-number key of 64 bits, NULL when it is none."""
    return f"try_cast({raw} AS bigint)"


def money(raw: str) -> str:
    """SQL expression: text as money, NULL when it is not a number."""
    return f"try_cast({raw} AS {MONEY})"


def whole(raw: str) -> str:
    """SQL expression: text as a 64-bit whole number ('2.0' is 2), NULL when it is none."""
    wide = f"try_cast({raw} AS decimal(38,6))"
    return f"coalesce(try_cast({raw} AS bigint), if({wide} = floor({wide}), try_cast({wide} AS bigint), NULL))"


def lost_as_money(raw: str) -> str:
    """SQL condition: the text is there, but money cannot hold it: no number, too large, or
    so small that it would become zero."""
    return (
        f"({raw} IS NOT NULL AND ({money(raw)} IS NULL "
        f"OR ({money(raw)} = 0 AND try_cast({raw} AS double) <> 0)))"
    )


def lost_as_whole(raw: str) -> str:
    """SQL condition: the text is there, but is no 64-bit whole number."""
    return f"({raw} IS NOT NULL AND {whole(raw)} IS NULL)"


def lost_as_number(raw: str) -> str:
    """SQL condition: the text is there, but is no number of any size."""
    return f"({raw} IS NOT NULL AND (try_cast({raw} AS double) IS NULL OR isnan(try_cast({raw} AS double))))"


def product(count: str, price: str) -> str:
    """SQL expression: a count times a price as money, NULL when it does not fit."""
    return f"try_cast(try_multiply({count}, {price}) AS {MONEY})"


def positive_or_null(amount: str) -> Column:
    return F.expr(f"if({amount} > 0, {amount}, NULL)")


def percent_of(amount: str, percent: str) -> Column:
    """``percent`` of the amount as money, rounded half up.

    Multiplies by 0.01 where a division would shorten the decimals.
    """
    return F.expr(f"CAST(round({amount} * {percent} * 0.01BD, 2) AS {MONEY})")


def exact_avg(amount: Column) -> Column:
    """Mean as a wide decimal; AVG keeps four extra digits only, too few to round safely."""
    return F.try_divide(F.sum(amount), F.count(amount))


def ratio_of(total: Column, count: Column) -> Column:
    """The mean from a sum and a count that were aggregated in an earlier step."""
    return F.try_divide(F.sum(total), F.sum(count))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole rounded half up; 0 on an empty whole."""
    share = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.round(F.coalesce(share, F.lit(0).cast("decimal(20,0)")), digits)
