"""Text cleaning expressions.

Arguments are column names or SQL expressions; each result is one parsed expression.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the e-mail shape. "\z" is the true end of the text; Java's "$"
# would also accept a trailing line break.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\z"


def is_valid_email(email: str) -> str:
    """SQL condition: the text is an e-mail address; NULL for NULL."""
    return f"rlike({email}, r'{EMAIL_PATTERN}')"


def valid_email(email: str) -> Column:
    """The address itself, or NULL when malformed."""
    return F.expr(f"if({is_valid_email(email)}, {email}, NULL)")


def normalise_phone(raw: str) -> Column:
    """National 10-digit form starting with 0, or NULL."""
    digits = f"regexp_replace({raw}, '[^0-9]', '')"
    national = f"regexp_replace({digits}, '^84(?=[0-9]{{9}}$)', '0')"
    return F.expr(f"nullif(regexp_extract({national}, '^0[0-9]{{9}}$', 0), '')")


def blank_to(raw: str, default: str) -> Column:
    return F.expr(f"coalesce(nullif(trim({raw}), ''), '{default}')")


def parse_bool(raw: str) -> Column:
    return F.expr(
        f"CASE WHEN lower({raw}) IN ('true', 't', '1', 'yes') THEN true "
        f"WHEN lower({raw}) IN ('false', 'f', '0', 'no') THEN false END"
    )


def replace_values(value: str, mapping: Mapping[str, str]) -> Column:
    """Exact-match replacement; anything not listed stays as it is."""
    cases = " ".join(f"WHEN '{wrong}' THEN '{right}'" for wrong, right in mapping.items())
    return F.expr(f"CASE {value} {cases} ELSE {value} END")


def flag(condition: str) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.expr(f"if({condition}, 1, 0)")
