from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, parse_date
from tidemark.functions.numbers import exact_avg, percentage
from tidemark.functions.text import is_valid_email, normalise_phone, parse_bool


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(expression.alias("r"), "i").orderBy("i").collect()]


@pytest.mark.parametrize("order, slashed", [("declared", date(2024, 3, 5)), ("mdy_first", date(2024, 5, 3))])
def test_parse_date(spark, order, slashed):
    texts = [
        "2024-03-25", " 25/03/2024", "03-25-2024", "20240325", "25 Mar 2024", "25 March 2024",
        "05/03/2024", "N/A", "n/a ", "", "  ", None, "garbage", "2024-13-45",
    ]
    good = date(2024, 3, 25)
    assert evaluate(spark, texts, parse_date("v", order)) == [good] * 6 + [slashed] + [None] * 7


def test_parse_times_and_single_digits(spark):
    texts = [
        "2024-03-05 10:00:00", "2024-03-05T23:59:59.123", "2024-3-5", "5/3/2024", "5 Mar 2024",
        "2024-03-05 junk", "2024-03", "2024", "2024-03-05 10:00:00 and more",
    ]
    assert evaluate(spark, texts, parse_date("v")) == [date(2024, 3, 5)] * 5 + [None] * 4


def test_date_key(spark):
    assert evaluate(spark, [date(2024, 3, 5), None], date_key("v"), "date") == [20240305, None]


def test_email(spark):
    texts = ["a.b+c%d_e-f@x-y.co", "a@b", "a@@b.com", "a@b.com..", "invalid-email", "a@b.c", "a@b.com\n", None]
    assert evaluate(spark, texts, F.expr(is_valid_email("v"))) == [True] + [False] * 6 + [None]


def test_phone(spark):
    texts = ["+84 912345678", "84912345678", "0912-345-678", "12345", "1912345678", "849123456789", "", None]
    good = "0912345678"
    assert evaluate(spark, texts, normalise_phone("v")) == [good] * 3 + [None] * 5


def test_bool(spark):
    texts = ["True", "t", "1", "YES", "false", "F", "0", "no", "maybe", None]
    expected = [True] * 4 + [False] * 4 + [None] * 2
    assert evaluate(spark, texts, parse_bool("v")) == expected


def test_averages_do_not_round_twice(spark):
    # mean 1.00499999…: rounding to six digits first would give 1.01
    df = spark.range(1, 3000001).selectExpr("CAST(IF(id <= 14999, 2.00, 1.00) AS DECIMAL(18,2)) AS v")
    assert str(df.agg(F.round(exact_avg(F.col("v")), 2)).first()[0]) == "1.00"
    empty = df.filter("v < 0").agg(exact_avg(F.col("v")), percentage(F.count("*"), F.count("*"))).first()
    assert empty[0] is None and float(empty[1]) == 0
