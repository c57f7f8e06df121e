from datetime import datetime

import pytest

from tidemark.operators import observe, quality
from tidemark.schemas import RUN_EVENT
from tidemark.sources.watermarks import run_log

AT = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, None if i < 3 else f"m{i}") for i in range(10)] + [(9, "m9")]
    return spark.createDataFrame(rows, "id int, email string")


def test_dq_checks(table):
    rules = [quality.DqRule("bronze", "t", 11, "email", 30.0, "id", 5.0)]
    got = quality.run_dq({"t": table}, rules)
    assert [(r["check"], r.value, r.status) for r in got.collect()] == [
        ("row_count", 11, "PASS"),
        ("null_pct", 27.27, "PASS"),
        ("dup_pct", 9.09, "FAIL"),
    ]
    assert tuple(quality.dq_totals(got).first()) == (2, 1)


def test_empty_table_is_zero_percent(table):
    rules = [quality.DqRule("bronze", "t", 1, "email", 0.0, "id", 0.0)]
    got = quality.run_dq({"t": table.filter("id < 0")}, rules).collect()
    assert [(r.value, r.status) for r in got] == [(0, "FAIL"), (0, "PASS"), (0, "PASS")]


def test_alerts(spark, table):
    log = spark.createDataFrame(
        [("FAILED", datetime(2024, 1, 30, 12)), ("ROLLED_BACK", datetime(2024, 1, 30, 13)), ("FAILED", datetime(2024, 1, 29))],
        "status string, started_at timestamp_ntz",
    )
    rules = [
        observe.AlertRule("volume", "WARNING", "t", min_rows=12),
        observe.AlertRule("nulls", "CRITICAL", "t", null_col="email", max_null_pct=50.0),
        observe.AlertRule("runs", "CRITICAL"),
    ]
    got = {r.rule: r for r in observe.run_alerts({"t": table}, log, AT, rules).collect()}
    assert {name: (r.value, r.ok) for name, r in got.items()} == {
        "volume": (11, False),
        "nulls": (27.27, True),
        "runs": (1, False),
    }
    assert got["volume"].message == "t has 11 rows (min 12)"
    both = observe.run_alerts({"t": table}, log, AT, rules, statuses=("FAILED", "ROLLED_BACK"))
    assert both.filter("rule = 'runs'").first().value == 2
    assert tuple(observe.alert_summary(both).first()) == (1, 2, "CRITICAL")
    rate = observe.success_rate(log, AT).first()
    assert tuple(rate) == (0, 2, 2, 0.0, "red")
    assert observe.success_rate(log.limit(0), AT).first().rate == 0


def test_constraints(spark, table):
    parent = spark.createDataFrame([(i,) for i in range(8)], "id int")
    got = quality.check_constraints(
        table,
        [
            quality.Unique("unique", ("id",)),
            quality.NotNull("filled", "email"),
            quality.Check("small", "id < 9"),
            quality.Check("unknown passes", "email <> 'm4'"),
            quality.ForeignKey("parent", "id", parent, "id"),
        ],
    )
    assert {r.constraint: r.violations for r in got.collect()} == {
        "unique": 1,
        "filled": 3,
        "small": 2,
        "unknown passes": 1,
        "parent": 3,
    }


def test_dirty_rows_and_duplicates(spark):
    rows = [("A", "x", "2024-01-01", "-1"), ("A", "a@b", "2024-1-1", "2"), ("B", None, None, None), ("B", "a@b", "x\n", "0")]
    bronze = spark.createDataFrame(rows, "_batch_id string, email string, day string, amount string")
    assert [r.email for r in quality.dirty_rows(bronze, "bad_email", "email").collect()] == ["x"]
    assert quality.dirty_rows(bronze, "bad_date", "day", None).count() == 2
    assert [r.amount for r in quality.dirty_rows(bronze, "negative", "amount").collect()] == ["-1"]
    assert quality.dirty_rows(bronze, "null", "email").first()[0] == 1
    assert [tuple(r) for r in quality.duplicate_keys(bronze, "email").collect()] == [("a@b", 2)]


def test_run_log_folds_events(spark):
    def at(second):
        return datetime(2024, 1, 1, 0, 0, second)

    events = [
        (1, "B", "t", "RUNNING", None, None, at(0)),
        (1, "B", "t", "ROLLED_BACK", None, "boom", at(2)),
        (1, "B", "t", "SUCCESS", 5, None, at(5)),
        (2, "B", "u", "RUNNING", None, None, at(1)),
        (3, "B", "v", "SUCCESS", 0, None, at(1)),
        (3, "B", "v", "RUNNING", None, None, at(1)),
    ]
    got = {r.log_id: r for r in run_log(spark.createDataFrame(events, RUN_EVENT)).collect()}
    assert (got[1].status, got[1].rows_loaded, got[1].error_message, got[1].duration_sec) == ("SUCCESS", 5, None, 5.0)
    assert (got[2].status, got[2].finished_at, got[2].duration_sec) == ("RUNNING", None, None)
    assert (got[3].status, got[3].duration_sec) == ("SUCCESS", 0.0)
