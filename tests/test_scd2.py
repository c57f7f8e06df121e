import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dims import dim_users_init
from tidemark.operators.facts import with_user_sk, with_user_sk_by_time
from tidemark.operators.scd2 import CUSTOMERS, empty_dimension, history, scd2_changes, scd2_stats, scd2_upsert

USER = (
    "user_id int, full_name string, email string, phone string, city string, country string, "
    "created_date date, is_active boolean, _source_batch_id string"
)


def users(spark, *cities, active=True):
    rows = [
        (i, f"U{i}", f"u{i}@x.com", None, city, "VN", date(2023, 1, i or 1), active, "B")
        for i, city in cities
    ]
    return spark.createDataFrame(rows, USER)


@pytest.fixture(scope="module")
def first(spark):
    return dim_users_init(users(spark, (1, "Hue"), (2, "Hue"), (3, None)), date(2024, 1, 1))


def check_invariants(dim):
    rows = dim.collect()
    current = [r.user_id for r in rows if r.is_current]
    assert len(current) == len(set(current)) == len({r.user_id for r in rows})
    assert len({r.user_sk for r in rows}) == len(rows)
    for user in set(current):
        versions = sorted((r for r in rows if r.user_id == user), key=lambda r: r.user_sk)
        for older, newer in zip(versions, versions[1:], strict=False):
            assert older.effective_to < newer.effective_from and not older.is_current


def test_change_new_and_kept(spark, first):
    source = users(spark, (1, "Hue"), (2, "Da Nang"), (3, None), (4, "Vinh"))
    changes = scd2_changes(first, source, date(2024, 2, 1))
    assert sorted((r.user_id, r._action) for r in changes.collect()) == [
        (1, "kept"),
        (2, "closed"),
        (2, "reopened"),
        (3, "kept"),
        (4, "new"),
    ]
    assert tuple(scd2_stats(changes).first()) == (1, 1)
    dim = scd2_upsert(first, source, date(2024, 2, 1))
    check_invariants(dim)
    two = history(dim, "user_id", 2).collect()
    assert [(r.city, r.effective_from, r.effective_to, r.is_current) for r in two] == [
        ("Hue", date(2023, 1, 2), date(2024, 1, 31), False),
        ("Da Nang", date(2024, 2, 1), None, True),
    ]


def test_rerun_changes_nothing(spark, first):
    source = users(spark, (1, "Hue"), (2, "Da Nang"), (3, "Vinh"), (4, "Vinh"))
    once = scd2_upsert(first, source, date(2024, 2, 1)).checkpoint()
    again = scd2_upsert(once, source, date(2024, 2, 1))
    assert again.exceptAll(once).isEmpty() and once.exceptAll(again).isEmpty()


def test_missing_activity_is_not_a_change(spark):
    source = users(spark, (1, "Hue"), active=None)
    dim = dim_users_init(source, date(2024, 1, 1))
    assert scd2_changes(dim, source, date(2024, 2, 1)).first()._action == "kept"


def test_many_steps_and_as_of_lookup(spark, first):
    dim = first
    for month, city in enumerate(["A", "B", "B", "C"], 2):
        dim = scd2_upsert(dim, users(spark, (1, city), (2, "Hue"), (3, None)), date(2024, month, 1)).checkpoint()
    check_invariants(dim)
    days = spark.createDataFrame(
        [(1, date(2024, 1, 15)), (1, date(2024, 3, 31)), (1, date(2024, 5, 1)), (1, date(2022, 1, 1)), (9, None)],
        "user_id int, day date",
    )
    found = with_user_sk(days, dim, "day").join(dim.select("user_sk", "city"), "user_sk", "left")
    assert sorted((str(r.day), r.city) for r in found.collect()) == [
        ("2022-01-01", None),
        ("2024-01-15", "Hue"),
        ("2024-03-31", "B"),
        ("2024-05-01", "C"),
        ("None", None),
    ]


def test_hot_key_versions(spark, first):
    """A third of the dimension's rows are old versions of one user."""
    old = spark.range(1000).select(
        (F.lit(1 << 20) - 2000 + F.col("id")).alias("user_sk"),
        F.lit(1).alias("user_id"),
        *[F.lit("x").alias(c) for c in ("full_name", "email", "phone", "city", "country")],
        F.lit(True).alias("is_active"),
        F.expr("date_add(DATE'2019-01-01', CAST(id AS INT))").alias("effective_from"),
        F.expr("date_add(DATE'2019-01-01', CAST(id AS INT))").alias("effective_to"),
        F.lit(False).alias("is_current"),
        F.lit("A").alias("_silver_batch"),
    )
    dim = first.unionByName(old)
    after = scd2_upsert(dim, users(spark, (1, "Vinh"), (2, "Hue")), date(2024, 2, 1))
    assert after.count() == 1004
    assert after.filter("user_id = 1 AND is_current").first().city == "Vinh"


WIDE = 1 << 44


def test_keys_of_any_size_never_share_a_surrogate(spark):
    """Natural keys 2^44 apart, also in the versions that follow."""
    keys = [0, 5, WIDE, WIDE + 5, (1 << 63) - 1, -(1 << 63), -1]

    def people(city):
        rows = [(k, "n", None, None, city, None, None, True, "B") for k in keys]
        return spark.createDataFrame(rows, USER.replace("user_id int", "user_id bigint"))

    dim = dim_users_init(people("A"), date(2024, 1, 1))
    for month, city in ((2, "B"), (3, "C")):
        dim = scd2_upsert(dim, people(city), date(2024, month, 1)).checkpoint()
    assert dim.count() == 3 * len(keys)
    check_invariants(dim)
    assert sorted(r.user_sk for r in dim.collect()) == list(range(1, 3 * len(keys) + 1))


def test_repeated_source_keys_are_reduced_or_refused(spark, first):
    source = users(spark, (1, "Vinh"), (1, "Hanoi"), (1, "Hanoi"), (None, "X"), (9, "A"), (9, "B"))
    changes = scd2_changes(first, source, date(2024, 2, 1)).checkpoint()
    assert Counter(r._action for r in changes.collect()) == {"kept": 2, "closed": 1, "reopened": 1, "new": 1}
    check_invariants(changes.drop("_action"))
    # The greatest row of a key stays, whatever the order of arrival.
    assert {r.city for r in changes.filter("user_id IN (1, 9) AND is_current").collect()} == {"Vinh", "B"}
    latest = scd2_changes(first, source, date(2024, 2, 1), best_first=[F.col("city")])
    assert {r.city for r in latest.filter("user_id IN (1, 9) AND is_current").collect()} == {"Hanoi", "A"}
    with pytest.raises(ValueError, match="stands in"):
        scd2_changes(first, source, date(2024, 2, 1), repeated="refuse")
    assert dim_users_init(source, date(2024, 1, 1)).count() == 2


CUSTOMER = "customer_id string, " + ", ".join(
    f"{name} {'date' if name == 'registration_date' else 'decimal(18,2)' if name == 'credit_limit' else 'string'}"
    for name in CUSTOMERS.attributes
)


def customers(spark, **emails):
    rows = [(k, k.lower(), e, *[None] * (len(CUSTOMERS.attributes) - 2)) for k, e in emails.items()]
    return spark.createDataFrame(rows, CUSTOMER)


def test_customers_get_versions(spark):
    start = customers(spark, C1="old", C2="x")
    dim = scd2_upsert(empty_dimension(start, CUSTOMERS), start, date(2024, 1, 1), kind=CUSTOMERS)
    after = scd2_changes(dim, customers(spark, C1="new", C3="z"), date(2024, 2, 1), kind=CUSTOMERS)
    found = history(after, "customer_id", "C1").collect()
    assert [(r.email, r.effective_date, r.end_date, r.is_current) for r in found] == [
        ("old", date(2024, 1, 1), date(2024, 1, 31), False),
        ("new", date(2024, 2, 1), None, True),
    ]
    assert Counter(r._action for r in after.collect()) == {"kept": 1, "closed": 1, "reopened": 1, "new": 1}
    # A change on the day a version began changes it in place, under its key.
    again = scd2_changes(
        after.drop("_action"), customers(spark, C1="newer"), date(2024, 2, 1), kind=CUSTOMERS
    )
    current = again.filter("customer_id = 'C1' AND is_current").first()
    assert (current.email, current._action) == ("newer", "replaced")
    assert current.customer_key == found[1].customer_key and again.count() == after.count()


def test_closed_keys_are_left_alone_or_opened_again(spark):
    start = customers(spark, C1="a", C2="b")
    dim = scd2_upsert(empty_dimension(start, CUSTOMERS), start, date(2024, 1, 1), kind=CUSTOMERS)
    gone = dim.withColumn("is_current", F.col("customer_id") != "C1")
    assert scd2_upsert(gone, start, date(2024, 2, 1), kind=CUSTOMERS).count() == 2
    back = scd2_changes(gone, start, date(2024, 2, 1), kind=CUSTOMERS, revive=True)
    assert back.count() == 3 and back.filter("customer_id = 'C1' AND is_current").count() == 1


def test_as_of_by_time_equals_the_join(spark):
    """Random versions and days, nulls, gaps, a version that ends before it starts; spans of any length."""
    rng, versions, number = random.Random(4), [], 0
    start = date(2020, 1, 1)
    for user in range(12):
        at = start + timedelta(days=rng.randint(0, 300))
        for _ in range(rng.randint(0, 9)):
            until = at + timedelta(days=rng.randint(-1, 90))
            number += 1
            versions.append((user, number, at, until if rng.random() < 0.9 else None))
            if versions[-1][3] is None:
                break
            at = max(at, until + timedelta(days=rng.choice([1, 1, 40])))
    dim = spark.createDataFrame(versions, "user_id bigint, user_sk bigint, effective_from date, effective_to date")
    rows = [(i, rng.randint(0, 14), start + timedelta(days=rng.randint(-20, 900)), "x") for i in range(800)]
    rows += [(900, None, start, "y"), (901, 3, None, "z"), (902, None, None, None), (5, *rows[5][1:])]
    facts = spark.createDataFrame(rows, "order_id bigint, user_id int, day date, version string")
    wanted = Counter(map(tuple, with_user_sk(facts, dim, "day").collect()))
    for span in (1, 32, 5000):
        assert Counter(map(tuple, with_user_sk_by_time(facts, dim, "day", span).collect())) == wanted
    assert sum(r[-1] is not None for r in wanted) > 200


def test_as_of_by_time_with_very_many_versions(spark):
    """One user with 100,000 versions and 20,000 orders: as many rows as orders leave each step."""
    versions = spark.range(100_000).selectExpr(
        "1L AS user_id", "id AS user_sk", "date_add(DATE'1800-01-01', CAST(id AS INT)) AS effective_from",
        "date_add(DATE'1800-01-01', CAST(id AS INT)) AS effective_to",
    )
    facts = spark.range(20_000).selectExpr("id AS order_id", "1L AS user_id", "date_add(DATE'1900-01-01', CAST(id * 3 AS INT)) AS day")
    found = with_user_sk_by_time(facts, versions, "day")
    days = (date(1900, 1, 1) - date(1800, 1, 1)).days
    bad = found.filter((F.col("user_sk") != F.col("order_id") * 3 + days) | F.col("user_sk").isNull())
    assert found.count() == 20_000
    assert bad.filter(F.col("order_id") * 3 + days < 100_000).isEmpty()
