from datetime import date, datetime
from decimal import Context, Decimal

from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_best, latest_batch
from tidemark.operators.facts import fact_orders, fact_transactions
from tidemark.operators.silver_shop import (
    clean_order_items,
    clean_orders,
    clean_products,
    clean_transactions,
    clean_users,
    rejected_rows,
)
from tidemark.plans.shop import Shop
from tidemark.sources.bronze import to_bronze, with_bronze_id

AT = datetime(2024, 1, 1)
EXACT = Context(prec=60)


def bronze(spark, columns, rows, batch="A", at=AT):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))
    return with_bronze_id(to_bronze(df.coalesce(1), "public.t", batch, at))


USER = "user_id full_name email phone city country created_at is_active"
ORDER = "order_id user_id order_date status shipping_city total_amount discount"


def test_users(spark):
    rows = [
        ("1", " an  BINH ", " A@x.com ", "84912345678", " ", None, "N/A", "yes"),
        ("2", "b", "a@X.com", None, "Hue", "VN", "2024-01-02", "no"),
        ("3", "c", "bad", "123", "Hue", "VN", "20240102", "?"),
        ("4", "d", None, None, None, "VN", None, None),
        ("5", "e", None, "0912345678", None, "VN", "", None),
    ]
    got = {r.user_id: r for r in clean_users(bronze(spark, USER, rows)).collect()}
    # 1 wins over 2 (has a phone); of the rows without e-mail only 5 stays
    assert sorted(got) == [1, 3, 5]
    one = got[1]
    assert (one.full_name, one.email, one.phone) == ("An  Binh", "a@x.com", "0912345678")
    assert (one.city, one.country, one.created_date, one.is_active) == ("Unknown", "Unknown", None, True)
    assert (one._flag_bad_email, one._flag_bad_date, one._flag_bad_phone) == (0, 1, 0)
    assert (got[3].email, got[3]._flag_bad_email, got[3]._flag_bad_phone) == (None, 1, 1)
    assert (got[5]._flag_bad_email, got[5].is_active) == (0, None)
    kept = clean_users(bronze(spark, USER, rows), keep_null_keys=True)
    assert sorted(r.user_id for r in kept.collect()) == [1, 3, 4, 5]


def test_products(spark):
    rows = [
        ("1", " p ", "", None, "-5", "0", "-3", " "),
        ("2", "q", "c", "s", "0", None, None, "x"),
        ("2", "q2", "c", "s", "9.99", "4.5", "7", "x"),
    ]
    columns = "product_id product_name category subcategory unit_price cost_price stock_qty supplier"
    got = {r.product_id: r for r in clean_products(bronze(spark, columns, rows)).collect()}
    assert tuple(got[1])[1:8] == ("p", "Uncategorized", "Other", None, None, 0, "Unknown")
    assert got[1]._flag_negative_price == 1
    assert (got[2].product_name, got[2].unit_price) == ("q2", Decimal("9.99"))


def test_orders(spark):
    rows = [
        ("1", "7", "25/03/2024", " Peding", None, "10", None),
        ("2", "7", "N/A", "SHIPED", "Hue", "0", "-4"),
        ("3", "7", "2024-03-25", "canceld", "Hue", None, "250"),
        ("4", "7", "2024-03-25", "new", "Hue", "-1", "12.345"),
        ("5", None, "2024-03-25", "new", "Hue", "1", "1"),
    ]
    got = {r.order_id: r for r in clean_orders(bronze(spark, ORDER, rows)).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert [got[i].status for i in (1, 2, 3, 4)] == ["pending", "shipped", "cancelled", "new"]
    assert [float(got[i].discount_pct) for i in (1, 2, 3, 4)] == [0, 0, 100, 12.35]
    assert [got[i]._flag_bad_date for i in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert [got[i]._flag_negative_amount for i in (1, 2, 3, 4)] == [0, 1, 0, 1]
    assert [got[i].total_amount is None for i in (1, 2, 3, 4)] == [False, True, True, True]
    assert got[1].order_date == date(2024, 3, 25)


def test_items_and_transactions(spark):
    items = bronze(
        spark,
        "item_id order_id product_id quantity unit_price",
        [
            ("1", "1", "5", None, "2.50"),
            ("2", "1", "5", "3", "-1"),
            ("3", "9", "5", "3", "1"),
            ("4", "1", None, "3", "1"),
            ("5", "1", "6", "4", "1.25"),
        ],
    )
    orders = spark.createDataFrame([(1,)], "order_id int")
    got = {r.item_id: r for r in clean_order_items(items, orders).collect()}
    assert sorted(got) == [1, 2, 5]
    assert [float(got[i].subtotal_calculated) for i in (1, 2, 5)] == [2.5, 0, 5]
    assert clean_order_items(items, None).count() == 4

    payments = bronze(
        spark,
        "txn_id order_id user_id txn_date amount payment_method status currency",
        [("1", "1", "1", "2024-01-01", "-5", " COD ", "Failed ", "vn "), ("2", None, None, "", "5", "x", "y", "eur")],
    )
    got = {r.txn_id: r for r in clean_transactions(payments).collect()}
    assert (got[1].amount, got[1].payment_method, got[1].status, got[1].currency) == (None, "cod", "failed", "VND")
    assert (got[2].currency, got[2]._flag_bad_date, got[1]._flag_negative_amount) == ("EUR", 1, 1)


def test_modes_over_batches(spark):
    old = [("1", "7", "2024-01-01", "new", "Hue", "1", "0"), ("2", "7", "2024-01-01", "new", "Hue", "1", "0")]
    new = [("1", "7", "2024-01-01", "delivered", "Hue", "1", "0")]
    both = bronze(spark, ORDER, old).unionByName(bronze(spark, ORDER, new, "B", datetime(2024, 1, 2)))
    state = {r.order_id: r.status for r in clean_orders(both).collect()}
    assert state == {1: "delivered"}
    state = {r.order_id: r.status for r in clean_orders(both, mode="latest_per_key").collect()}
    assert state == {1: "delivered", 2: "new"}
    assert latest_batch(both, "A").count() == 2


def test_hot_key_dedup_against_brute_force(spark):
    """One key holds a third of the rows, and so do the rows without a key."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.pmod(F.col("id") * 7919, F.lit(60000)).alias("v"),
    )
    best = keep_best(df, ["k"], [F.col("v").desc()])
    expected = df.groupBy("k").agg(F.max("v").alias("v"))
    assert best.exceptAll(expected).isEmpty() and expected.exceptAll(best).isEmpty()


def test_bronze_keeps_every_row_and_flags_add_up(spark):
    shop = Shop(spark, "/root/testdata/sf0.001")
    for entity in ("users", "orders", "order_items"):
        source = shop.source(entity).count()
        assert shop.bronze(entity).filter("_batch_id = 'B'").count() == source


def test_numbers_keep_their_value_or_are_rejected(spark):
    rows = [
        ("1", "1", "5", "3000000000", "2.50"),
        ("2", "1", "5", "2.0", "3"),
        ("3", "1", "5", "1", "12345678901234567.00"),
        ("4", "1", "5", "100", "1000000000000000"),
        ("5", "1", "5", "100", "10000000000000000"),
        ("6", "1", "5", "2.5", "1"),
        ("7", "1", "5", "1", "0.004"),
        ("8", "1", "5", "9" * 18, "9" * 26),
        ("9", "1", "5", "x", "1"),
        ("10", "1", "5", "9" * 30, "1"),
        ("11", "1", "5", "1", "9" * 60),
        ("12", "1", "5", "0", "0.00"),
        ("13", "1", "5", None, None),
    ]
    items = bronze(spark, "item_id order_id product_id quantity unit_price", rows)
    got = {r.item_id: (r.quantity, r.unit_price, r.subtotal_calculated) for r in clean_order_items(items, None).collect()}
    assert got[1] == (3_000_000_000, Decimal("2.50"), Decimal("7500000000.00"))
    assert got[2] == (2, Decimal("3.00"), Decimal("6.00"))
    assert got[3][1] == Decimal("12345678901234567.00")
    assert (got[4][2], got[5][2]) == (Decimal("1e17"), Decimal("1e18"))
    assert got[12] == got[13] == (1, Decimal(0), Decimal(0))
    rejected = {int(r.item_id) for r in rejected_rows(items, "order_items").collect()}
    assert rejected == {6, 7, 8, 9, 10, 11} and rejected.isdisjoint(got)

    orders = [
        ("1", "7", "2024-01-01", "new", "Hue", "0.004", "1e30"),
        ("2", "7", "2024-01-01", "new", "Hue", "12345678901234567890.12", "-1e30"),
        ("3", "7", "2024-01-01", "new", "Hue", "5", "NaN"),
        ("4", "7", "2024-01-01", "new", "Hue", "5", "1e30"),
    ]
    table = bronze(spark, ORDER, orders)
    kept = {r.order_id: r for r in clean_orders(table).collect()}
    assert sorted(kept) == [2, 4] and {r.order_id for r in rejected_rows(table, "orders").collect()} == {"1", "3"}
    assert kept[2].total_amount == Decimal("12345678901234567890.12")
    assert [float(kept[i].discount_pct) for i in (2, 4)] == [0, 100]
    assert [kept[i]._flag_negative_amount for i in (2, 4)] == [0, 0]


def test_facts_of_large_amounts(spark):
    """The largest amounts that Silver keeps pass through the facts without an overflow."""
    price, count = "9" * 20, "9" * 6
    items = bronze(spark, "item_id order_id product_id quantity unit_price", [("1", "1", "5", count, price)])
    order = [("1", "7", "2024-01-01", "new", "Hue", "1", "33.33")]
    people = spark.createDataFrame([(7, 1, True)], "user_id bigint, user_sk bigint, is_current boolean")
    fact = fact_orders(clean_order_items(items, None), clean_orders(bronze(spark, ORDER, order)), people).first()
    gross = int(price) * int(count)
    assert fact.gross_amount == gross
    # In hundredths, as whole numbers: more digits than a decimal context keeps.
    assert int(fact.discount_amount.scaleb(2, EXACT)) == (gross * 3333 + 50) // 100
    assert int(fact.net_amount.scaleb(2, EXACT)) == (gross * 6667 + 50) // 100
    paid = bronze(
        spark,
        "txn_id order_id user_id txn_date amount payment_method status currency",
        [("1", "1", "7", "2024-01-01", "9" * 26, "x", "y", "usd")],
    )
    assert fact_transactions(clean_transactions(paid), people).first().amount_vnd == int("9" * 26) * 24500
