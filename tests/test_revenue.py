"""The revenue mart by batches against the mart of all rows at once."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators.dim_date import dim_date
from tidemark.operators.marts import revenue_by_month_category
from tidemark.plans.revenue import add_batch, revenue

FACT = (
    "order_item_sk bigint, order_id bigint, order_date_key int, product_sk bigint, order_status string, quantity bigint, "
    "gross_amount decimal(30,2), discount_amount decimal(30,2), net_amount decimal(30,2), category string"
)


def item(sk, order, day, product, status, quantity):
    amounts = (Decimal(10 * quantity), Decimal(quantity), Decimal(9 * quantity))
    return (sk, order, day, product, status, quantity, *amounts, f"c{product % 3}" if product else None)


def test_batches_add_up_to_the_whole_mart(spark, tmp_path):
    """Orders that span batches, change state, move to another day, and come again or late."""
    path, calendar = str(tmp_path), dim_date(spark, start=date(2024, 1, 1), end=date(2024, 3, 31))
    products = spark.range(6).select(F.col("id").alias("product_sk"), F.concat(F.lit("c"), F.col("id") % 3).alias("category"))
    batches = [
        [item(i, i // 3, 20240101 + i % 28, 1 + i % 5, "delivered", i) for i in range(60)],
        [item(1, 0, 20240102, 2, "cancelled", 1), item(100, 0, 20240101, 4, "delivered", 5), item(9, 3, 20240210, 5, "shipped", 9)],
        [item(1, 0, 20240102, 2, "returned", 1), item(200, 70, 20240301, 1, "new", 4), item(201, 71, 20240301, 1, "cancelled", 4)],
        [item(100, 0, 20240101, 4, "cancelled", 5), item(200, 70, 20240302, 1, "new", 6), item(300, 80, 20240101, None, "new", 2)],
    ]
    state: dict[int, tuple] = {}
    for number, rows in enumerate(batches, 1):
        state |= {row[0]: row for row in rows}
        frame = spark.createDataFrame(rows, FACT)
        for _ in range(2):  # each batch runs twice
            add_batch(spark, path, frame, f"B{number}", number, buckets=4)
        facts = spark.createDataFrame(list(state.values()), FACT)
        whole = revenue_by_month_category(facts.drop("category"), calendar, products).collect()
        assert revenue(spark, path, calendar).collect() == whole and whole
    # A batch older than what is stored changes nothing that is newer.
    add_batch(spark, path, spark.createDataFrame([item(200, 70, 20240105, 1, "new", 99)], FACT), "late", 0, buckets=4)
    assert revenue(spark, path, calendar).collect() == whole


def test_a_batch_that_stopped_between_its_steps_is_finished(spark, tmp_path, monkeypatch):
    import tidemark.plans.revenue as plan

    path, calendar = str(tmp_path), dim_date(spark, start=date(2024, 1, 1), end=date(2024, 1, 31))
    first = spark.createDataFrame([item(1, 1, 20240101, 1, "new", 1)], FACT)
    add_batch(spark, path, first, "A", 1, buckets=2)
    more = spark.createDataFrame([item(1, 1, 20240101, 1, "new", 3), item(2, 1, 20240101, 1, "new", 2)], FACT)
    with monkeypatch.context() as patch:
        patch.setattr(plan, "merge_keyed", lambda *a, **k: 1 / 0)
        try:
            add_batch(spark, path, more, "B", 2, buckets=2)
        except ZeroDivisionError:
            pass
    add_batch(spark, path, more, "B", 2, buckets=2)
    (row,) = revenue(spark, path, calendar).collect()
    assert (row.total_orders, row.total_qty, row.gross_revenue) == (1, 5, 50)


def test_the_mart_of_nothing(spark, tmp_path):
    calendar = dim_date(spark, start=date(2024, 1, 1), end=date(2024, 1, 31))
    assert revenue(spark, str(tmp_path / "none"), calendar).count() == 0


def test_changes_of_a_batch_take_one_shuffle(spark):
    from conftest import plan_text

    from tidemark.plans.revenue import ITEM, _changed_orders
    from tidemark.sources.keyed import BUCKET, DELETED, SEQUENCE

    def rows(values, sequence):
        own = spark.createDataFrame(values, FACT).select(*ITEM)
        return own.withColumns({SEQUENCE: F.lit(sequence).cast("bigint"), DELETED: F.lit(False)})

    old = rows([item(i, i // 3, 20240101, 1, "new", 1) for i in range(30)], 1).withColumn(BUCKET, F.lit(0))
    changed = _changed_orders(rows([item(3, 1, 20240101, 1, "cancelled", 1), item(90, 30, 20240101, 1, "new", 2)], 2), old)
    assert sorted((r.order_id, r.qty, r.orders) for r in changed.collect()) == [(1, -1, 0), (30, 2, 1)]
    assert plan_text(changed).count("Exchange ") == 1
