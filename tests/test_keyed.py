"""Keyed tables: merges by sequence, deltas of Silver, applied change events, late rows."""

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import plan_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.silver_shop import clean_order_items, clean_orders
from tidemark.plans.shop import merge_silver, run_incremental, undo_silver
from tidemark.sources import keyed
from tidemark.sources.bronze import drop_batch, incremental_overlap, land_batch, read_bronze, to_bronze
from tidemark.sources.keyed import merge_keyed, read_keyed, rows_of_buckets
from tidemark.sources.tables import overwrite, recover, rename_path
from tidemark.streaming.apply import apply_changes
from tidemark.streaming.changes import change_schema, explode_rows, read_changes

ROWS = "k bigint, v string, _sequence bigint, _deleted boolean"


def state(spark, path):
    found = read_keyed(spark, path)
    return {} if found is None else {r.k: r.v for r in found.collect()}


def test_the_highest_sequence_stays(spark, tmp_path):
    path, rng, wanted = str(tmp_path / "t"), random.Random(1), {}
    events = [(rng.randrange(40), f"v{i}", i, rng.random() < 0.2) for i in range(200)]
    for k, v, _, gone in events:
        wanted[k] = None if gone else v
    rng.shuffle(events)
    for number in range(4):
        part = spark.createDataFrame(events[number * 50 : number * 50 + 50], ROWS)
        for _ in range(2):  # a repeated merge is no change
            merge_keyed(part, path, ["k"], f"m{number}", buckets=8)
    assert state(spark, path) == {k: v for k, v in wanted.items() if v is not None}
    with pytest.raises(ValueError, match="without k"):
        merge_keyed(spark.createDataFrame([(None, "x", 1, False)], ROWS), path, ["k"], "n", buckets=8)
    before = state(spark, path)
    merge_keyed(spark.createDataFrame([], ROWS), path, ["k"], "empty", buckets=8)
    assert state(spark, path) == before


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("_bucket=*/*.parquet")}


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_keyed(spark.range(1000).selectExpr("id AS k", "'a' AS v", "1L AS _sequence"), path, ["k"], "a", buckets=16)
    before = files(path)
    one = spark.createDataFrame([(5, "b", 2, False)], ROWS)
    bucket = keyed.bucketed(one, ["k"], 16).first()["_bucket"]
    merge_keyed(one, path, ["k"], "b", buckets=16)
    changed = {name.split("/")[0] for name in set(before) ^ set(files(path))}
    assert changed == {f"_bucket={bucket}"}
    plan = plan_text(rows_of_buckets(spark.read.parquet(path), [bucket]))
    assert f"PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    assert state(spark, path)[5] == "b" and len(state(spark, path)) == 1000


def test_an_interrupted_merge_is_finished_from_what_it_staged(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge_keyed(spark.range(100).selectExpr("id AS k", "'a' AS v", "1L AS _sequence"), path, ["k"], "a", buckets=4)
    more = spark.range(50).selectExpr("id AS k", "'b' AS v", "2L AS _sequence")

    def crash(*_):
        # After staging, half of the buckets are gone.
        for folder in sorted(Path(path).glob("_bucket=*"))[:2]:
            for file in folder.iterdir():
                file.unlink()
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(keyed, "path_exists", lambda s, p: crash() if p.endswith("=*") else False)
        with pytest.raises(KeyboardInterrupt):
            merge_keyed(more, path, ["k"], "b", buckets=4)
    merge_keyed(more, path, ["k"], "b", buckets=4)
    assert state(spark, path) == {k: "b" if k < 50 else "a" for k in range(100)}


ORDER = "order_id bigint, user_id bigint, order_date string, status string, shipping_city string, total_amount string, discount string"


def orders(spark, rows):
    return spark.createDataFrame([(k, u, "2024-01-01", s, None, "5", None) for k, u, s in rows], ORDER)


def test_silver_by_delta_equals_a_rebuild(spark, tmp_path):
    """A key whose newest row has no user goes, comes back with a later batch, and a batch is undone."""
    lake = str(tmp_path)
    path = f"{lake}/bronze/orders"
    batches = {
        "A": [(1, 7, "new"), (2, 7, "new"), (3, 7, "new"), (4, None, "new")],
        "B": [(1, 7, "shiped"), (2, None, "lost"), (5, 8, "new"), (4, 9, "found")],
        "C": [(2, 7, "back"), (6, 8, "new"), (1, 7, "deliverd")],
    }

    def rebuilt():
        return sorted(map(tuple, clean_orders(read_bronze(spark, path), mode="latest_per_key").collect()), key=str)

    def stored():
        return sorted(map(tuple, read_keyed(spark, f"{lake}/silver_by_key/orders").collect()), key=str)

    for number, (batch, rows) in enumerate(batches.items(), 1):
        land_batch(orders(spark, rows), "public.orders", path, batch, datetime(2024, 1, number))
        for _ in range(2):
            merge_silver(spark, lake, "orders", batch, buckets=4)
        assert stored() == rebuilt() and stored()
    for batch in ("C", "A"):
        drop_batch(spark, path, batch)
        undo_silver(spark, lake, "orders", batch, buckets=4)
        assert stored() == rebuilt()
    assert {r[0] for r in stored()} == {1, 4, 5}


def test_items_by_delta_keep_orphans(spark, tmp_path):
    lake = str(tmp_path)
    items = spark.createDataFrame([(1, 10, 5, 2, "3"), (2, 99, 5, 2, "x")], "item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price string")
    land_batch(items, "public.order_items", f"{lake}/bronze/order_items", "A", datetime(2024, 1, 1))
    merge_silver(spark, lake, "order_items", "A", buckets=2)
    found = read_keyed(spark, f"{lake}/silver_by_key/order_items").collect()
    whole = clean_order_items(read_bronze(spark, f"{lake}/bronze/order_items"), None).collect()
    assert found == whole and len(found) == 1


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def event(number, kind, *rows):
    if kind == "UPDATE":
        images = [{"before_values": dict(zip(("id", "name"), a)), "after_values": dict(zip(("id", "name"), b))} for a, b in rows]
    else:
        images = [{"values": dict(zip(("id", "name"), row))} for row in rows]
    return json.dumps({"event_id": number, "event_type": kind, "schema": "bronze", "table": "cdc_test", "rows": images})


def test_changes_reach_the_table(spark, tmp_path):
    source, path, checkpoint = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "checkpoint")
    source.mkdir()

    def run(checkpoint=checkpoint):
        changes = explode_rows(read_changes(spark, str(source), change_schema(ROW)))
        apply_changes(changes, path, checkpoint, ["id"], buckets=4).awaitTermination()
        found = read_keyed(spark, path)
        return {r.id: r.name for r in found.collect()}

    (source / "1.json").write_text("\n".join([
        event(1, "INSERT", (1, "a"), (2, "b"), (3, "c")),
        event(2, "UPDATE", ((1, "a"), (1, "aa"))),
        event(4, "DELETE", (2, "b")),
        event(5, "UPDATE", ((3, "c"), (30, "c"))),  # the key moves
        event(6, "INSERT", (None, "no key")),
    ]))
    assert run() == {1: "aa", 30: "c"}
    # Late events change nothing, newer ones do; a tombstone can be overwritten.
    (source / "2.json").write_text("\n".join([event(3, "UPDATE", ((2, "b"), (2, "late"))), event(0, "INSERT", (1, "zero"))]))
    assert run() == {1: "aa", 30: "c"}
    (source / "3.json").write_text("\n".join([event(7, "INSERT", (2, "again")), event(8, "UPDATE", ((2, "again"), (2, "last")))]))
    assert run() == {1: "aa", 2: "last", 30: "c"}
    # Everything delivered once more, as after a lost checkpoint.
    assert run(str(tmp_path / "other")) == {1: "aa", 2: "last", 30: "c"}


SOURCE = "id bigint, name string, updated_at timestamp_ntz"
T0 = datetime(2024, 1, 10)


def test_late_rows_are_loaded_once(spark, tmp_path):
    lake = str(tmp_path)
    rows = [(i, f"n{i}", T0 - timedelta(hours=i)) for i in range(100)]
    late = (200, "late", T0 - timedelta(hours=5))
    too_late = (201, "gone", T0 - timedelta(hours=90))
    changed = (3, "changed", T0 - timedelta(hours=3))
    null_name = (202, None, T0 - timedelta(hours=1))

    def load(batch, rows, day):
        source = {"t": spark.createDataFrame(rows, SOURCE)}
        log = run_incremental(spark, source, lake, batch, datetime(2024, 2, day), overlap=timedelta(hours=48))
        assert "SUCCESS" in {r.status for r in log.collect()}
        stored = read_bronze(spark, f"{lake}/bronze/t").filter(F.col("_batch_id") == batch)
        return sorted(int(r.id) for r in stored.collect())

    assert load("A", rows, 1) == list(range(100))
    second = [r for r in rows if r[0] != 3] + [late, too_late, changed, null_name]
    assert load("B", second, 2) == [3, 200, 202]
    assert load("B", second, 2) == [3, 200, 202]  # the batch runs again and comes out whole
    newer = (203, "new", T0 + timedelta(hours=1))
    assert load("C", [*second, newer], 3) == [203]


def test_overlap_without_a_mark_or_time(spark):
    df = spark.createDataFrame([(1, "a", T0)], SOURCE)
    hour = timedelta(hours=1)
    assert incremental_overlap(df, None, None, hour).count() == 1
    assert incremental_overlap(df.drop("updated_at"), T0, None, hour).count() == 1
    assert incremental_overlap(df, T0, None, hour).count() == 1
    landed = to_bronze(df, "t", "A", T0)
    assert incremental_overlap(df, T0, landed, hour).count() == 0
    assert incremental_overlap(df, T0 + 2 * hour, landed, hour).count() == 0


def test_a_table_whose_second_rename_failed_is_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite(spark.range(5), path)
    calls = []

    def failing(s, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("store went away")
        return rename_path(s, a, b)

    with monkeypatch.context() as patch:
        patch.setattr("tidemark.sources.tables.rename_path", failing)
        with pytest.raises(OSError, match="went away"):
            overwrite(spark.range(7), path)
    assert not (tmp_path / "t").exists()
    assert recover(spark, path) and not recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    assert overwrite(spark.range(9), path).count() == 9


def test_buckets_take_their_place_by_renaming(spark, tmp_path, monkeypatch):
    """A merge that stops between two buckets is finished from the folders that are left."""
    path, calls = str(tmp_path / "t"), []
    merge_keyed(spark.range(100).selectExpr("id AS k", "'a' AS v", "1L AS _sequence"), path, ["k"], "a", buckets=4)
    more = spark.range(50).selectExpr("id AS k", "'b' AS v", "2L AS _sequence")

    def failing(s, a, b):
        calls.append(a)
        if len(calls) == 3:
            raise OSError("store went away")
        return rename_path(s, a, b)

    with monkeypatch.context() as patch:
        patch.setattr(keyed, "rename_path", failing)
        with pytest.raises(OSError, match="went away"):
            merge_keyed(more, path, ["k"], "b", buckets=4)
    merge_keyed(more, path, ["k"], "b", buckets=4)
    assert state(spark, path) == {k: "b" if k < 50 else "a" for k in range(100)}
    assert not (tmp_path / "t" / "_merges" / "b").exists()


def test_silver_merges_rows_that_are_computed_once(spark, tmp_path, monkeypatch):
    """What is merged, and what an undo merges, is a plain scan; nothing of Silver is computed anew for it."""
    from tidemark.plans import shop

    lake, plans = str(tmp_path), []
    real = shop.merge_keyed

    def merging(rows, *more):
        plans.append(plan_text(rows))
        return real(rows, *more)

    monkeypatch.setattr(shop, "merge_keyed", merging)
    path = f"{lake}/bronze/orders"
    for number, batch in enumerate(("A", "B"), 1):
        rows = [(1, 7, batch), (2, None if batch == "B" else 7, batch), (number + 2, 7, batch)]
        land_batch(orders(spark, rows), "public.orders", path, batch, datetime(2024, 1, number))
        merge_silver(spark, lake, "orders", batch, buckets=4)
    drop_batch(spark, path, "B")
    undo_silver(spark, lake, "orders", "B", buckets=4)
    assert len(plans) == 3 and not any("Exchange" in plan or "Window" in plan for plan in plans)
    assert {r.order_id for r in read_keyed(spark, f"{lake}/silver_by_key/orders").collect()} == {1, 2, 3}
    assert not list(tmp_path.glob("silver_by_key/_incoming/*"))
