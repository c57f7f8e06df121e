"""The shop track end to end.

``Shop`` composes the layers lazily over the test tables, for the registered queries.
``run_full`` and ``run_incremental`` are the stored pipelines: each layer is written
and the next one reads it back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import typed_key
from tidemark.operators.dim_date import dim_date
from tidemark.operators.dims import dim_products, dim_users_init
from tidemark.operators.facts import fact_orders, fact_transactions
from tidemark.operators.scd2 import scd2_changes, scd2_upsert
from tidemark.operators.silver_shop import (
    clean_order_items,
    clean_orders,
    clean_products,
    clean_transactions,
    clean_users,
)
from tidemark.plans import once
from tidemark.schemas import RUN_EVENT, WATERMARK
from tidemark.sources.bindings import bind
from tidemark.sources.bronze import (
    drop_batch,
    incremental,
    incremental_overlap,
    ingest_all,
    land_batch,
    newest_batch,
    read_bronze,
    snapshot_batch,
    time_column,
    to_bronze,
)
from tidemark.sources.keyed import BUCKETS, DELETED, SEQUENCE, merge_keyed, read_keyed
from tidemark.sources.tables import delete_path, if_stored, overwrite, read_table, stamped
from tidemark.sources.watermarks import (
    advance_watermarks,
    loaded_marks,
    logged_step,
    read_watermarks,
)

KEYS = {
    "users": "user_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "item_id",
    "transactions": "txn_id",
}
OLD_BATCH, NEW_BATCH = ("A", datetime(2024, 1, 1)), ("B", datetime(2024, 1, 2))
AS_OF = date(2024, 1, 31)
RUN_AT = datetime(2024, 1, 31)


def recency(entity: str) -> list[Column]:
    """A reproducible stand-in for arrival order: the source columns, highest first."""
    columns = {
        "order_items": [
            ("product_id", "bigint"),
            ("quantity", "int"),
            ("unit_price", "decimal(12,2)"),
            ("tie_suppkey", "bigint"),
            ("tie_shipdate", "date"),
        ]
    }.get(entity, [(KEYS[entity], "bigint")])
    return [F.col(name).try_cast(kind).desc_nulls_last() for name, kind in columns]


@dataclass(frozen=True)
class Shop:
    """The layers over one folder of test tables; every method returns a lazy frame."""

    spark: SparkSession
    folder: str

    @once
    def source(self, entity: str) -> DataFrame:
        return bind(self.table, entity)

    @once
    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    @once
    def bronze(self, entity: str) -> DataFrame:
        """Two batches: the older one misses every fifth key."""
        rows = self.source(entity)
        older = rows.filter(F.col(KEYS[entity]) % 5 != 0)
        return to_bronze(older, f"public.{entity}", *OLD_BATCH).unionByName(
            to_bronze(rows, f"public.{entity}", *NEW_BATCH)
        )

    @once
    def users(self, bronze: DataFrame | None = None) -> DataFrame:
        rows = self.bronze("users") if bronze is None else bronze
        return clean_users(rows, NEW_BATCH[0], recency=recency("users"))

    @once
    def products(self) -> DataFrame:
        return clean_products(self.bronze("products"), NEW_BATCH[0], recency=recency("products"))

    @once
    def orders(self) -> DataFrame:
        return clean_orders(self.bronze("orders"), NEW_BATCH[0], recency=recency("orders"))

    @once
    def order_items(self, orders: DataFrame | None = None) -> DataFrame:
        return clean_order_items(
            self.bronze("order_items"), orders, NEW_BATCH[0], recency=recency("order_items")
        )

    @once
    def transactions(self) -> DataFrame:
        return clean_transactions(
            self.bronze("transactions"), NEW_BATCH[0], recency=recency("transactions")
        )

    @once
    def dim_date(self) -> DataFrame:
        return dim_date(self.spark)

    @once
    def dim_users(self) -> DataFrame:
        return dim_users_init(self.users(), AS_OF)

    @once
    def dim_products(self) -> DataFrame:
        return dim_products(self.products())

    @once
    def fact_orders(self) -> DataFrame:
        """The join to orders makes the items' own order check redundant."""
        return fact_orders(self.order_items(), self.orders(), self.dim_users())

    @once
    def fact_transactions(self) -> DataFrame:
        return fact_transactions(self.transactions(), self.dim_users())

    @once
    def user_changes(self) -> DataFrame:
        """SCD2 step: every 25th user is unknown so far, every 15th moved since the first load."""
        bronze = self.bronze("users")
        number = F.col("user_id").cast("bigint")
        first_load = self.users(bronze.filter(number % 25 != 0))
        moved = F.when(number % 15 == 0, F.lit("Relocated")).otherwise(F.col("city"))
        second_load = self.users(bronze.withColumn("city", moved))
        return scd2_changes(dim_users_init(first_load, AS_OF), second_load, AS_OF)

    @once
    def dim_users_history(self) -> DataFrame:
        return self.user_changes().drop("_action")

    @once
    def fact_orders_as_of(self, lookup: str = "as_of") -> DataFrame:
        return fact_orders(self.order_items(), self.orders(), self.dim_users_history(), lookup)


def run_full(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    lake: str,
    batch_id: str,
    ingested_at: datetime,
    as_of: date,
    clock: Callable[[], datetime] = datetime.now,
    calendar: tuple[date, date] | None = None,
) -> DataFrame:
    """Full load of all layers under ``lake``; safe to repeat. Returns the batch summary.

    It also sets the watermarks that the first incremental load starts from.
    """
    tables = {f"public.{name}": df for name, df in sources.items()}
    summary = ingest_all(spark, tables, f"{lake}/bronze", batch_id, ingested_at)
    for name, df in sources.items():
        landed = read_bronze(spark, f"{lake}/bronze/{name}").filter(F.col("_batch_id") == batch_id)
        marks = loaded_marks({f"public.{name}": landed}, {f"public.{name}": time_column(df)})
        _set_mark(spark, lake, marks, clock())
    refresh(spark, lake, ingested_at, as_of, clock=clock, calendar=calendar)
    return summary


def refresh(
    spark: SparkSession,
    lake: str,
    run_at: datetime,
    as_of: date,
    mode: str | None = None,
    clock: Callable[[], datetime] = datetime.now,
    calendar: tuple[date, date] | None = None,
) -> None:
    """Rebuild Silver and Gold from stored Bronze.

    Where the newest batch with rows is a full load it is the snapshot; after
    incremental loads each key's newest version is taken from all batches. ``mode``
    forces one of the two. ``calendar`` sets the first and last day of the date
    dimension. Each layer's start and end are written to the ETL log.
    """

    def bronze(entity: str) -> DataFrame:
        return read_bronze(spark, f"{lake}/bronze/{entity}")

    def cleaned(clean: Callable[..., DataFrame], entity: str, *more: DataFrame) -> DataFrame:
        path = f"{lake}/bronze/{entity}"
        batch = snapshot_batch(spark, path) if mode != "latest_per_key" else None
        if mode == "latest_batch" and batch is None:
            batch = newest_batch(spark, path)
        chosen = "latest_per_key" if batch is None else "latest_batch"
        return store("silver", entity, clean(bronze(entity), *more, batch, chosen))

    def store(layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        marked = stamped(df, f"_{layer}_processed_at", run_at)
        return overwrite(marked, f"{lake}/{layer}/{name}", partition_by).drop(
            f"_{layer}_processed_at"
        )

    control = f"{lake}/control"
    with logged_step(spark, control, "load_silver", "SILVER", clock) as step:
        users = cleaned(clean_users, "users")
        products = cleaned(clean_products, "products")
        orders = cleaned(clean_orders, "orders")
        items = cleaned(clean_order_items, "order_items", orders)
        payments = cleaned(clean_transactions, "transactions")
        step.rows = sum(x.count() for x in (users, products, orders, items, payments))

    with logged_step(spark, control, "load_gold", "GOLD", clock) as step:
        days = {"start": calendar[0], "end": calendar[1]} if calendar else {}
        store("gold", "dim_date", dim_date(spark, **days))
        store("gold", "dim_products", dim_products(products))
        people = refresh_dim_users(spark, f"{lake}/gold/dim_users", users, as_of)
        month = (F.col("order_date_key") / 100).cast("int")
        facts = store(
            "gold",
            "fact_orders",
            fact_orders(items, orders, people).withColumn("order_month", month),
            ["order_month"],
        )
        paid = store("gold", "fact_transactions", fact_transactions(payments, people))
        step.rows = facts.count() + paid.count()


def refresh_dim_users(spark: SparkSession, path: str, users: DataFrame, as_of: date) -> DataFrame:
    """Next snapshot of the user dimension, built on the newest snapshot of an earlier day.

    Snapshots are kept per day, so a rerun on the same day starts from the same
    state and the table being read is never the one being written.
    """
    last = None
    stored = if_stored(lambda: spark.read.parquet(path))
    if stored is not None:
        earlier = stored.withColumn("as_of", F.col("as_of").cast("date")).filter(
            F.col("as_of") < F.lit(as_of)
        )
        last = earlier.agg(F.max("as_of")).first()[0]
    if last is None:
        state = dim_users_init(users, as_of)
    else:
        state = scd2_upsert(earlier.filter(F.col("as_of") == F.lit(last)).drop("as_of"), users, as_of)
    snapshot = f"{path}/as_of={as_of.isoformat()}"
    return overwrite(state, snapshot)


# How Silver tables of one row per key come from Bronze. Users are not among them: their row
# is chosen per address, and addresses move between users.
BY_KEY: dict[str, Callable[..., DataFrame]] = {
    "products": clean_products,
    "orders": clean_orders,
    "order_items": lambda bronze, *more, **options: clean_order_items(bronze, None, *more, **options),
    "transactions": clean_transactions,
}

LEAVES_OUT = ("orders", "order_items")  # entities of which Silver leaves out rows that lack a key


def _with_sequence(rows: DataFrame, bronze: DataFrame) -> DataFrame:
    """Cleaned rows with the ingest time and id of the batch they come from."""
    batches = bronze.select(F.col("_batch_id").alias("_source_batch_id"), "_ingested_at").distinct()
    sequence = F.struct("_ingested_at", "_source_batch_id").alias(SEQUENCE)
    return rows.join(F.broadcast(batches), "_source_batch_id").select(*rows.columns, sequence)


def merge_silver(
    spark: SparkSession,
    lake: str,
    entity: str,
    batch_id: str,
    order: Sequence[Column] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Bring ``silver_by_key/<entity>`` up to one landed batch, touching the buckets of its keys only.

    After all batches in order the table equals a rebuild that takes each key's newest
    version (``latest_per_key``). A key whose newest row Silver leaves out, such as an order
    without a user, goes, as in the rebuild. Items are not checked against orders here;
    the fact's join does that. Calling it again for a batch changes nothing.
    """
    bronze = read_bronze(spark, f"{lake}/bronze/{entity}")
    key, path = KEYS[entity], f"{lake}/silver_by_key/{entity}"
    if entity in LEAVES_OUT:
        rows = BY_KEY[entity](bronze, batch_id, recency=order, left_out=DELETED)
        rows = rows.filter(f"{key} IS NOT NULL OR NOT {DELETED}")
    else:
        rows = BY_KEY[entity](bronze, batch_id, recency=order).withColumn(DELETED, F.lit(False))
    incoming = _with_sequence(rows, bronze.filter(F.col("_batch_id") == batch_id))
    _merge_stored(incoming, path, key, f"batch-{batch_id}", buckets)


def _merge_stored(
    incoming: DataFrame, path: str, key: str, token: str, buckets: int, replaced: Column | None = None
) -> None:
    """Merge rows that are dear to compute: they are written once, and deleted when they are merged."""
    parent, _, name = path.rpartition("/")
    scratch = f"{parent}/_incoming/{name}-{token}"
    incoming.write.mode("overwrite").parquet(scratch, compression="zstd")
    rows = incoming.sparkSession.read.schema(incoming.schema).parquet(scratch)
    merge_keyed(rows, path, [key], token, buckets, replaced)
    delete_path(incoming.sparkSession, scratch)


def undo_silver(
    spark: SparkSession,
    lake: str,
    entity: str,
    batch_id: str,
    order: Sequence[Column] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """After a batch was rolled back from Bronze: rebuild the keys whose Silver row came from it.

    Other keys, and buckets without such keys, are not touched. Afterwards the table is as
    if the batch had never been landed.
    """
    key, path = KEYS[entity], f"{lake}/silver_by_key/{entity}"
    stored = read_keyed(spark, path, deleted=True)
    if stored is None:
        return
    from_batch = F.col("_source_batch_id") == batch_id
    own = stored.filter(from_batch).select(key)
    bronze = read_bronze(spark, f"{lake}/bronze/{entity}").filter(F.col("_batch_id") != batch_id)
    raw = bronze.withColumn("_typed", F.expr(typed_key(key)))
    affected = raw.join(own.withColumnRenamed(key, "_typed"), "_typed", "left_semi").drop("_typed")
    rows = BY_KEY[entity](affected, mode="latest_per_key", recency=order).withColumn(DELETED, F.lit(False))
    rebuilt = _with_sequence(rows, bronze)
    first = F.struct(
        F.lit(datetime(1, 1, 1)).cast("timestamp_ntz").alias("_ingested_at"), F.lit("").alias("_source_batch_id")
    )
    # Below any rebuilt row of its key, so this stays for keys without one.
    unknown = own.withColumns({DELETED: F.lit(True), SEQUENCE: first})
    incoming = rebuilt.unionByName(unknown, allowMissingColumns=True)
    _merge_stored(incoming, path, key, f"undo-{batch_id}", buckets, replaced=from_batch)


def run_incremental(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    lake: str,
    batch_id: str,
    run_at: datetime,
    clock: Callable[[], datetime] = datetime.now,
    overlap: timedelta | None = None,
) -> DataFrame:
    """Load what is newer than each table's watermark; returns this run's log events.

    With ``overlap`` rows up to so long below the mark are read again, and those
    that landed before are left out (``incremental_overlap``).

    A batch may run again, after a crash or to catch up: each table then starts from the
    mark it had before the batch, so the batch comes out whole. Only a table's newest
    batch may. A table that fails is logged and does not stop the others; what its
    batch held from an earlier, confirmed run stays.
    """
    state = _control_table(spark, f"{lake}/control/watermarks", WATERMARK)
    events = []
    first_id = int(run_at.replace(tzinfo=timezone.utc).timestamp() * 1000) * 1000

    def log(*event: object) -> None:
        events.append((*event, clock()))
        frame = spark.createDataFrame(events[-1:], RUN_EVENT).coalesce(1)
        frame.write.mode("append").parquet(f"{lake}/control/run_events")

    for number, (name, df) in enumerate(sources.items()):
        table, path = f"public.{name}", f"{lake}/bronze/{name}"
        entry = (first_id + number, batch_id, table)
        own = state.filter(F.col("table_name") == table)
        confirmed = not own.filter(F.col("last_batch_id") == batch_id).isEmpty()
        log(*entry, "RUNNING", None, None)
        try:
            current = read_watermarks(own).first()
            if confirmed and current["last_batch_id"] != batch_id:
                raise ValueError(f"{batch_id} is not the newest batch of {table}")
            before = read_watermarks(own.filter(F.col("last_batch_id") != batch_id)).first()
            mark = before["last_loaded_at"] if before is not None else None
            if overlap is None:
                new = incremental(df, mark)
            else:
                stored = if_stored(lambda path=path: read_bronze(spark, path))
                others = stored.filter(F.col("_batch_id") != batch_id) if stored is not None else None
                new = incremental_overlap(df, mark, others, overlap)
            landed = land_batch(new, table, path, batch_id, run_at)
            marks = spark.createDataFrame(
                [(table, landed.newest, batch_id, landed.rows)],
                "table_name string, last_loaded_at timestamp_ntz, last_batch_id string, last_row_count bigint",
            )
            _set_mark(spark, lake, marks, clock(), own)
            log(*entry, "SUCCESS", landed.rows, None)
        except Exception as error:  # noqa: BLE001 - any failure must be logged and rolled back
            status = "FAILED"
            if not confirmed:
                try:
                    drop_batch(spark, path, batch_id)
                    status = "ROLLED_BACK"
                except Exception:  # noqa: BLE001
                    status = "FAILED"
            log(*entry, status, 0, str(error))
    return spark.createDataFrame(events, RUN_EVENT)


def _set_mark(
    spark: SparkSession, lake: str, marks: DataFrame, at: datetime, state: DataFrame | None = None
) -> None:
    """Append a table's next watermark row; a load without rows leaves the old mark."""
    before = spark.createDataFrame([], WATERMARK) if state is None else read_watermarks(state)
    advanced = advance_watermarks(before, marks, at)
    advanced.coalesce(1).write.mode("append").parquet(f"{lake}/control/watermarks")


def _control_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = if_stored(lambda: spark.read.schema(schema).parquet(path))
    return spark.createDataFrame([], schema) if found is None else found
