"""Change events applied to a stored table: the last event of each key decides.

The stream's micro-batches are merged into a keyed table (``sources.keyed``). An update that
changes the key is a deletion of the old key and an insertion of the new one. Events
carry their place in the log, so redelivered and late ones change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import keep_best
from tidemark.sources.keyed import BUCKETS, DELETED, SEQUENCE, merge_keyed


def row_changes(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """What exploded events (``changes.explode_rows``) do to rows: the row's columns, its
    sequence (event, place in it, step) and whether it is gone.

    A deletion is the key with nothing else. Rows without a key are left out: no row of a
    table can be meant.
    """
    row = F.col("row")
    update = F.col("event_type") == "UPDATE"
    before, after = row["before_values"], F.when(update, row["after_values"]).otherwise(row["values"])
    removed = F.when(update, before).otherwise(row["values"])
    moved = update & F.expr(
        "NOT (" + " AND ".join(f"row.before_values.{k} <=> row.after_values.{k}" for k in key) + ")"
    )
    steps = F.array(
        F.struct(F.lit(0).alias("step"), removed.alias("values"), F.lit(True).alias(DELETED)),
        F.struct(F.lit(1).alias("step"), after.alias("values"), F.lit(False).alias(DELETED)),
    )
    # A deletion takes the first step only, an insertion the second, an update that moves a key both.
    deletion = (F.col("event_type") == "DELETE") | moved
    wanted = F.filter(steps, lambda s: F.when(s[DELETED], deletion).otherwise(F.col("event_type") != "DELETE"))
    stepped = events.select("event_id", "row_no", F.explode(wanted).alias("change"))
    names = [field.name for field in stepped.schema["change"].dataType["values"].dataType]
    # A tombstone keeps the key only.
    kept = [
        F.when(F.lit(name in key) | ~F.col(f"change.{DELETED}"), F.col(f"change.values.{name}")).alias(name)
        for name in names
    ]
    sequence = F.struct("event_id", "row_no", "change.step").alias(SEQUENCE)
    known = F.expr(" AND ".join(f"{k} IS NOT NULL" for k in key))
    return stepped.select(*kept, sequence, f"change.{DELETED}").filter(known)


def apply_changes(
    changes: DataFrame, path: str, checkpoint: str, key: Sequence[str], buckets: int = BUCKETS
) -> StreamingQuery:
    """Merge everything available into the table at ``path`` and stop; a restart continues.

    ``changes`` is a stream of exploded events of one table. Each micro-batch is a merge
    named by its epoch: one that is delivered again finishes or repeats it without effect.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        newest = keep_best(row_changes(batch, key), key, [F.col(SEQUENCE).desc()])
        merge_keyed(newest, path, key, f"epoch-{epoch}", buckets)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
