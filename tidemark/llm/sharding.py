"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over a prime number of slots. The shards
take turns: each claims the first slot in its order that is still free, until the
table is full. A key hashes to a slot, and one probe of the broadcast table names
its shard. Shards own equal numbers of slots (at most one apart), and when a shard
goes, nearly all other slots keep their owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import replacing

SLOTS = 8191  # a prime, over a hundred times the number of shards
MOST_SLOTS = 1_000_003  # the broadcast stays below this many small rows
HEX_DIGITS = 15  # of an MD5 digest: fits a signed 64-bit number


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HEX_DIGITS], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Owner of each slot, as the shard's place in ``shards``.

    A parameter table: its size depends on ``slots`` alone, never on data. Shards
    take turns in the order of their names, so the order given does not matter.
    """
    if not is_prime(slots) or not len(set(shards)) == len(shards) <= slots <= MOST_SLOTS:
        raise ValueError("slots must be a prime, at least the number of distinct shards")
    if not shards:
        raise ValueError("at least one shard is needed")
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [_number(f"offset:{name}") % slots for name in shards]
    step = [_number(f"step:{name}") % (slots - 1) + 1 for name in shards]
    owner, claimed = [-1] * slots, 0
    while claimed < slots:
        for shard in turns[: slots - claimed]:
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            claimed += 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: its MD5 digest's leading digits modulo the table size; null as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") % slots


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as (slot, shard) rows, one per slot."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    names = F.array(*[F.lit(name) for name in shards])
    return (
        spark.range(1)
        .select(F.posexplode(owners).alias("slot", "owner"))
        .select(
            F.col("slot").cast("bigint").alias("slot"),
            F.get(names, F.col("owner").cast("int")).alias("shard"),
        )
    )


def assign_shards(
    df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS
) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; input columns of these names give way.

    No shuffle: the table (at most ``MOST_SLOTS`` rows) is broadcast. Null keys count
    as empty text; equal keys share a shard, repeated rows stay repeated; an empty
    frame stays empty. To spread one hot key, pass a key that varies within it.
    """
    keyed = replacing(df, slot=slot_of(F.col(f"`{key}`"), slots))
    if "shard" in (name.lower() for name in keyed.columns):
        keyed = keyed.drop("shard")
    table = table_frame(df.sparkSession, shards, slots)
    return keyed.join(F.broadcast(table), "slot").select(
        *[f"`{name}`" for name in keyed.columns], "shard"
    )


def checking_sql(shards: Sequence[str], slots: int = SLOTS) -> str:
    """The placement of ``documents`` as DuckDB SQL; the table goes in as a list.

    Filling the table takes one step per slot, which tests compare with its definition.
    """
    owners = ", ".join(f"'{shards[i]}'" for i in lookup_table(shards, slots))
    return f"""
    WITH slots AS (
      SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HEX_DIGITS})
        AS BIGINT) % {slots} AS slot FROM documents)
    SELECT doc_id, slot, (SELECT [{owners}])[slot + 1] AS shard FROM slots"""
