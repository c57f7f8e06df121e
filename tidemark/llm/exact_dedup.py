"""Exact deduplication with a heavy-hitter split.

Texts are compared by the SHA-256 digest of their normalised form. A Misra-Gries
summary finds the digests that may hold more than a given share of all rows; there
are at most 1 / share of them. Their groups are then counted exactly, and the
verified winners are broadcast: rows of such a group are settled where they are read
and never shuffled. All other digests go through an ordinary shuffle, in which no
group can be large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, one_per, replacing, stored, text_of

LEAST_SHARE = 1e-5  # at most 100,000 winners are broadcast
SHARE = 1e-3  # a group above this share of all rows is heavy: at most 1,000 groups


def text_digest(text: str) -> Column:
    """Digest of the text after each run of white space has become one space; null is empty."""
    return F.sha2(F.regexp_replace(text_of(F.col(f"`{text}`")), f"{SPACE}+", " "), 256)


def heavy_winners(rows: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per heavy digest: its smallest (id, row) and its exact size.

    ``freqItems`` is the Misra-Gries summary: every digest above ``share`` is among
    its items. Chance items are harmless, as counts and winners are exact. At most
    ``1 / share`` rows for each map task's counter, and as many after merging: ``share`` may not be
    so small that they are no longer fit to be broadcast.
    """
    if not LEAST_SHARE <= share < 1:
        raise ValueError(f"share must be at least {LEAST_SHARE} and below 1")
    candidates = rows.stat.freqItems(["text_sha256"], share).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    return (
        rows.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.min("_who").alias("_winner"), F.count("*").alias("group_size"))
    )


def _who(doc_id: str) -> Column:
    """Order of the rows of a group: smallest id first, null ids last, then by row."""
    known = F.col(f"`{doc_id}`")
    return F.struct(known.isNull().alias("unknown"), known.alias("id"), F.col("_row"))


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are one group. Exactly one row of a group is kept, also when
    ids repeat or are null (a null id only stays if the group has no other). An empty
    table gives no rows; other columns are ignored.
    """
    rows = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            text_digest(text).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "exact-digests",
    ).withColumn("_who", _who("doc_id"))
    winners = stored(heavy_winners(rows, share), "exact-winners")
    heavy = rows.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    light = (
        rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
        .withColumn("_winner", F.min("_who").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("_winner.id").alias("keep_id"),
        "group_size",
        (F.col("_who") == F.col("_winner")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE
) -> DataFrame:
    """The kept rows with all their columns; the rules of ``exact_duplicates`` hold.

    Rows of heavy groups other than the winner's are removed map-side. The rest,
    winners included, is shuffled by digest with one row per digest and map task.
    """
    columns = docs.columns
    narrow = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            text_digest(text).alias("text_sha256"),
            F.lit(0).alias("_row"),
        ),
        "exact-digests",
    ).withColumn("_who", _who("doc_id"))
    winners = stored(heavy_winners(narrow, share), "exact-winners").select(
        F.col("text_sha256").alias("_digest"), F.col("_winner.id").alias("_winner_id")
    )
    known = F.col(f"`{doc_id}`")
    marked = replacing(docs, _digest=text_digest(text)).join(
        F.broadcast(winners.withColumn("_heavy", F.lit(True))), "_digest", "left"
    )
    left = marked.filter(F.col("_heavy").isNull() | known.eqNullSafe(F.col("_winner_id")))
    # Of rows equal in id, and in text but for white space, always the same one stays.
    order = [known.asc_nulls_last(), F.xxhash64(f"`{text}`"), F.xxhash64(*[f"`{name}`" for name in columns])]
    best = one_per(left, [F.col("_digest")], order)
    return best.select(*[f"`{name}`" for name in columns])


SQL = r"""
WITH digests AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
sizes AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
  FROM digests GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM digests JOIN sizes USING (text_sha256)
"""
