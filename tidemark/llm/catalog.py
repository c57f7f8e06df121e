"""The registered queries of the corpus operators and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    dualtree,
    exact_dedup,
    lattice,
    mixing,
    negatives,
    packing,
    pseudonyms,
    quality_rules,
    sharding,
    simhash,
    subspaces,
    substrings,
)
from tidemark.llm.common import documents
from tidemark.sources.tables import read_table

SHARDS = [f"shard-{i:02d}" for i in range(64)]
# A deployment passes its own secret; this one only makes the query reproducible.
PII_KEY = b"example key of the registered query"
TARGETS = {"good": 0.9, "poor": 0.06, "toxic": 0.04}


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    placed = sharding.assign_shards(documents(spark, sf_dir), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2,048 ids."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted windows."""
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(2).selectExpr(
        "-1L AS conv_id",
        "id AS turn",
        "if(id = 0, 'user', 'assistant') AS role",
        f"'{control}' AS text",
    )
    turns = read_table(spark, sf_dir, "conversations").unionByName(extra)
    whole = chat.read_back(chat.format_conversations(turns))
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document after repeated passages are removed."""
    cut = substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    kept = F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", kept)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document."""
    return lattice.score_texts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and winner of every document."""
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document."""
    labels = mixing.domains_of(read_table(spark, sf_dir, "labels"))
    return mixing.mixing_rates(documents(spark, sf_dir), labels, TARGETS)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms for private values, and their kinds."""
    masked = pseudonyms.mask_private(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)
    kinds = F.transform("pii_spans", lambda x: x["kind"])
    return masked.select("doc_id", "text", F.size(kinds).alias("n_replaced"), kinds.alias("kinds"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.quality(documents(spark, sf_dir), columns=["doc_id"])


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "fingerprint", "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector."""
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    return dualtree.rank_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return subspaces.linked_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding,
        op2_packing,
        op3_chat_formatting,
        op4_substring_dedup,
        op5_lm_scoring,
        op6_exact_dedup,
        op7_mixing,
        op8_pii,
        op9_quality_rules,
        op10_simhash,
        op11_hard_negatives,
        op12_lexical_search,
        op13_embedding_dedup,
    )
}

ORACLE_SQL = {
    "op1_sharding": sharding.checking_sql(SHARDS),
    "op6_exact_dedup": exact_dedup.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op12_lexical_search": dualtree.SQL,
    "op13_embedding_dedup": subspaces.SQL,
}
