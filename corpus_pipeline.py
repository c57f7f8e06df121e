"""The training-data pipeline: stages over ``documents``, each stored before the next one reads it.

Every stage works on all rows that its predecessor kept, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, packing, quality_rules, similar
from tidemark.llm.catalog import TARGETS, tokenizer_path
from tidemark.llm.common import documents, stored
from tidemark.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, one stays.

    SimHash with pigeonring links first, verified; what its bits cannot tell is found without loss.
    """
    return similar.drop_similar(docs, fingerprints=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains are thinned to their target weights, as little as that takes; nothing is repeated."""
    labels = mixing.domains_of(read_table(spark, sf_dir, "labels"))
    return mixing.mix_documents(docs, labels, TARGETS, budget=None, most=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in sequences of 256 to 2,048 ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near-dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

# Iterated estimates, similarity of texts and a tokenizer are beyond SQL; tests check by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order over ``documents``; the last stage's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
