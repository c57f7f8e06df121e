"""The registered queries over a whole test table, and the pipeline stage by stage."""

from collections import Counter

import check
import corpus
import corpus_pipeline
import pytest
from test_llm_dedup import check_exact, check_near, digest
from test_llm_models import check_packing, check_scores
from test_llm_similar import check_similar
from test_llm_texts import COUNTS, base_counts, cut

from tidemark.llm import catalog, packing
from tidemark.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    found = read_table(spark, SF, "documents").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in found]


def run(spark, name):
    return catalog.QUERIES[name](spark, SF)


def test_packing_query(spark, rows):
    check_packing(rows, run(spark, "op2_packing").collect(), packing.TIERS)


def test_substring_query(spark, rows):
    from tidemark.llm.substrings import remove_repeats

    docs = read_table(spark, SF, "documents")
    found = remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_text")
    assert Counter(corpus.collected(found)) == Counter(cut(rows, 50))
    assert run(spark, "op4_substring_dedup").columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_scoring_query(spark, rows):
    result = corpus.collected(run(spark, "op5_lm_scoring"))
    check_scores(rows, result)


def test_exact_query_against_its_sql_and_by_hand(spark, rows):
    check_exact(rows, corpus.collected(run(spark, "op6_exact_dedup")))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_queries_against_their_sql(spark, name):
    assert check.compare(spark, check.database(SF), SF, name) is None


def test_quality_query(spark, rows):
    found = run(spark, "op9_quality_rules").select("doc_id", *COUNTS).collect()
    assert Counter(tuple(r) for r in found) == Counter((i, *base_counts(t)) for i, t in rows)


def test_simhash_query(spark, rows):
    check_near(rows, corpus.collected(run(spark, "op10_simhash")))


@pytest.mark.parametrize("name", ["op1_sharding", "op3_chat_formatting", "op7_mixing", "op8_pii"])
def test_other_queries_cover_their_tables(spark, rows, name):
    found = run(spark, name).collect()
    if name == "op3_chat_formatting":
        turns = read_table(spark, SF, "conversations")
        assert len(found) == turns.select("conv_id").distinct().count() + 1
    else:
        assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)


def test_pipeline_stages_do_what_they_say(spark, rows):
    docs = read_table(spark, SF, "documents")
    columns, texts = docs.columns, dict(rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
    names = [name for name, _ in corpus_pipeline.STAGES]
    verdicts = run(spark, "op9_quality_rules")
    assert kept[names[0]] == Counter(r.doc_id for r in verdicts.filter("kept").collect())
    first = {}
    for i in sorted(kept[names[0]]):
        first.setdefault(digest(texts[i]), i)
    assert kept[names[1]] == Counter(first.values())
    before, after = ([(i, texts[i]) for i in kept[name]] for name in (names[1], names[2]))
    check_similar(before, after)
    assert set(kept[names[3]]) <= set(kept[names[2]]) and set(kept[names[3]].values()) == {1}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packing([(i, texts[i]) for i in kept[names[3]]], pieces, packing.TIERS)
    whole = corpus_pipeline.run(spark, SF)
    wanted = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    by_doc = Counter(r.doc_id for r in whole.select(wanted).filter("start = 0").collect())
    assert by_doc == kept[names[3]]
