"""Similarity of shingles against brute force."""

import corpus
import pytest

from tidemark.llm import similar
from tidemark.sources.tables import read_table


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def close(a, b):
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def check_similar(rows, kept):
    """One row of each component of similar rows stays."""
    sets = {row: shingle_set(row[1]) for row in set(rows)}
    near = {r: [s for s in sets if s != r and close(sets[r], sets[s])] for r in sets}
    assert len(kept) == len(set(kept)) and set(kept) <= set(sets)
    stay = set(kept)
    assert not any(s in stay for r in stay for s in near[r])
    seen, groups = set(), 0
    for r in sets:
        if r not in seen:
            group, todo = {r}, [r]
            while todo:
                new = set(near[todo.pop()]) - group
                group |= new
                todo += new
            seen |= group
            groups += 1
            assert group & stay
    assert len(stay) == groups
    return len(sets) - len(stay)


def chains():
    """Odd rows and texts that drift apart step by step."""
    rows = [(r[0], r[1]) for r in corpus.odd_rows()]
    for i in range(60):
        base = corpus.prose(100 + i % 4, 60 + 90 * (i % 4)).split()
        for k in range(i // 10):
            base[(i * 7 + k * 31) % len(base)] = f"changed{i}x{k}"
        rows.append((100 + i, " ".join(base)))
    return rows


@pytest.mark.parametrize(("rounds", "pack", "block"), [(2, 256, 1 << 20), (0, 7, 5000), (1, 3, 300), (5, 256, 20_000)])
def test_one_row_of_each_component_stays(spark, monkeypatch, rounds, pack, block):
    """Whatever the rounds, packs and blocks are, down to a few shingles a block."""
    monkeypatch.setattr(similar, "PACK", pack)
    monkeypatch.setattr(similar, "BLOCK_BYTES", block)
    rows = chains()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = similar.drop_similar(docs, rounds=rounds)
    assert kept.columns == docs.columns
    assert check_similar(rows, corpus.collected(kept)) > 20


def test_boilerplate_hides_no_pair(spark, monkeypatch):
    shared = corpus.prose(9, 60)
    rows = [(i, shared + " " + corpus.prose(i // 2, 150) + f" end{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check_similar(rows, corpus.collected(similar.drop_similar(docs))) == 150


def test_a_key_of_many_dissimilar_texts_is_done_in_one_go(spark, monkeypatch):
    """3,000 texts, each under one shingle all of them share, and two that are similar."""
    same = corpus.prose(3, 5, 100)
    rows = [(i, f"{same} a{i} b{i}") for i in range(3000)] + [(5000, f"{same} a7 b7 c"), (5001, f"{same} a7 b7 c d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    calls = []
    real = similar.connected_components
    monkeypatch.setattr(similar, "connected_components", lambda x: calls.append(1) or real(x))
    monkeypatch.setattr(similar, "key_count", lambda n: n)
    kept = {r.doc_id for r in similar.drop_similar(docs).collect()}
    assert len(calls) == similar.ROUNDS + 2
    assert len(kept) == 3001 and len(kept & {5000, 5001}) == 1


def test_large_groups_of_copies_are_not_paired_out(spark, monkeypatch):
    """1,200 near copies: candidates stay in proportion to the texts."""
    base = corpus.prose(5, 300).split()
    rows = []
    for i in range(1200):
        words = list(base)
        words[(i * 37) % 300] = f"x{i}"
        rows.append((i, " ".join(words)))
    seen = []
    real = similar._similar
    monkeypatch.setattr(similar, "_similar", lambda pairs, texts: seen.append(pairs.count()) or real(pairs, texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert similar.drop_similar(docs).count() == 1
    assert sum(seen) < 5 * 1200


def test_sketches_never_differ_more_than_texts():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 30, 900):
        a, b = (np.unique(rng.integers(0, 2 * n, n)) for _ in range(2))
        apart = int(np.bitwise_count((similar.sketch(a) ^ similar.sketch(b)).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_no_similar_pair_of_a_test_table_stays(spark, sf):
    docs = read_table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "text")
    rows = corpus.collected(docs)
    assert check_similar(rows, corpus.collected(similar.drop_similar(docs))) > 0


def test_similar_of_nothing(spark):
    assert similar.drop_similar(corpus.empty_docs(spark)).count() == 0


def test_fingerprints_link_first_and_lose_nothing(spark, monkeypatch):
    """The pipeline's stage: SimHash pairs, verified, then the exact way; the rows of brute force."""
    import corpus_pipeline

    rows = chains()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = []
    real = similar.nearest_links

    def linking(*args):
        pairs = real(*args)
        found.extend((r.a, r.b) for r in pairs.collect())
        return pairs

    monkeypatch.setattr(similar, "nearest_links", linking)
    kept = corpus_pipeline.near(spark, docs, "")
    assert check_similar(rows, corpus.collected(kept)) > 20
    assert 0 < len(found) <= 2 * len(rows)
    plain = similar.drop_similar(docs)
    assert sorted(corpus.collected(kept), key=str) == sorted(corpus.collected(plain), key=str)


@pytest.mark.parametrize("crowd", [64, 2])
def test_nearest_links_join_what_links(spark, crowd):
    """Crowded or not, each row of a component of several meets another row of it."""
    from tidemark.llm import simhash

    base = corpus.prose(5, 200).split()
    texts = [" ".join([*base[: i % 20], f"x{i % 20}", *base[i % 20 + 1 :]]) for i in range(60)] + [corpus.prose(77, 50)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n bigint, text string")
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows, "n", "text", 5).collect()}
    pairs = simhash.nearest_links(rows.selectExpr("n", "CAST(text AS BINARY) AS text"), 5, crowd).collect()
    assert all(groups[r.a] == groups[r.b] and r.a < r.b for r in pairs)
    sizes = {g: list(groups.values()).count(g) for g in groups.values()}
    assert {x for r in pairs for x in (r.a, r.b)} == {n for n, g in groups.items() if sizes[g] > 1}


def test_rounds_that_find_nothing_are_short(spark, monkeypatch):
    """Nothing is compared or joined anew without candidates, and packs are made once; the driver plans no more than that."""
    from tidemark.llm import components

    made = []
    real = similar.stored
    for module in (similar, components):
        monkeypatch.setattr(module, "stored", lambda df, label: made.append(label) or real(df, label))
    shared = corpus.prose(9, 6)
    apart = [(i, f"{shared} {corpus.prose(500 + i, 40)}") for i in range(20)]
    docs = spark.createDataFrame(apart, "doc_id bigint, text string")
    assert check_similar(apart, corpus.collected(similar.drop_similar(docs, fingerprints=True))) == 0
    assert made.count("candidates") == similar.ROUNDS + 3
    assert not {"similar", "labels", "hooked"} & {*made} and made.count("packs") == 1
    made.clear()
    rows = [*apart, (50, apart[3][1] + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check_similar(rows, corpus.collected(similar.drop_similar(docs))) == 1
    assert made.count("candidates") == similar.ROUNDS + 2
    assert made.count("similar") == made.count("hooked") == made.count("packs") == 1


@pytest.mark.parametrize("crowd", [64, 2])
def test_keys_are_refined_only_where_crowded(spark, monkeypatch, crowd):
    from tidemark.llm import simhash

    made = []
    real = simhash.stored
    monkeypatch.setattr(simhash, "stored", lambda df, label: made.append(label) or real(df, label))
    prints = spark.createDataFrame([(x,) for x in (0, 1, 2, 4, 7, 1 << 40)], "bits bigint")
    links = {frozenset((r.a, r.b)) for r in simhash.links(prints, crowd).collect()}
    assert made.count("keys") == (1 if crowd > 2 else 2)
    if crowd > 2:
        assert links == {frozenset(x) for x in [(0, 1), (0, 2), (0, 4), (0, 1 << 40), (1, 2), (1, 4), (2, 4), (1, 7), (2, 7), (4, 7), (1, 1 << 40), (2, 1 << 40), (4, 1 << 40)]}
