import hashlib
import re
from collections import Counter, defaultdict

import corpus
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components, exact_dedup, simhash


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def check_exact(rows, result):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[digest(text)].append(doc_id)
    expected = Counter(
        (i, min((x for x in ids if x is not None), default=None), len(ids), sha)
        for sha, ids in groups.items()
        for i in ids
    )
    assert Counter((r[0], r[1], r[2], r[4]) for r in result) == expected
    kept = [r for r in result if r[3]]
    assert Counter(r[4] for r in kept) == Counter(groups.keys())
    assert all(r[0] == r[1] for r in kept)


def test_exact_duplicates_of_odd_rows(spark):
    docs = corpus.odd_docs(spark).withColumn("text_sha256", F.lit("clash"))
    result = corpus.collected(exact_dedup.exact_duplicates(docs))
    check_exact([(r[0], r[1]) for r in corpus.odd_rows()], result)


@pytest.mark.parametrize("share", [1e-3, 0.2])
def test_heavy_groups_and_light_ones_agree(spark, share):
    rows = [(i, f"copy  {i % 7}" if i % 3 else "the  hot\ttext") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    check_exact(rows, corpus.collected(exact_dedup.exact_duplicates(docs, share=share)))
    kept = exact_dedup.drop_exact_duplicates(docs, share=share)
    assert kept.columns == ["doc_id", "text"]
    expected = {min(i for i, t in rows if digest(t) == digest(text)) for _, text in rows}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_exact_dedup_keeps_columns_and_one_row_of_each_group(spark):
    docs = corpus.odd_docs(spark).withColumn("_digest", F.lit(1))
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(digest(r.text) for r in kept.collect()) == Counter(
        {digest(r[1]) for r in corpus.odd_rows()}
    )


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_duplicates(corpus.empty_docs(spark)).count() == 0
    assert exact_dedup.drop_exact_duplicates(corpus.empty_docs(spark)).count() == 0


def fingerprint(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = max(1, len(found) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def labels_of(prints, limit=2):
    """Smallest reachable fingerprint's members by brute force."""
    distinct = sorted(set(prints))
    parent = {x: x for x in distinct}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= limit:
                parent[root(a)] = root(b)
    return {x: root(x) for x in distinct}


def check_near(rows, result):
    prints = [fingerprint(text) for _, text in rows]
    root = labels_of(prints)
    smallest = {}
    for (doc_id, _), mark in zip(rows, prints, strict=True):
        if doc_id is not None:
            smallest[root[mark]] = min(doc_id, smallest.get(root[mark], doc_id))
    expected = Counter(
        (doc_id, f"{mark:016x}", smallest.get(root[mark]))
        for (doc_id, _), mark in zip(rows, prints, strict=True)
    )
    assert Counter(result) == expected


@pytest.mark.parametrize("crowd", [64, 2, 1])
def test_near_duplicates_against_brute_force(spark, crowd):
    rows = [(r[0], r[1]) for r in corpus.odd_rows()]
    for i in range(40):
        base = corpus.prose(100 + i % 4, 300).split()
        base[i * 7 % 300] = f"changed{i}"
        rows.append((100 + i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("bits", F.lit("clash"))
    found = simhash.near_duplicates(docs, crowd=crowd).select("doc_id", "fingerprint", "component_id")
    check_near(rows, corpus.collected(found))


def _links(spark, prints, crowd):
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in set(prints)]
    links = simhash.links(spark.createDataFrame(signed, "bits bigint"), crowd)
    nodes = components.connected_components(links).collect()
    return {r.node % (1 << 64): r.label % (1 << 64) for r in nodes}


@pytest.mark.parametrize("crowd", [64, 4])
def test_links_lose_no_pair_in_a_dense_crowd(spark, crowd):
    import random

    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for base in list(prints)[:6]:
        for _ in range(30):
            base ^= 1 << rng.randrange(64)
            prints |= {base, base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    root, found = labels_of(prints), _links(spark, prints, crowd)
    ours = {x: found.get(x, x) for x in prints}
    pairs = {(root[x], ours[x]) for x in prints}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_every_close_pair_has_a_chain_within_budget():
    for i in range(64):
        for j in range(i, 64):
            differing = (1 << i) | (1 << j)
            assert any(
                all(
                    (differing & simhash._chain(start, length)).bit_count() <= simhash.budget(length)
                    for length in range(1, simhash.SEGMENTS + 1)
                )
                for start in range(simhash.SEGMENTS)
            )


def test_dropping_near_duplicates(spark):
    docs = corpus.odd_docs(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect())
    root = labels_of([fingerprint(r[1]) for r in corpus.odd_rows()])
    groups = defaultdict(set)
    for r in corpus.odd_rows():
        if r[0] is not None:
            groups[root[fingerprint(r[1])]].add(r[0])
    assert ids == sorted(min(g) for g in groups.values())


def test_near_dedup_of_nothing(spark):
    assert simhash.near_duplicates(corpus.empty_docs(spark)).count() == 0
    assert simhash.drop_near_duplicates(corpus.empty_docs(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a bigint, b bigint")
    labels = {r.node: r.label for r in components.connected_components(links).collect()}
    assert labels == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
