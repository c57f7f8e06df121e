"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import corpus
import numpy as np
import pytest

from tidemark.llm import catalog, dualtree
from tidemark.sources.tables import read_table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, most=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, length = len(held), sum(size for _, _, size in held)
    df = Counter(term for _, c, _ in held for term in c)
    rows = []
    for item, text in items:
        wanted = Counter(terms(text))
        scored = []
        for i, counts, size in held:
            m = 75 + 25 * size * n // length
            score = 0
            for term, times in wanted.items():
                tf = counts[term]
                if tf:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += times * w * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:most], 1):
            rows.append((item, rank, i, -score))
    return rows


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id bigint, text string, score int, doc_id string")


def mixed(n):
    """Documents with ties, repeats and rare words; items from them."""
    rng = random.Random(n)
    common = [f"w{i}" for i in range(60)]
    rare = [f"r{i}é" for i in range(300)]
    docs = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(0, 60)) + rng.choices(rare, k=rng.randint(0, 6))
        rng.shuffle(words)
        docs.append((i if i % 50 else None, rng.choice((" ", "-", "\x00", "  ")).join(words)))
        if i % 9 == 0:
            docs.append((n + i, docs[-1][1].upper()))
    docs += [docs[3], docs[3]]
    items = [(k, " ".join(rng.choices(common, k=5) + rng.choices(rare, k=4))) for k in range(40)]
    items += [(40, "w1 w1 w1 W1!w2"), (41, None), (42, ""), (43, "absent"), (None, "w3 r7é"), (40, "w9"), (44, "--- \x7f")]
    return docs, items


@pytest.mark.parametrize(("pack", "batch", "most"), [(1024, 8, 20), (32, 3, 5), (70, 1, 1)])
def test_ranks_against_brute_force(spark, monkeypatch, pack, batch, most):
    monkeypatch.setattr(dualtree, "PACK", pack)
    monkeypatch.setattr(dualtree, "BATCH", batch)
    docs, items = mixed(700)
    table = spark.createDataFrame([(*d, "c", 2) for d in docs], "doc_id bigint, text string, item_id string, rank int")
    found = dualtree.rank_documents(table, items_of(spark, items), most=most)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(corpus.collected(found)) == Counter(brute(docs, items, most))


def test_items_in_blocks_give_the_same_ranks(spark, monkeypatch):
    monkeypatch.setattr(dualtree, "BLOCK_ITEMS", 10)
    docs, items = mixed(120)
    items.append((99, "w5 " * 30 + "r2é"))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = dualtree.rank_documents(table, items_of(spark, items))
    assert Counter(corpus.collected(found)) == Counter(brute(docs, items))


def test_odd_documents_and_nothing(spark):
    odd, nothing = corpus.odd_docs(spark), corpus.empty_docs(spark)
    items = [(1, corpus.prose(2, 12)), (2, "ünï çödé DON'T 漢字"), (3, None)]
    rows = [(r[0], r[1]) for r in corpus.odd_rows()]
    found = dualtree.rank_documents(odd, items_of(spark, items))
    assert Counter(corpus.collected(found)) == Counter(brute(rows, items))
    assert dualtree.rank_documents(nothing, items_of(spark, items)).count() == 0
    assert dualtree.rank_documents(odd, items_of(spark, [])).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " .")], "doc_id bigint, text string")
    assert dualtree.rank_documents(blank, items_of(spark, items)).count() == 0


def test_bounds_prune_and_whole_number_arithmetic_agrees():
    rng = random.Random(5)
    common, rare = [b"w%d" % i for i in range(50)], [b"r%d" % i for i in range(2000)]
    texts = [b" ".join(rng.choices(common, k=30) + rng.choices(rare, k=10)) for _ in range(2000)]
    items = dualtree.Items([b" ".join(rng.choices(rare, k=6) + common[:1]) for _ in range(40)])
    batch = dualtree._counted(items)
    import pyarrow as pa

    source = pa.RecordBatch.from_arrays(
        [pa.array(range(2000)), pa.array(texts, pa.binary())], ["doc_id", "text"]
    )
    packs = list(batch(iter([source])))
    held = next(dualtree._held(iter(packs)))
    frequency = np.zeros(len(items.index), np.int64)
    frequency[held.column("term").to_numpy() - 1] = held.column("held").to_numpy()
    weight = dualtree.weights(frequency, 2000)

    def searched(kind=None):
        search = dualtree.Search(items, weight, 2000, 80_000, 5)
        search.kind = kind or search.kind
        kinds = (np.int64, np.bool_, np.int64, np.int64, np.int32, np.int64)
        for pack in packs:
            columns = [pack.column(x)[0].as_buffer() for x in dualtree.COUNTED_NAMES[2:]]
            ids, known, sizes, ends, term, count = (np.frombuffer(c, k) for c, k in zip(columns, kinds, strict=True))
            search.pack(ids, known, sizes, ends, term.astype(np.int64) - 1, count)
        return search

    fast, whole = searched(), searched(np.int64)
    assert fast.kind is np.float64 and fast.result().equals(whole.result())
    assert fast.scored < 2000 * 40 / 2


def test_registered_search(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (
        corpus.collected(read_table(spark, sf, name).select(*columns))
        for name, columns in (("documents", ("doc_id", "text")), ("benchmark", ("item_id", "text")))
    )
    found = corpus.collected(catalog.QUERIES["op12_lexical_search"](spark, sf))
    assert Counter(found) == Counter(brute(docs, items))
