import random
from collections import Counter

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules, substrings


def cut(rows, window):
    """Brute force: rows in order of id, ids of a kind together; null ids last, by text hash."""
    first = {}
    for doc_id, text in rows:
        found = corpus.words(text)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        found = corpus.words(text)
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(found, gone, strict=True) if not g)
        out.append((doc_id, len(found), sum(gone), kept))
    return out


def removed(df, **settings):
    found = substrings.remove_repeats(df, **settings)
    return Counter(corpus.collected(found.select("doc_id", "n_words", "n_removed", "kept_text")))


def test_removal_in_odd_rows(spark):
    docs = corpus.odd_docs(spark).withColumn("kept_text", F.lit(1))
    result = substrings.remove_repeats(docs)
    assert "text" not in result.columns and "lang" in result.columns
    known = [(r[0], r[1]) for r in corpus.odd_rows() if r[0] is not None]
    expected = Counter(cut(known, 50))
    # The rows without an id: one text is new, the other is wholly in a smaller document.
    expected[(None, 70, 0, corpus.prose(5, 70))] += 1
    expected[(None, 120, 120, "")] += 1
    found = Counter(corpus.collected(result.select("doc_id", "n_words", "n_removed", "kept_text")))
    assert found == expected


@pytest.mark.parametrize("window", [50, 31, 64])
@pytest.mark.parametrize("parts", [1, 7])
def test_removal_against_brute_force(spark, window, parts):
    rng = random.Random(window + parts)
    pool = [corpus.prose(i, 150).split() for i in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(1, 5)):
            source = rng.choice(pool)
            a = rng.randrange(100)
            text += source[a : a + rng.randint(20, 120)] + [f"own{rng.random()}"] * rng.randint(0, 2)
        rows.append((rng.randrange(50), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    assert removed(docs, window=window) == Counter(cut(rows, window))


def test_removal_just_at_the_window(spark):
    shared = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(shared))]
    for n in range(45, 55):
        for shift in range(3):
            rows.append((n * 10 + shift, " ".join(["x"] * shift + shared[:n] + [f"y{n}{shift}"])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert removed(docs) == Counter(cut(rows, 50))


def test_removal_of_nothing(spark):
    assert substrings.remove_repeats(corpus.empty_docs(spark)).count() == 0


def test_the_cover_holds_every_shift():
    shifts = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert shifts == set(range(substrings.PERIOD))


def test_spans_name_the_removed_words(spark):
    a = corpus.prose(1, 60)
    docs = spark.createDataFrame([(1, a), (2, f"new words {a} end")], "doc_id int, text string")
    rows = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert rows[1].removed_spans == [] and rows[1].kept_text == a
    assert [tuple(x) for x in rows[2].removed_spans] == [(2, 61)]
    assert rows[2].kept_text == "new words end"


def base_counts(text):
    text = text or ""
    found = corpus.words(text)
    n = len(found)
    lines = [line for line in text.split("\n") if corpus.words(line)]
    windows = Counter(tuple(found[i : i + 8]) for i in range(n - 7))
    covered = [False] * n
    for i in range(n - 7):
        if windows[tuple(found[i : i + 8])] > 1:
            covered[i : i + 8] = [True] * 8
    repeated = sum(covered)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = n < 20 or 100 * repeated > 30 * n
    return (n, sum(map(len, found)), symbols, len(lines) - len(set(lines)), repeated, failed)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_of_odd_rows(spark):
    docs = corpus.odd_docs(spark).withColumn("n_words", F.lit("clash"))
    result = quality_rules.quality(docs)
    assert Counter(corpus.collected(result.select("doc_id", *COUNTS))) == Counter(
        (r[0], *base_counts(r[1])) for r in corpus.odd_rows()
    )
    assert not [r for r in result.collect() if r.base_failed and r.kept]


def test_quality_of_nothing(spark):
    assert quality_rules.quality(corpus.empty_docs(spark)).count() == 0
    assert quality_rules.keep_good(corpus.empty_docs(spark)).count() == 0


def test_outliers_go_and_the_bulk_stays(spark):
    rows = [(i, corpus.prose(i, 40 + i % 200), "en", f"s{i % 2}", 1) for i in range(300)]
    junk = [
        (1000 + i, " ".join(f"{w}###" for w in corpus.prose(i, 100).split()), "en", "s0", 1)
        for i in range(40)
    ]
    docs = spark.createDataFrame(rows + junk, corpus.SCHEMA)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows}


def test_estimates_against_numpy(spark):
    """The best of the C-steps' fits has no larger determinant than numpy's from the same starts."""
    rng = np.random.default_rng(5)
    clean = rng.multivariate_normal(np.zeros(5), np.diag([1, 2, 3, 4, 5]), 800)
    bad = rng.normal(30, 1, (150, 5))
    data = np.concatenate([clean, bad])
    rows = [(0, "en", "a", *map(float, x)) for x in data]
    schema = "level int, g_lang string, g_source string, " + ", ".join(
        f"{x} double" for x in quality_rules.NAMES
    )
    fit = quality_rules.estimates(spark.createDataFrame(rows, schema)).first()
    mean = np.array([fit[f"m{i}"] for i in range(5)])
    assert np.abs(mean).max() < 0.5
    white = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            white[i, j] = fit[f"w{i}{j}"]
    covariance = np.linalg.inv(white.T @ white)
    floors = np.array(list(quality_rules.FLOORS.values())) ** 2
    assert np.allclose(np.diag(covariance), [1, 2, 3, 4, 5] + floors, rtol=0.35)
    d = ((white @ (data - mean).T) ** 2).sum(axis=0)
    assert d[800:].min() > quality_rules.CUTOFF_5 > np.quantile(d[:800], 0.99)


