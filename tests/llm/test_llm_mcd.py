"""The outlier test's verdicts against the same estimates in numpy."""

import math
from collections import defaultdict

import numpy as np
import pytest
from conftest import plan_text
from test_llm_texts import base_counts

from tidemark.llm import quality_rules
from tidemark.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def quantile(values, share):
    """The smallest value that at least the share of all values do not exceed."""
    ordered = np.sort(values)
    return ordered[max(0, math.ceil(share * len(ordered)) - 1)]


def moments(data):
    return data.mean(axis=0), np.cov(data.T, bias=True)


def floored(covariance, scale=1.0):
    floors = np.array([quality_rules.FLOORS[x] for x in quality_rules.NAMES])
    return covariance * scale + np.diag(floors**2)


def distances(data, mean, covariance):
    return np.einsum("ij,jk,ik->i", data - mean, np.linalg.inv(covariance), data - mean)


def estimate(data):
    """C-steps from two starts, the better by determinant, scaled by the median distance."""
    spread = [(quantile(x, 0.75) - quantile(x, 0.25)) / 1.349 for x in data.T]
    starts = [(np.array([quantile(x, 0.5) for x in data.T]), np.diag(np.square(spread))), moments(data)]
    ends = []
    for mean, covariance in starts:
        for _ in range(quality_rules.C_STEPS):
            d = distances(data, mean, floored(covariance))
            mean, covariance = moments(data[d <= quantile(d, quality_rules.KEEP)])
        ends.append((np.linalg.slogdet(floored(covariance))[1], mean, covariance))
    _, mean, covariance = min(ends, key=lambda x: x[0])
    scale = max(1.0, quantile(distances(data, mean, floored(covariance)), 0.5) / quality_rules.MEDIAN_5)
    return mean, floored(covariance, scale)


def judged(rows):
    """doc_id to (distance, kept) in plain Python from the query's own counts."""
    names = quality_rules.NAMES
    vectors, groups = {}, defaultdict(list)
    for r in rows:
        def percent(part, whole):
            return math.log1p(100 * part / max(whole, 1))

        vectors[r.doc_id] = np.array([
            math.log(max(r.word_chars, 1) / max(r.n_words, 1)), percent(r.n_symbols, r.word_chars),
            percent(r.n_dup_lines, r.n_lines), percent(r.n_repeat_words, r.n_words), percent(r.n_marks, r.word_chars),
        ])
        if not r.base_failed:
            for key in ((r.lang, r.source), (r.lang,), ()):
                groups[key].append(vectors[r.doc_id])
    assert names[0] == "word_length" and len(names) == 5
    fits = {k: estimate(np.array(v)) for k, v in groups.items() if len(v) >= quality_rules.SMALLEST_GROUP}
    result = {}
    for r in rows:
        fit = next((fits[k] for k in ((r.lang, r.source), (r.lang,), ()) if k in fits), None)
        d = distances(vectors[r.doc_id][None], *fit)[0] if fit else 0.0
        result[r.doc_id] = (d, not r.base_failed and d <= quality_rules.CUTOFF_5)
    return result


@pytest.mark.parametrize("few", [True, False])
def test_verdicts_are_those_of_numpy(spark, monkeypatch, few):
    """Also with fits that meet their rows under salts instead of by broadcast."""
    monkeypatch.setattr(quality_rules, "MOST_GROUPS", 20_000 if few else 0)
    docs = read_table(spark, SF, "documents")
    rows = quality_rules.quality(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((r.n_words, r.word_chars) == base_counts(texts[r.doc_id])[:2] for r in rows)
    wanted = judged(rows)
    close = [i for i, (d, _) in wanted.items() if abs(d - quality_rules.CUTOFF_5) < 1e-6]
    assert len(close) < 3
    assert {r.doc_id: r.kept for r in rows if r.doc_id not in close} == {
        i: kept for i, (_, kept) in wanted.items() if i not in close
    }
    assert {r.kept for r in rows} == {True, False}


def test_rows_stay_where_they_are(spark, monkeypatch):
    """Only partial aggregates are exchanged: no join of rows by shuffle."""
    plans = []
    real = quality_rules.stored
    monkeypatch.setattr(
        quality_rules, "stored", lambda df, label: (plans.append((label, plan_text(df))), real(df, label))[1]
    )
    quality_rules.keep_good(read_table(spark, SF, "documents")).count()
    fits = [plan for label, plan in plans if label == "quality-fit"]
    assert len(fits) == quality_rules.C_STEPS + 1
    assert all("SortMergeJoin" not in plan and "BroadcastHashJoin" in plan for plan in fits)
