"""Rates of overlapping posteriors, and the largest budget under a bound."""

import logging
from collections import Counter

import numpy as np
import pytest
from test_llm_models import labelled

from tidemark.llm import mixing

WEIGHTS = np.array([0.9, 0.06, 0.04])
MIXES = {
    "soft": lambda rng: rng.dirichlet((7.5, 1.2, 1.3), 1500),
    "hard": lambda rng: np.eye(3)[rng.choice(3, 1500, p=[0.75, 0.12, 0.13])],
    "rare": lambda rng: np.eye(3)[rng.choice(3, 1500, p=[0.97, 0.02, 0.01])],
}


def made(kind):
    rng = np.random.default_rng(1)
    p = MIXES[kind](rng)
    return rng.integers(20, 2000, len(p)).astype(float), p


def in_numpy(tokens, p, most):
    """The same means as the operator's, over arrays."""
    top = np.inf if most is None else most

    def evaluate(vector):
        down = p @ vector
        r = np.clip(1 - down, 0, top)
        free = tokens * ((r > 0) & (r < top))
        total = tokens.sum()
        return tokens @ ((r - 1) ** 2 / 2 + r * down) / total, (tokens * r) @ p / total, (p * free[:, None]).T @ p / total

    return evaluate


def slow_totals(tokens, p, target, most, steps=6_000):
    """Accelerated projected gradient on the rates themselves."""
    tokens = tokens / tokens.sum()
    length = 1 / np.linalg.eigvalsh((p * tokens[:, None]).T @ p).max()
    r = ahead = np.ones(len(p))
    for n in range(steps):
        new = np.clip(ahead - length * (p @ ((tokens * ahead) @ p - target)), 0, most)
        ahead, r = new + n / (n + 3) * (new - r), new
    return (tokens * r) @ p


@pytest.mark.parametrize("kind", MIXES)
@pytest.mark.parametrize(("most", "budget"), [(None, 1.0), (1.0, 1.0), (1.0, 0.4)])
def test_totals_are_those_of_a_plain_solver(kind, most, budget):
    tokens, p = made(kind)
    vector, target, reached, done = mixing.descend(in_numpy(tokens, p, most), WEIGHTS, budget)
    assert np.allclose(target, budget * WEIGHTS)
    slow = slow_totals(tokens, p, target, np.inf if most is None else most)
    assert np.allclose(reached, slow, atol=1e-3)
    assert most or np.abs(reached - target).max() < mixing.CLOSE


@pytest.mark.parametrize("kind", MIXES)
def test_a_fitted_budget_is_the_largest(kind):
    tokens, p = made(kind)
    _, target, reached, _ = mixing.descend(in_numpy(tokens, p, 1.0), WEIGHTS, None)
    assert np.abs(reached - target).max() < mixing.CLOSE
    assert np.allclose(target / target.sum(), WEIGHTS)
    # A budget a little larger misses its target.
    more = 1.03 * target
    assert np.abs(slow_totals(tokens, p, more, 1.0) - more).max() > 2 * mixing.CLOSE
    if kind != "soft":
        shares = tokens @ p / tokens.sum()
        assert abs(target.sum() - (shares / WEIGHTS).min()) < 0.01


def test_a_thousand_random_mixes_end_without_an_error():
    """2 to 8 domains, hard and soft, bounded and not, few documents: always a vector and its totals."""
    rng, stalled = np.random.default_rng(11), 0
    for number in range(1000):
        k, n = int(rng.integers(2, 9)), int(rng.integers(3, 400))
        alpha = rng.choice([0.05, 0.5, 3.0, 30.0]) * rng.random(k) + 1e-3
        p = rng.dirichlet(alpha, n) if number % 3 else np.eye(k)[rng.integers(0, k, n)]
        tokens = rng.integers(1, 3000, n).astype(float)
        weights = rng.random(k) * rng.choice([0.0, 1.0, 1.0], k) + (np.arange(k) == 0)
        most = (None, 1.0, 3.0)[number % 3 if number % 7 else 1]
        budget = (1.0, 0.4, None)[int(rng.integers(3 if most else 2))]
        vector, target, reached, done = mixing.descend(in_numpy(tokens, p, most), weights, budget)
        assert np.isfinite(vector).all() and np.isfinite(reached).all()
        stalled += not done
        if budget:
            bounded = np.inf if most is None else most
            slow = slow_totals(tokens, p, target, bounded, 300)
            assert np.linalg.norm(reached - target) <= np.linalg.norm(slow - target) + 2e-2
    assert stalled <= 20


def test_a_descent_that_cannot_end_gives_its_best(monkeypatch):
    """Out of Newton steps at once: gradient steps come to the same end, or say that they did not."""
    monkeypatch.setattr(mixing, "MOST_STEPS", 1)
    tokens, p = made("soft")
    before = np.abs(tokens @ p / tokens.sum() - 0.4 * WEIGHTS).max()
    _, target, reached, done = mixing.descend(in_numpy(tokens, p, 1.0), WEIGHTS, 0.4)
    assert done and np.allclose(reached, slow_totals(tokens, p, target, 1.0), atol=1e-3)
    monkeypatch.setattr(mixing, "GRADIENT_STEPS", 2)
    _, target, reached, done = mixing.descend(in_numpy(tokens, p, 1.0), WEIGHTS, 0.4)
    assert not done and np.abs(reached - target).max() < before


def test_the_report_of_a_mix(spark):
    mix = mixing.Mix(["a", "b"], None, [0.0, 0.0], 1.0, [0.6, 0.4], [0.5, 0.4], False)
    assert [tuple(r) for r in mixing.mix_report(spark, mix).collect()] == [
        ("a", 0.6, 0.5, pytest.approx(-0.1), False),
        ("b", 0.4, 0.4, 0.0, False),
    ]


def test_spark_means_are_those_of_numpy(spark):
    tokens, p = made("soft")
    rows = [(int(t), x) for t, x in zip(tokens, p.tolist(), strict=True)]
    docs = spark.createDataFrame(rows, "tokens bigint, p array<double>").repartition(4)
    vector = np.array([0.3, -0.8, 2.5])
    for most in (None, 1.0):
        ours = mixing.evaluator(docs, 3, most)(vector)
        for a, b in zip(ours, in_numpy(tokens, p, most)(vector), strict=True):
            assert np.allclose(a, b)


def test_targets_out_of_reach_are_reported(spark, caplog):
    docs, _ = labelled(spark)
    none = spark.createDataFrame([], "doc_id bigint, domain string")
    with caplog.at_level(logging.WARNING):
        mix, _ = mixing.fit_mix(docs, none, {"good": 0.9, "poor": 0.1}, budget=None, most=1.0)
    assert not mix.met and np.allclose(mix.reached, [0.5, 0.5], atol=1e-3)
    assert "residual" in caplog.text
    with pytest.raises(ValueError):
        mixing.fit_mix(docs, none, {"good": 1.0}, budget=None)


def test_delivered_tokens_have_the_targets_shares(spark):
    """What the pipeline's stage does: every row at most once, at its targets' shares."""
    docs, labels = labelled(spark, 1500)
    targets = {"good": 0.9, "poor": 0.06, "toxic": 0.04}
    settings = {"budget": None, "most": 1.0}
    rows = mixing.mixing_rates(docs, labels, targets, **settings).collect()
    delivered = mixing.mix_documents(docs, labels, targets, **settings).collect()
    assert sorted(r.doc_id for r in delivered) == sorted(r.doc_id for r in rows if r.copies)
    assert max(r.copies for r in rows) == 1
    held = np.array([sum(r.n_tokens * r.copies * r[f"p_{d}"] for r in rows) for d in targets])
    assert np.abs(held / held.sum() - WEIGHTS).max() < 0.02
    # Before, a budget of all tokens was out of reach and left the shares elsewhere.
    assert 0.1 < held.sum() / sum(r.n_tokens for r in rows) < 1


def test_the_pipelines_stage_delivers_its_weights(spark, monkeypatch):
    import corpus_pipeline

    docs, labels = labelled(spark, 1500)
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_: None)
    monkeypatch.setattr(mixing, "domains_of", lambda _: labels)
    kept = corpus_pipeline.mix(spark, docs, "")
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids.values()) == {1}
    rows = mixing.mixing_rates(docs, labels, corpus_pipeline.TARGETS, budget=None, most=1.0).collect()
    held = np.array([sum(r.n_tokens * ids[r.doc_id] * r[f"p_{d}"] for r in rows) for d in corpus_pipeline.TARGETS])
    assert np.abs(held / held.sum() - WEIGHTS).max() < 0.02


def test_step_lengths_share_a_pass_and_passes_share_code(spark):
    """The driver compiles an evaluation's code once, and starts one job for all lengths of a step."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet((0.075, 0.012, 0.013), 300)
    rows = spark.createDataFrame([(n + 1, x.tolist()) for n, x in enumerate(p)], "tokens bigint, p array<double>")
    rows = rows.repartition(3).cache()
    evaluate = mixing.evaluator(rows, 3, 1.0)
    evaluate(np.array([0.3, -0.2, 1.1]))
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    before = compiled.getCount()
    vectors = [np.array([0.4, 0.7, -0.1]) / 2**n for n in range(4)]
    one_by_one = [evaluate(x) for x in vectors]
    assert compiled.getCount() == before
    passes, ahead = [], evaluate.ahead
    ahead(vectors)
    for mine, other in zip(map(evaluate, vectors), one_by_one, strict=True):
        assert all(np.allclose(x, y, rtol=1e-12) for x, y in zip(mine, other, strict=True))

    calls = []

    def counted(vector):
        calls.append(vector)
        return evaluate(vector)

    counted.ahead = lambda tried: (passes.append(len(tried)), ahead(tried))
    mixing.descend(counted, WEIGHTS, None)
    assert len(passes) < 0.6 * len(calls)
    rows.unpersist()
