"""Mixing documents to target weights of domains they belong to softly.

A classifier fitted on a labelled table gives each document its posterior over the
domains. Nonnegative document rates are then chosen whose expected domain token totals,
the sum of rate x tokens x posterior, match the targets in the least-squares sense.

Of all such rates those nearest to one are taken. They are the projection of one gradient
step from rates of one: a document's rate is 1 - p . v within the bounds, ``p`` being its
posterior and ``v`` one vector with an entry per domain. So the state of the descent is
that vector: any task can compute a document's rate from its posterior, and each step is
one aggregate over the posteriors, which tries several lengths of it. Steps are taken in the full metric of the documents
that lie within the bounds, until the optimality condition holds.

Without a given budget the largest one is fitted with the rates at which a bound on them
still allows the targets' shares.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE, stored, text_of
from tidemark.session import new_folder

FEATURES = 1 << 14
SAMPLE = 20_000  # labelled documents the classifier is fitted on, at most
FIT_STEPS = 40
MOST_STEPS = 120  # aggregates after which Newton steps give way to gradient steps
GRADIENT_STEPS = 200  # evaluations for those, at most
AHEAD = 8  # lengths of a Newton step that are evaluated in one pass
SHORTEST = 2.0**-20  # part of a Newton step below which it is no help
CLOSE = 1e-4  # residual, as a share of all tokens, at which a target counts as met
OPTIMAL = 1e-6  # norm of the gradient, as a share of all tokens, at which the descent ends
# Weights of the rates' distance from one beside the residual: each fit starts from the last.
RIDGES = (1e-2, 1e-4, 1e-6)
# Weights of the budget, where it is fitted, beside the rates' distance from one.
GAINS = (1.0, 10.0, 100.0)
LEAST_BUDGET = 0.01  # a fitted budget below shows targets out of reach
SEED = 7
LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Mix:
    """A fitted mix: the classifier, the rates' vector, and what it reaches.

    ``target`` and ``reached`` are expected token totals per domain as shares of all
    tokens; their difference is the ``residual``.
    """

    domains: list[str]
    model: LogisticRegressionModel | None
    vector: list[float]
    most: float | None
    target: list[float] = field(default_factory=list)
    reached: list[float] = field(default_factory=list)
    converged: bool = True

    @property
    def residual(self) -> list[float]:
        return [got - wanted for got, wanted in zip(self.reached, self.target, strict=True)]

    @property
    def met(self) -> bool:
        return all(abs(x) <= CLOSE for x in self.residual)


def mix_report(spark: SparkSession, mix: Mix) -> DataFrame:
    """One row per domain: target, reached and residual as shares of all tokens, and converged."""
    rows = [(*row, mix.converged) for row in zip(mix.domains, mix.target, mix.reached, mix.residual, strict=True)]
    kinds = "domain string, target double, reached double, residual double, converged boolean"
    return spark.createDataFrame(rows, kinds)


def _features(df: DataFrame, text: Column) -> DataFrame:
    """Adds _tokens and _features: unit vectors of hashed word counts."""
    words = F.regexp_extract_all(F.lower(text_of(text)), F.lit(f"{NOT_SPACE}+"), F.lit(0))
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=FEATURES).transform(
        df.withColumn("_words", words)
    )
    unit = Normalizer(inputCol="_counts", outputCol="_features").transform(counted)
    return unit.withColumn("_tokens", F.size("_words").cast("bigint")).drop("_words", "_counts")


def labelled_sample(labels: DataFrame, domains: list[str], sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled ids with their domain's number, by a hash of the id."""
    number = F.array_position(F.array(*[F.lit(x) for x in domains]), F.col("domain")) - 1
    return (
        labels.filter(F.col("doc_id").isNotNull() & (number >= 0))
        .groupBy("doc_id")
        .agg(F.min(number).cast("double").alias("label"))
        .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
        .limit(sample)
    )


def fit_classifier(
    docs: DataFrame, labels: DataFrame, domains: list[str], doc_id: str, text: str, sample: int
) -> LogisticRegressionModel | None:
    """Multinomial logistic regression on the labelled sample; None without labelled documents."""
    chosen = stored(labelled_sample(labels, domains, sample), "labelled-sample")
    # At most ``sample`` rows: proven to be small.
    known = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    rows = known.join(F.broadcast(chosen), "doc_id").select("label", "_text")
    training = stored(_features(rows, F.col("_text")).select("label", "_features"), "training-rows")
    if training.isEmpty():
        return None
    classifier = LogisticRegression(
        featuresCol="_features",
        family="multinomial",
        regParam=1e-4,
        maxIter=FIT_STEPS,
        probabilityCol="_posterior",
        rawPredictionCol="_raw",
        predictionCol="_best",
    )
    # A model read back holds no reference to the session, which tasks could not carry.
    path = new_folder(docs.sparkSession, "classifier")
    classifier.fit(training).write().save(path)
    return LogisticRegressionModel.load(path)


def _posteriors(df: DataFrame, text: Column, mix: Mix) -> DataFrame:
    """Adds _tokens and _p; without a classifier, or for classes it never saw, shares are even or zero."""
    k = len(mix.domains)
    rows = _features(df, text)
    if mix.model is None:
        return rows.drop("_features").withColumn("_p", F.array(*[F.lit(1.0 / k)] * k))
    out = mix.model.transform(rows).withColumn("_p", vector_to_array("_posterior"))
    padded = F.array(*[F.coalesce(F.get("_p", i), F.lit(0.0)) for i in range(k)])
    return out.withColumn("_p", padded).drop("_features", "_raw", "_posterior", "_best")


def rate(vector: list[float] | list[Column], p: Column, most: float | None) -> Column:
    """The rate 1 - p . vector, projected onto the bounds."""
    down = sum((F.get(p, i) * F.lit(v) for i, v in enumerate(vector)), F.lit(0.0))
    bounded = F.greatest(F.lit(1.0) - down, F.lit(0.0))
    return bounded if most is None else F.least(bounded, F.lit(float(most)))


# At a vector: the least value of half the rates' squared distance from one plus rate x
# (p . vector), the domain totals of its rates, and the overlap of documents within the bounds.
Evaluate = Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]]


def evaluator(rows: DataFrame, k: int, most: float | None) -> Evaluate | None:
    """Means over the tokens of (tokens, p) rows; None without tokens."""
    tokens = F.col("tokens").cast("double")
    share = [F.get("p", i) for i in range(k)]
    total = rows.agg(F.sum(tokens)).first()[0]
    if not total:
        return None
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]

    # Vectors stand in the rows, not in the expressions: as literals their numbers would have the
    # driver generate and compile new code for each evaluation.
    entry = [F.get("v", i) for i in range(k)]
    now, t = F.col("now"), F.col("t")
    down = sum((share[i] * entry[i] for i in range(k)), F.lit(0.0))
    free = (now > 0) if most is None else (now > 0) & (now < most)
    sums = [
        F.sum(t * ((now - 1) * (now - 1) / 2 + now * down)),
        *[F.sum(t * now * share[i]) for i in range(k)],
        *[F.sum(F.when(free, t * share[i] * share[j]).otherwise(0.0)) for i, j in pairs],
    ]
    known: dict[bytes, tuple[float, np.ndarray, np.ndarray]] = {}

    def ahead(vectors: list[np.ndarray]) -> None:
        """Evaluate several vectors in one pass; only the last pass is remembered."""
        known.clear()
        tried = [
            F.struct(F.lit(n).alias("at"), F.array(*[F.lit(float(x)) for x in vector]).alias("v"))
            for n, vector in enumerate(vectors)
        ]
        beside = rows.select("p", tokens.alias("t"), F.inline(F.array(*tried)))
        rated = beside.withColumn("now", rate(entry, F.col("p"), most))
        for at, *told in rated.groupBy("at").agg(*sums).collect():
            values = np.array(told, float) / total
            overlap = np.zeros((k, k))
            for (i, j), value in zip(pairs, values[k + 1 :], strict=True):
                overlap[i, j] = overlap[j, i] = value
            known[vectors[at].tobytes()] = values[0], values[1 : k + 1], overlap

    def evaluate(vector: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        if vector.tobytes() not in known:
            ahead([vector])
        return known[vector.tobytes()]

    evaluate.ahead = ahead
    return evaluate


def ascend(
    evaluate: Evaluate, start: np.ndarray, basis: np.ndarray, target: np.ndarray, ridge: float
) -> tuple[np.ndarray, np.ndarray, bool]:
    """The vector at which residual = ridge x vector along ``basis``, its domain totals, and
    whether it was reached.

    That is where the rates are optimal. Damped Newton steps with a line search on the
    concave dual; where no step helps, or after ``MOST_STEPS`` evaluations, gradient steps on the
    rates, first of a length that the overlap's bound of one makes safe and then scaled by
    the curvature met (BFGS). The highest vector met is returned in any case.
    """

    def judged(vector):
        value, totals, overlap = evaluate(vector)
        height = value - target @ vector - ridge / 2 * vector @ vector
        return height, basis.T @ (totals - target - ridge * vector), totals, overlap

    def settled(slope) -> bool:
        return bool(np.abs(slope).max(initial=0.0) <= OPTIMAL)

    vector = start
    height, slope, totals, overlap = judged(vector)
    used, stuck = 1, False
    while not settled(slope) and not stuck and used < MOST_STEPS:
        damping = ridge + 0.1 * np.linalg.norm(slope) / (1 + np.linalg.norm(vector))
        inner = basis.T @ overlap @ basis + damping * np.eye(basis.shape[1])
        step, size, stuck = np.linalg.solve(inner, slope), 1.0, True
        if hasattr(evaluate, "ahead"):
            evaluate.ahead([vector + size / 2**n * (basis @ step) for n in range(AHEAD)])
        while size > SHORTEST and used < MOST_STEPS:
            there = judged(vector + size * (basis @ step))
            used += 1
            # What rounding leaves of the last digits counts as no loss.
            if there[0] >= height + 1e-4 * size * (slope @ step) - 1e-13 * (1 + abs(height)):
                vector, stuck = vector + size * (basis @ step), False
                height, slope, totals, overlap = there
                break
            size /= 2
    # Posteriors add up to one at most, so the overlap's largest eigenvalue is at most one.
    inverse, used = np.eye(basis.shape[1]) / (1 + ridge), 0
    while not settled(slope) and used < GRADIENT_STEPS:
        step, size = inverse @ slope, 1.0
        there = judged(vector + basis @ step)
        used += 1
        while there[0] < height + 1e-4 * size * (slope @ step) and size > SHORTEST and used < GRADIENT_STEPS:
            size /= 4
            there = judged(vector + size * (basis @ step))
            used += 1
        if there[0] < height:
            break
        moved, turned = size * step, slope - there[1]
        vector = vector + basis @ moved
        height, slope, totals, overlap = there
        along = moved @ turned
        if along > 1e-18:
            # The change of the gradient tells the curvature along the step.
            left = np.eye(len(moved)) - np.outer(moved, turned) / along
            inverse = left @ inverse @ left.T + np.outer(moved, moved) / along
    return vector, totals, settled(slope)


def descend(
    evaluate: Evaluate, weights: np.ndarray, budget: float | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """The rates' vector, the target and reached totals as shares of all tokens, and whether
    the descent ended at an optimum (else at the best vector it met).

    Without a budget the largest feasible one is fitted. If no part of the tokens can have
    the targets' shares (a domain is nowhere, or posteriors are even), a budget of one
    is fitted in the least-squares sense.
    """
    weights = weights / weights.sum()
    k = len(weights)
    if budget is None:
        # The budget's own optimality fixes weights . vector; the rest moves along the basis.
        basis = np.linalg.svd(weights[None, :])[2][1:].T
        vector = -weights / (weights @ weights)
        for before, gain in zip((1.0, *GAINS), GAINS, strict=False):
            vector, totals, done = ascend(evaluate, vector * gain / before, basis, np.zeros(k), 1e-6 / gain)
        budget = float(weights @ totals / (weights @ weights))
        if budget >= LEAST_BUDGET:
            return vector, budget * weights, totals, done
        budget = 1.0
    vector = np.zeros(k)
    for ridge in RIDGES:
        vector, totals, done = ascend(evaluate, vector, np.eye(k), budget * weights, ridge)
    return vector, budget * weights, totals, done


def fit_mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    budget: float | None = 1.0,
    most: float | None = None,
    sample: int = SAMPLE,
) -> tuple[Mix, DataFrame]:
    """The mix, and the stored rows (doc_id, _hash, tokens, p) it was fitted on.

    ``labels`` holds (doc_id, domain); ``targets`` weighs the domains; ``budget`` is the
    expected total of tokens as a share of all, or None for the largest that the bound
    allows; ``most`` bounds the rates. A mix is always returned: ``mix_report`` tells how far
    it is from its targets, which are also logged if not met, and whether it is optimal.
    """
    if not targets or min(targets.values()) < 0 or not sum(targets.values()) > 0:
        raise ValueError("targets must be nonnegative weights, not all zero")
    if budget is None and most is None:
        raise ValueError("without a bound on the rates there is no largest budget")
    domains = list(targets)
    model = fit_classifier(docs, labels, domains, doc_id, text, sample)
    start = Mix(domains, model, [0.0] * len(domains), most)
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{text}`").alias("_text"),
        F.xxhash64(F.lit(SEED), f"`{doc_id}`", f"`{text}`").alias("_hash"),
    )
    rows = stored(
        _posteriors(source, F.col("_text"), start).select(
            "doc_id", "_hash", F.col("_tokens").alias("tokens"), F.col("_p").alias("p")
        ),
        "posteriors",
    )
    evaluate = evaluator(rows, len(domains), most)
    if evaluate is None:
        return start, rows
    found = descend(evaluate, np.array([targets[x] for x in domains], float), budget)
    mix = Mix(domains, model, found[0].tolist(), most, found[1].tolist(), found[2].tolist(), found[3])
    if not mix.met:
        LOG.warning(
            "mix %s: target %s, reached %s, residual %s, converged %s",
            domains, mix.target, mix.reached, mix.residual, mix.converged,
        )
    return mix, rows


def _copies(rate: Column, hash_value: Column) -> Column:
    """The rate rounded up or down: by a hash, so that a rerun decides alike."""
    chance = F.pmod(hash_value, F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("bigint")).cast("bigint")


def mixing_rates(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], **settings
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, p_<domain>..., rate, copies.

    Null and empty texts have no tokens and only their posterior. Repeated rows get
    equal rates and copies. Without labelled documents posteriors are even. Labels of
    unknown domains or null ids are ignored; an id labelled twice takes the domain named
    first. An empty table gives no rows. Nothing is raised if targets are out of reach:
    the rates are then the best found.
    """
    mix, rows = fit_mix(docs, labels, targets, **settings)
    value = rate(mix.vector, F.col("p"), mix.most)
    posteriors = [F.get("p", i).alias(f"p_{x}") for i, x in enumerate(mix.domains)]
    rated = rows.select("doc_id", F.col("tokens").alias("n_tokens"), *posteriors, "_hash", value.alias("rate"))
    return rated.withColumn("copies", _copies(F.col("rate"), F.col("_hash"))).drop("_hash")


def mix_documents(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    **settings,
) -> DataFrame:
    """``docs`` with each row repeated by its copies, none included; columns as they were.

    Posteriors are computed again where the rows are read, so texts are not shuffled.
    """
    mix, _ = fit_mix(docs, labels, targets, doc_id, text, **settings)
    held = docs.select(
        F.struct("*").alias("_row"),
        F.col(f"`{text}`").alias("_text"),
        F.xxhash64(F.lit(SEED), f"`{doc_id}`", f"`{text}`").alias("_hash"),
    )
    # Counting rows keeps what follows above each point: merged into one expression, the
    # classifier would run again for every use of the rate.
    judged = _posteriors(held, F.col("_text"), mix).select("_row", "_hash", "_p")
    rated = judged.observe("posteriors", F.count("*").alias("rows")).select(
        "_row", "_hash", rate(mix.vector, F.col("_p"), mix.most).alias("rate")
    )
    copies = _copies(F.col("rate"), F.col("_hash"))
    return (
        rated.select("_row", copies.alias("_copies"))
        .observe("mixed", F.count("*").alias("rows"))
        .filter("_copies > 0")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("_row.*")
    )


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the quality and toxicity labels."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    )
    return labels.select("doc_id", domain.alias("domain"))
