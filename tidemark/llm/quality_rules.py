"""Quality rules: fixed base rules, and robust multivariate outliers.

Each text gives a vector of transformed statistics. Per language and source, the
minimum covariance determinant estimates where the bulk of these vectors lies: from
deterministic starts, C-steps repeat "fit mean and covariance on the three quarters of
the group that lie nearest", which never raises the determinant, and the start with
the smallest one wins. A text whose Mahalanobis distance is beyond the cutoff is
rejected. Groups too small for a fit borrow the estimate of their language, or of all.

All statistics are in-row expressions and grouped aggregates. Estimates are one row per
group, so that no step gathers a group's texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE, SPACE, discard, replacing, stored

FEWEST_WORDS = 20
REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MARKS = r"[!-/:-@\[-`{-~]"  # ASCII punctuation

KEEP = 0.75  # share of a group that the covariance is fitted on
C_STEPS = 4
SMALLEST_GROUP = 50
MOST_GROUPS = 20_000  # groups whose fits, some 40 numbers each, are still broadcast
SALTS = 32  # places in which a group's rows meet its fit beyond that
# Quantiles of the chi-square distribution with five degrees of freedom.
MEDIAN_5, CUTOFF_5 = 4.351, 30.86  # 0.5 and 0.99999
# Spread that each statistic has at least, so that one that is nearly always zero
# does not reject texts for a trace of it. Each is so small that its statistic alone can
# pass the cutoff: in a group without any, 8 percent symbols, or 15 percent of copied lines
# or of repeated words (of which the base rules leave 30 percent at most).
FLOORS = {"word_length": 0.06, "symbols": 0.4, "dup_lines": 0.5, "repeats": 0.5, "marks": 0.3}
NAMES = list(FLOORS)
SIZE = len(NAMES)
LEVELS = ("source", "lang", "all")


def _windows(hashes: Column) -> Column:
    """Hash of each window of words, from the words' hashes; null if there is none."""
    starts = F.sequence(F.lit(0), F.size(hashes) - REPEAT_WINDOW)
    return F.when(
        F.size(hashes) >= REPEAT_WINDOW,
        F.transform(
            starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(REPEAT_WINDOW)])
        ),
    )


def _covered(starts: Column) -> Column:
    """Words under windows that begin at these ascending positions."""
    step = F.transform(
        starts,
        lambda at, k: F.coalesce(
            F.least(F.get(starts, k + 1) - at, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)
        ),
    )
    return F.aggregate(step, F.lit(0), lambda total, x: total + x)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_row, _stats): the input row, and its counts and base verdict. A null text has no words."""
    whole = F.col("_text")
    at = F.col("_at")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(NOT_SPACE))
    repeated = F.filter(
        F.col("_sorted"),
        lambda x, i: F.coalesce(x["h"] == F.get(F.col("_sorted"), i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(F.col("_sorted"), i + 1)["h"], F.lit(False)),
    )
    base = (
        docs.select(
            F.struct("*").alias("_row"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
        )
        .withColumn("_words", F.regexp_extract_all(whole, F.lit(f"{NOT_SPACE}+"), F.lit(0)))
        .withColumn("_lines", lines)
        .withColumn("_hashes", F.transform("_words", lambda word: F.xxhash64(word)))
        .select(
            "_row",
            F.size("_words").cast("bigint").alias("n_words"),
            (F.length(whole) - F.regexp_count(whole, F.lit(SPACE))).cast("bigint").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            F.regexp_count(whole, F.lit(MARKS)).cast("bigint").alias("n_marks"),
            F.size("_lines").cast("bigint").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
            _windows(F.col("_hashes")).alias("_windows"),
        )
        .withColumn(
            "_sorted",
            F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(
                    F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
                ),
            ),
        )
        .withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(_covered(at), F.lit(0)).cast("bigint"))
    )
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks"]
    stats = base.select("_row", F.struct(*counts, failed.alias("base_failed")).alias("_stats"))
    # Counting the rows keeps filters on the verdict above this point: pushed further down
    # they would repeat the nested array expressions once for every use.
    return stats.observe("quality-counts", F.count("*").alias("rows"))


def vector(stats: Column) -> dict[str, Column]:
    """The transformed statistics: logarithms of the word length and of percentages."""

    def percent(part: str, whole: str) -> Column:
        return F.log1p(100.0 * stats[part] / F.greatest(stats[whole], F.lit(1)))

    return {
        "word_length": F.log(
            F.greatest(stats["word_chars"], F.lit(1)) / F.greatest(stats["n_words"], F.lit(1))
        ),
        "symbols": percent("n_symbols", "word_chars"),
        "dup_lines": percent("n_dup_lines", "n_lines"),
        "repeats": percent("n_repeat_words", "n_words"),
        "marks": percent("n_marks", "word_chars"),
    }


def _groups(lang: Column, source: Column) -> Column:
    """A row's groups, finest first; null values are a group of their own."""
    return F.array(
        F.struct(F.lit(0).alias("level"), lang.alias("g_lang"), source.alias("g_source")),
        F.struct(F.lit(1).alias("level"), lang.alias("g_lang"), F.lit("").alias("g_source")),
        F.struct(F.lit(2).alias("level"), F.lit("").alias("g_lang"), F.lit("").alias("g_source")),
    )


def _value(name: str) -> Column:
    """A lineage value as text that tells null from empty."""
    column = F.col(f"_row.`{name}`").cast("string")
    return F.coalesce(F.concat(F.lit("="), column), F.lit("?"))


KEY = ["level", "g_lang", "g_source"]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(SIZE) for j in range(i + 1)]


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance per key, with the floors on the diagonal."""
    mean = [F.avg(name).alias(f"m{i}") for i, name in enumerate(NAMES)]
    spread = [
        F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i, j in _pairs()
    ]
    return rows.groupBy(*keys).agg(*mean, *spread)


def _whitened(fit: DataFrame, scale: Column) -> DataFrame:
    """Adds w (the inverse Cholesky factor of the scaled, floored covariance) and log_det."""
    out = fit
    for i, j in _pairs():
        floor = F.lit(FLOORS[NAMES[i]] ** 2 if i == j else 0.0)
        rest = F.col(f"c{i}{j}") * scale + floor
        for k in range(j):
            rest -= F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        value = F.sqrt(F.greatest(rest, floor)) if i == j else rest / F.col(f"l{j}{j}")
        out = out.withColumn(f"l{i}{j}", value)
    for i, j in _pairs():
        if i == j:
            value = 1 / F.col(f"l{i}{i}")
        else:
            dot = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            value = -dot / F.col(f"l{i}{i}")
        out = out.withColumn(f"w{i}{j}", value)
    log_det = sum((F.log(F.col(f"l{i}{i}")) for i in range(SIZE)), F.lit(0.0))
    kept = [f"m{i}" for i in range(SIZE)] + [f"w{i}{j}" for i, j in _pairs()]
    moments = [f"c{i}{j}" for i, j in _pairs() if f"c{i}{j}" in fit.columns]
    keys = [name for name in (*KEY, "start", "n") if name in fit.columns]
    return out.select(*keys, *kept, *moments, log_det.alias("log_det"))


def _distance(values: Callable[[str], Column]) -> Column:
    """Squared Mahalanobis distance under the row's estimate."""
    total = F.lit(0.0)
    for i in range(SIZE):
        z = F.lit(0.0)
        for j in range(i + 1):
            z += F.col(f"w{i}{j}") * (values(NAMES[j]) - F.col(f"m{j}"))
        total += z * z
    return total


def _beside(rows: DataFrame, groups: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Each row with its group's values; no row moves if the groups are few.

    Beyond ``MOST_GROUPS`` the groups' rows stand under ``SALTS`` salts each, so that the
    rows of one large group meet them in as many places.
    """
    if few:
        return rows.join(F.broadcast(groups), keys)
    salt = F.pmod(F.xxhash64(*NAMES), F.lit(SALTS)).cast("int").alias("_salt")
    spread = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return rows.select("*", salt).join(spread, [*keys, "_salt"]).drop("_salt")


def estimates(rows: DataFrame) -> DataFrame:
    """One estimate per group (KEY, m*, w*, n) of at least ``SMALLEST_GROUP`` rows of (KEY, statistics).

    Groups' fits and bounds are broadcast to the rows after their number was checked, so that
    only partial aggregates move: the group of all rows is not gathered anywhere.
    """
    every = stored(rows.select(*KEY, *NAMES), "quality-vectors")
    large = stored(
        every.groupBy(*KEY).agg(F.count("*").alias("n")).filter(F.col("n") >= SMALLEST_GROUP), "quality-groups"
    )
    few = large.count() <= MOST_GROUPS
    rows = _beside(every, large, KEY, few)
    # Starts: coordinate-wise medians and quartile ranges; plain mean and covariance.
    quartiles = [F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in NAMES]
    medians = rows.groupBy(*KEY).agg(*quartiles)
    middle = medians.select(
        *KEY,
        F.lit(0).alias("start"),
        *[F.get(name, 1).alias(f"m{i}") for i, name in enumerate(NAMES)],
        *[
            (F.pow((F.get(NAMES[i], 2) - F.get(NAMES[i], 0)) / 1.349, F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i, j in _pairs()
        ],
    )
    plain = _moments(rows, KEY).withColumn("start", F.lit(1))
    fit = stored(_whitened(middle.unionByName(plain), F.lit(1.0)), "quality-fit")
    fits = [fit]
    for _ in range(C_STEPS):
        placed = _beside(every, fit, KEY, few).withColumn("d", _distance(F.col))
        bounds = placed.groupBy(*KEY, "start").agg(
            F.percentile_approx("d", KEEP, 1000).alias("bound")
        )
        nearest = _beside(placed.select(*KEY, "start", *NAMES, "d"), bounds, [*KEY, "start"], few)
        fit = stored(
            _whitened(_moments(nearest.filter("d <= bound"), [*KEY, "start"]), F.lit(1.0)),
            "quality-fit",
        )
        fits.append(fit)
    order = F.struct("log_det", "start")
    moments = [f"m{i}" for i in range(SIZE)] + [f"c{i}{j}" for i, j in _pairs()]
    everything = F.struct(*moments, *[f"w{i}{j}" for i, j in _pairs()])
    best = fit.groupBy(*KEY).agg(F.min_by(everything, order).alias("fit")).select(*KEY, "fit.*")
    # The subset's covariance is too small by a factor that the median distance shows.
    scale = (
        _beside(every, best, KEY, few)
        .withColumn("d", _distance(F.col))
        .groupBy(*KEY)
        .agg(
            (F.percentile_approx("d", 0.5, 1000) / MEDIAN_5).alias("scale"),
            F.count("*").alias("n"),
        )
    )
    scaled = best.select(*KEY, *moments).join(scale, KEY)
    result = stored(_whitened(scaled, F.greatest("scale", F.lit(1.0))), "quality-estimates")
    discard(every, large, *fits)
    return result


def _fitted(stats: DataFrame) -> DataFrame:
    """Estimates from (lang, source, stats) rows; texts that fail the base rules take no part."""
    rows = stats.filter(~F.col("_stats.base_failed")).select(
        F.inline(_groups(F.col("g1"), F.col("g2"))),
        *[value.alias(name) for name, value in vector(F.col("_stats")).items()],
    )
    return estimates(rows)


def _judged(rows: DataFrame, fits: DataFrame, cutoff: float) -> DataFrame:
    """Adds ``kept``: base rules, then the distance under the finest group with a fit."""
    values = vector(F.col("_stats"))
    out = rows
    for level, (lang, source) in enumerate(
        [(F.col("g1"), F.col("g2")), (F.col("g1"), F.lit("")), (F.lit(""), F.lit(""))]
    ):
        here = fits.filter(F.col("level") == level).select(
            F.col("g_lang").alias("k1"),
            F.col("g_source").alias("k2"),
            F.struct(*[x for x in fits.columns if x not in (*KEY, "n", "log_det")]).alias(f"fit{level}"),
        )
        out = (
            out.withColumn("_k1", lang)
            .withColumn("_k2", source)
            .join(here, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left")
            .drop("_k1", "_k2", "k1", "k2")
        )
    out = out.withColumn("fit", F.coalesce("fit0", "fit1", "fit2")).select(
        *rows.columns, "fit.*"
    )
    # Without any group large enough to fit, the base rules alone decide.
    normal = F.coalesce(_distance(values.__getitem__) <= cutoff, F.lit(True))
    return out.select(
        *rows.columns, (~F.col("_stats.base_failed") & normal).alias("kept")
    )


def _verdicts(
    docs: DataFrame, text: str, lang: str, source: str, cutoff: float, columns: list[str]
) -> DataFrame:
    """(_row, _stats, kept); ``_row`` holds ``columns``.

    Without the text among them the rows are stored with their counts. Else only the
    counts are, and the texts are read and counted again for the verdict: no shuffle.
    """
    stats = with_statistics(docs, text).select(
        F.struct(*[F.col(f"_row.`{x}`") for x in columns]).alias("_row"),
        "_stats",
        _value(lang).alias("g1"),
        _value(source).alias("g2"),
    )
    if text in columns:
        fits = _fitted(stored(stats.drop("_row"), "quality-counts"))
    else:
        stats = stored(stats, "quality-counts")
        fits = _fitted(stats)
    return _judged(stats, fits, cutoff)


def quality(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    cutoff: float = CUTOFF_5,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with counts, base_failed and kept.

    Result columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_marks, base_failed, kept; input columns of these names give way. Null and empty
    texts have no words and fail the base rules. Null languages and sources are groups
    of their own. Repeated rows are judged alike. Empty tables give no rows.
    """
    judged = _verdicts(docs, text, lang, source, cutoff, columns or docs.columns)
    results = {x: F.col(f"_stats.{x}") for x in judged.schema["_stats"].dataType.names}
    results["kept"] = F.col("_kept")
    flat = judged.withColumnRenamed("kept", "_kept").select("_row.*", "_stats", "_kept")
    return replacing(flat, **results).drop("_stats", "_kept")


def keep_good(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    cutoff: float = CUTOFF_5,
) -> DataFrame:
    """The rows of ``docs`` that pass ``quality``, with their own columns."""
    return _verdicts(docs, text, lang, source, cutoff, docs.columns).filter("kept").select("_row.*")
