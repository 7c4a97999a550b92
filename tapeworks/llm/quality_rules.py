"""Quality rules: fixed base rules, then robust multivariate outliers.

Five transformed statistics describe a document. For every language and source
the minimum covariance determinant estimate gives the centre and spread of its
bulk. It is sought from several starts, which share medians and scaled absolute
deviations and differ in correlation: none, that of squashed values, that of
directions. Each step takes, per start, the ``SHARE`` of rows nearest by Mahalanobis
distance and estimates anew from them; after the last step the start of least
determinant stands. A step is two grouped aggregations over the narrow statistics
of all rows, so a group of any size is spread over the tasks. A last, reweighted
estimate judges: documents too far from the centre are rejected.

Every group has its own estimate, whatever its size. To its sums come ``PRIOR`` rows'
worth of its language's mean moments, and to the language's as many of the whole
table's; the limit of what is near is drawn to the language's and the table's in the
same proportion. So a group of few rows is judged nearly as its language, one of many
nearly alone, and nothing changes abruptly between.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import SPACES, whole_text, written

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# Parameters of the estimate.
SHARE = 0.75
STEPS = 6
PRIOR = 50
STARTS = ("none", "squashed", "directions")
# Clean text has far heavier tails than a normal distribution, so this is no
# share of documents: it says in terms of the normal one how far out the limit
# lies (a squared distance of 65). It was set so that no document labelled good
# that passes the base rules is rejected.
TAIL = 1e-12
# Least spread of each statistic, so that a group in which it never varies
# doesn't reject the first document that does.
STATISTICS = {"x_words": 0.7, "x_chars": 0.5, "x_symbols": 0.04, "x_lines": 0.08, "x_repeats": 0.08}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_text(text: str) -> tuple[int, int, int, int, int]:
    """``COUNTS`` of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        covered_to = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, covered_to)
                covered_to = i + 3
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = [count_text(text) for text in batch.column(3).to_pylist()]
        columns = list(zip(*counted)) if counted else [[]] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "lang", "source", *COUNTS]
        )


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang, source``, the counts, ``base_failed`` and the transformed statistics."""
    kind = dict(docs.dtypes)[id_col]
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    counted = docs.select(F.col(id_col).alias("doc_id"), lang, source, whole_text(text_col).alias("text")).mapInArrow(
        _count, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    words = F.greatest("n_words", F.lit(1))
    transformed = {
        "x_words": F.log(words),
        "x_chars": F.col("word_chars") / words,
        "x_symbols": F.sqrt(F.col("n_symbols") / words),
        "x_lines": F.sqrt(F.col("n_dup_lines") / words),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / words),
    }
    return counted.withColumn("base_failed", failed).withColumns(transformed)


def chi_square_quantile(p: float, k: int) -> float:
    """By bisection on the regularised incomplete gamma function's series."""

    def cdf(x):
        term = total = 1 / (k / 2)
        n = k / 2
        while term > total * 1e-16:
            n += 1
            term *= x / 2 / n
            total += term
        return total * math.exp(-x / 2 + k / 2 * math.log(x / 2) - math.lgamma(k / 2))

    low, high = 1e-9, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return low


def consistency(share: float, k: int) -> float:
    """What makes the covariance of the nearest ``share`` of normal data unbiased."""
    limit, low, high = chi_square_quantile(share, k), 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_quantile(max(middle, 1e-12), k + 2) < limit else (low, middle)
    return share / low


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance from columns ``mu`` and ``inverse`` (row by row)."""
    away = [F.col(x) - F.col("mu")[i] for i, x in enumerate(names)]
    k = len(names)
    terms = [away[i] * away[j] * F.col("inverse")[i * k + j] for i in range(k) for j in range(k)]
    return sum(terms[1:], terms[0])


def _moments(k: int) -> list[str]:
    return [f"s_{i}" for i in range(k)] + [f"s_{i}_{j}" for i in range(k) for j in range(i, k)]


def _inverses(k: int, factor: float, floors: list[float]):
    """Centre, inverse covariance and log determinant from counts and sums of products."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mu, inverse, logdet = [], [], []
            for row in batch.to_pylist():
                n = row["n"]
                mean = np.array([row[f"s_{i}"] for i in range(k)]) / n
                cov = np.array([[row[f"s_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / n - np.outer(mean, mean)
                # A floor under the variances keeps the matrix well-conditioned.
                cov = factor * cov + np.diag(np.square(floors))
                mu.append(mean.tolist())
                inverse.append(np.linalg.inv(cov).ravel().tolist())
                logdet.append(float(np.linalg.slogdet(cov)[1]))
            numbers = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("g_lang", "g_source", "start")), pa.array(mu, numbers), pa.array(inverse, numbers), pa.array(logdet, pa.float64())],
                names=["g_lang", "g_source", "start", "mu", "inverse", "logdet"],
            )

    return invert


def _shrunk(sums: DataFrame, k: int, prior: float) -> DataFrame:
    """Sums per group and start with ``prior`` rows' worth of the language's moments, and those with the table's."""
    names = ["n", *_moments(k)]
    languages = sums.groupBy("g_lang", "start").agg(*[F.sum(c).alias(c) for c in names])
    whole = languages.groupBy("start").agg(*[F.sum(c).alias(f"all_{c}") for c in names])
    plus = lambda c, n, s: (F.col(c) + F.lit(prior) * F.col(s) / F.col(n))
    languages = languages.join(whole, "start").select("g_lang", "start", *[plus(c, "all_n", f"all_{c}").alias(f"lang_{c}") for c in names])
    return sums.join(languages, ["g_lang", "start"]).select(
        "g_lang", "g_source", "start", *[plus(c, "lang_n", f"lang_{c}").alias(c) for c in names]
    )


def _solved(spark: SparkSession, sums: DataFrame, k: int, factor: float, floors: list[float], prior: float) -> DataFrame:
    """The estimates as a table; so are the sums, which are read for groups, languages and the whole."""
    columns = "g_lang string, g_source string, start int, mu array<double>, inverse array<double>, logdet double"
    sums = written(spark, sums, "mcd-sums")
    return written(spark, _shrunk(sums, k, prior).mapInArrow(_inverses(k, factor, floors), columns), "mcd")


def _limits(spark: SparkSession, near: DataFrame, share: float, prior: float) -> DataFrame:
    """``limit`` per group and start: the ``share`` quantile of distances, drawn to that of the language and the table."""
    quantile = F.percentile_approx("distance", share, 10000).alias("limit")
    levels = near.rollup("start", "g_lang", "g_source").agg(F.grouping_id().alias("level"), F.count("*").cast("double").alias("n"), quantile)
    levels = written(spark, levels, "mcd-limits")
    drawn = lambda n, own, wider: ((F.col(n) * F.col(own) + prior * F.col(wider)) / (F.col(n) + prior))
    whole = levels.where("level = 3").select("start", F.col("limit").alias("all_limit"))
    languages = levels.where("level = 1").join(whole, "start").select("start", "g_lang", drawn("n", "limit", "all_limit").alias("lang_limit"))
    own = levels.where("level = 0").join(languages, ["start", "g_lang"])
    return own.select("g_lang", "g_source", "start", drawn("n", "limit", "lang_limit").alias("limit"))


def _sums(rows: DataFrame, names: list[str], inside: Column) -> DataFrame:
    """Count and sums per group and start of the rows that are ``inside``: 0 where none is."""
    products = [F.col(x) for x in names] + [F.col(names[i]) * F.col(names[j]) for i in range(len(names)) for j in range(i, len(names))]
    named = [F.coalesce(F.sum(F.when(inside, product)), F.lit(0.0)).alias(name) for product, name in zip(products, _moments(len(names)))]
    return rows.groupBy("g_lang", "g_source", "start").agg(F.count_if(inside).cast("double").alias("n"), *named)


def _starts(spark: SparkSession, sound: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Counts and sums, per group and start, of rows that would have the start's centre and covariance."""
    names, group, k = list(floors), ["g_lang", "g_source"], len(floors)
    middle = sound.groupBy(*group).agg(*[F.percentile_approx(x, 0.5, 10000).alias(f"m_{x}") for x in names])
    middle = written(spark, middle, "mcd-middle")
    away = sound.join(middle, group).select(*group, *[f"m_{x}" for x in names], *[(F.col(x) - F.col(f"m_{x}")).alias(x) for x in names])
    spread = away.groupBy(*group).agg(
        *[F.first(f"m_{x}").alias(f"m_{x}") for x in names], *[F.percentile_approx(F.abs(x), 0.5, 10000).alias(f"d_{x}") for x in names]
    )
    spread = written(spark, spread, "mcd-spread")
    scaled = away.drop(*[f"m_{x}" for x in names]).join(spread, group)
    scaled = scaled.withColumns({x: F.col(x) / F.greatest(1.4826 * F.col(f"d_{x}"), F.lit(floors[x])) for x in names})
    length = F.greatest(F.sqrt(sum((F.col(x) * F.col(x) for x in names[1:]), F.col(names[0]) * F.col(names[0]))), F.lit(1e-9))
    forms = {"squashed": {x: F.tanh(x) for x in names}, "directions": {x: F.col(x) / length for x in names}}
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    every = spread.columns[2:]
    products = scaled.groupBy(*group).agg(
        F.count("*").cast("double").alias("n"),
        *[F.first(c).alias(c) for c in every],
        *[F.sum(form[names[i]] * form[names[j]]).alias(f"{start}_{i}_{j}") for start, form in forms.items() for i, j in pairs],
    )

    def correlation(start, i, j):
        if i == j:
            return F.lit(1.0)
        if start not in forms:
            return F.lit(0.0)
        scale = F.sqrt(F.col(f"{start}_{i}_{i}") * F.col(f"{start}_{j}_{j}"))
        return F.when(scale > 0, F.col(f"{start}_{i}_{j}") / scale).otherwise(F.lit(0.0))

    n, m, d = F.col("n"), [F.col(f"m_{x}") for x in names], [1.4826 * F.col(f"d_{x}") for x in names]
    sums = lambda start: [(n * m[i]).alias(f"s_{i}") for i in range(k)] + [
        (n * (m[i] * m[j] + d[i] * d[j] * correlation(start, i, j))).alias(f"s_{i}_{j}") for i, j in pairs
    ]
    each = F.array(*[F.struct(F.lit(number).alias("start"), *sums(start)) for number, start in enumerate(STARTS)])
    return products.select(*group, "n", F.inline(each))


def estimates(
    spark: SparkSession,
    sound: DataFrame,
    share: float = SHARE,
    steps: int = STEPS,
    floors: dict[str, float] = STATISTICS,
    prior: float = PRIOR,
) -> DataFrame:
    """``g_lang, g_source, mu, inverse``: the reweighted estimate of every group of ``sound``."""
    names, least = list(floors), list(floors.values())
    group, k = ["g_lang", "g_source"], len(floors)
    now = _solved(spark, _starts(spark, sound, floors), k, 1.0, least, prior)
    for _ in range(steps):
        near = sound.join(now, group).withColumn("distance", _distance(names))
        limits = _limits(spark, near, share, prior)
        sums = _sums(near.join(limits, [*group, "start"]), names, F.col("distance") <= F.col("limit"))
        now = _solved(spark, sums, k, consistency(share, k), least, prior)
    best = F.min_by(F.struct("mu", "inverse"), F.struct("logdet", "start")).alias("best")
    now = written(spark, now.groupBy(*group).agg(best).select(*group, F.lit(0).alias("start"), "best.*"), "mcd")
    inner = _distance(names) <= chi_square_quantile(0.975, k)
    sums = _sums(sound.join(now, group), names, inner)
    return _solved(spark, sums, k, consistency(0.975, k), least, prior).select(*group, "mu", "inverse")


def judge(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float = SHARE,
    steps: int = STEPS,
    tail: float = TAIL,
    floors: dict[str, float] = STATISTICS,
    prior: float = PRIOR,
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``distance`` of every row.

    Null texts count as empty and fail the base rules; null languages and
    sources are groups of their own. Documents that fail the base rules take no
    part in the estimates and have no distance. ``tail`` is the share that the
    distance would reject if the statistics were normally distributed.
    """
    rows = written(spark, statistics(docs, id_col, text_col), "quality")
    answer = ["doc_id", *COUNTS, "base_failed"]
    sound = rows.where(~F.col("base_failed")).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    found = estimates(spark, sound, share, steps, floors, prior)
    judged = sound.join(found, ["g_lang", "g_source"], "left").withColumn("distance", _distance(list(floors)))
    limit = chi_square_quantile(1 - tail, len(floors))
    judged = judged.select(*answer, (F.coalesce(F.col("distance"), F.lit(0.0)) <= limit).alias("kept"), "distance")
    failed = rows.where("base_failed").select(*answer, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.unionByName(failed)
