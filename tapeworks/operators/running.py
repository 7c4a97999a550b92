"""Running totals that do not put a whole key through one task.

A plain window ordered by time sorts all rows of a key in one place. Here the
key's rows are cut into time buckets: totals per bucket are aggregated first
(map-side, so cheap whatever the skew), accumulated over the few buckets, and
added to totals that run within each bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_back(rows: DataFrame, derived: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows with something derived from them; missing keys match each other."""
    renamed = derived.withColumnsRenamed({name: f"_on_{name}" for name in on})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_on_{n}")) for n in on])
    return rows.join(renamed, same, how).drop(*[f"_on_{n}" for n in on])


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running ``sums`` (0 when empty) and ``maxima``, current row included.

    ``bucket`` must not decrease along ``order`` within a key.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    bucketed = df.withColumn("_bucket", bucket)
    totals = bucketed.groupBy(*keys, "_bucket").agg(
        *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()],
        *[F.max(c).alias(f"_max_{n}") for n, c in maxima.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.max(f"_max_{n}").over(earlier).alias(f"_before_{n}") for n in maxima],
    )
    joined = join_back(bucketed, before, [*keys, "_bucket"])
    within = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    added = {
        n: F.col(f"_before_{n}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()
    } | {n: F.greatest(F.col(f"_before_{n}"), F.max(c).over(within)) for n, c in maxima.items()}
    return joined.withColumns(added).drop("_bucket", *[f"_before_{n}" for n in [*sums, *maxima]])
