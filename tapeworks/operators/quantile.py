"""Exact order statistics without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Distances of the split points from the wanted share. The sketch is accurate
# to 1/ACCURACY of the rows, so the split with the answer holds about as many.
OFFSETS = (0.0, 0.0001, 0.0002, 0.0005, 0.001, 0.01)
ACCURACY = 10000


def latency_summary(df: DataFrame, group: str, value: str, q: float = 0.95) -> DataFrame:
    """Count, mean and the element ``int(q * n)`` of the ascending values.

    That element is found exactly in two rounds. An approximate sketch gives
    split points; values are counted per split, equal values already merged
    before the shuffle; and only the one split that holds the wanted rank is
    then put in order. How good the sketch is affects balance, never results.
    """
    shares = sorted({round(q + sign * o, 6) for o in OFFSETS for sign in (-1, 1)})
    shares = [F.lit(share) for share in shares if 0 <= share <= 1]
    stats = df.groupBy(group).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(value, F.array(*shares), ACCURACY).alias("_splits"),
    )
    stats = stats.withColumn("_rank", F.floor(F.col("_n") * F.lit(str(q)).cast("decimal(10,9)")))
    split = F.size(F.filter("_splits", lambda x: x < F.col("_value")))
    thin = df.select(F.col(group).alias("_group"), F.col(value).alias("_value"))
    counted = (
        thin.filter(F.col("_value").isNotNull())
        .groupBy("_group", "_value")
        .agg(F.count("*").alias("_count"))
        .join(stats, F.col("_group").eqNullSafe(F.col(group)))
        .withColumn("_split", split)
        .select(group, "_n", "_rank", "_split", "_value", "_count")
    )
    per_split = counted.groupBy(group, "_rank", "_split").agg(
        F.sum("_count").alias("_in"), F.sum(F.col("_value") * F.col("_count")).alias("_sum")
    )
    so_far = Window.partitionBy(group).orderBy("_split")
    upto = per_split.withColumn("_upto", F.sum("_in").over(so_far))
    holding = (
        upto.filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_in") <= F.col("_rank")))
        .select(F.col(group).alias("_g"), F.col("_split").alias("_s"), (F.col("_upto") - F.col("_in")).alias("_below"))
    )
    candidates = counted.join(
        holding, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_split") == F.col("_s"))
    )
    by_value = Window.partitionBy(group).orderBy("_value")
    chosen = (
        candidates.withColumn("_upto", F.col("_below") + F.sum("_count").over(by_value))
        .filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_count") <= F.col("_rank")))
        .select(F.col(group).alias("_g"), F.col("_value").alias("p_value"))
    )
    summary = per_split.groupBy(group).agg(
        F.sum("_in").alias("n"), F.sum("_sum").alias("_total")
    )
    return summary.join(chosen, F.col(group).eqNullSafe(F.col("_g"))).select(
        group, "n", (F.col("_total").cast("double") / F.col("n")).alias("mean"), "p_value"
    )
