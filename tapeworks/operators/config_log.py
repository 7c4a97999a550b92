"""Configuration changes replayed from their log.

A log has ``scope, seq, op, parameters (JSON), changed_by, reason``. The order
of changes matters, but not across streams: each stream's fate depends only on
the changes that name it, so aggregations per stream are enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.operators.running import join_back

STREAMS = "array<string>"


def subscriptions_current(
    log: DataFrame, base: Sequence[str] = (), scope: str = "scope", seq: str = "seq"
) -> DataFrame:
    """``scope, pos, stream``: the list after all set, add and remove changes.

    ``set`` replaces the list and keeps duplicates, ``add`` appends a stream
    that is not there, ``remove`` takes away its first occurrence. Scopes that
    were never set start from ``base``; those that are NULL share a list. Adding or
    removing no stream has no effect.
    """
    changes = log.select(
        F.col(scope).alias("scope"),
        F.col(seq).alias("seq"),
        "op",
        F.from_json(F.get_json_object("parameters", "$.streams"), STREAMS).alias("streams"),
        F.get_json_object("parameters", "$.stream").alias("stream"),
    )
    starting = F.array(*[F.lit(s) for s in base]).cast(STREAMS)
    is_set = F.col("op") == "set"
    lists = changes.groupBy("scope").agg(
        F.max(F.when(is_set, F.col("seq"))).alias("set_seq"),
        F.max_by("streams", F.when(is_set, F.col("seq"))).alias("streams"),
    )
    lists = lists.select(
        "scope",
        "set_seq",
        F.when(F.col("set_seq").isNull(), starting)
        .otherwise(F.coalesce("streams", F.array().cast(STREAMS)))
        .alias("streams"),
    )
    listed = lists.select("scope", F.posexplode("streams").alias("pos", "stream")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("scope", "stream").orderBy("pos"))
    )
    since_set = (
        join_back(
            changes.filter(F.col("op").isin("add", "remove") & F.col("stream").isNotNull()),
            lists.select("scope", "set_seq"),
            ["scope"],
        )
        .filter(F.col("set_seq").isNull() | (F.col("seq") > F.col("set_seq")))
        .select("scope", "stream", "op", "seq")
    )
    removed = since_set.filter(F.col("op") == "remove").groupBy("scope", "stream").agg(
        F.count("*").alias("removes"), F.max("seq").alias("last_remove")
    )
    kept = (
        join_back(listed, removed, ["scope", "stream"], "left")
        .filter(F.col("nth") > F.coalesce("removes", F.lit(0)))
        .select("scope", "stream", F.lit(0).alias("part"), F.col("pos").cast("bigint").alias("place"))
    )
    occurrences = listed.groupBy("scope", "stream").agg(F.max("nth").alias("listed"))
    # Once all listed occurrences are gone, the first add after the last
    # remove is what puts the stream back.
    appended = (
        join_back(
            join_back(since_set.filter(F.col("op") == "add"), removed, ["scope", "stream"], "left"),
            occurrences,
            ["scope", "stream"],
            "left",
        )
        .filter(
            (F.coalesce("removes", F.lit(0)) >= F.coalesce("listed", F.lit(0)))
            & (F.col("last_remove").isNull() | (F.col("seq") > F.col("last_remove")))
        )
        .groupBy("scope", "stream")
        .agg(F.min("seq").alias("place"))
        .select("scope", "stream", F.lit(1).alias("part"), "place")
    )
    order = Window.partitionBy("scope").orderBy("part", "place")
    current = kept.unionByName(appended)
    return current.select(
        F.col("scope").alias(scope), (F.row_number().over(order) - 1).alias("pos"), "stream"
    )


def settings_current(log: DataFrame, scope: str = "scope", seq: str = "seq") -> DataFrame:
    """Latest applied settings per scope and type, with who changed them and why."""
    latest = F.max_by(F.struct("parameters", "changed_by", "reason", F.col(seq).alias("seq")), F.col(seq))
    return (
        log.filter(F.col("config_type").isin("reconnection", "circuit_breaker") & (F.col("op") == "update"))
        .groupBy(scope, "config_type")
        .agg(latest.alias("latest"))
        .select(scope, "config_type", "latest.*")
    )
