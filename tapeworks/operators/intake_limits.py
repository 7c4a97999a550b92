"""Shedding, time-to-live, deduplication and outage episodes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.operators.folds import CHUNK_ROWS
from tapeworks.operators.metrics import interval_index
from tapeworks.operators.running import join_back


def quota_shed(
    frames: DataFrame,
    seconds: int,
    quota: int = defaults.QUEUE_CAPACITY,
    keys: Sequence[str] = (),
    ts: str = "recv_ts",
    order: str = "frame_id",
) -> DataFrame:
    """Add ``interval`` and ``shed``: whether a frame is past its interval's quota.

    Frames count in (ts, order) order. Only the first ``quota`` rows of each
    interval are ever ranked, which Spark limits on the map side already; the
    rest are compared with the last row let in.
    """
    numbered = frames.withColumn("interval", interval_index(F.col(ts), seconds))
    place = F.struct(F.col(ts), F.col(order))
    ranked = Window.partitionBy(*keys, "interval").orderBy(ts, order)
    last_in = (
        numbered.select(*keys, "interval", ts, order)
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= quota)
        .groupBy(*keys, "interval")
        .agg(F.max(place).alias("_last"))
    )
    joined = join_back(numbered, last_in, [*keys, "interval"], "left")
    return joined.withColumn("shed", F.coalesce(place > F.col("_last"), F.lit(True))).drop("_last")


def within_ttl(
    frames: DataFrame,
    event_time: Column,
    seconds: int = defaults.MESSAGE_TTL_SECONDS,
    ts: str = "recv_ts",
) -> DataFrame:
    """Frames received no later than ``seconds`` after their event time.

    Frames without one of the times (partial books have no event time) have no
    age and stay.
    """
    fresh = F.unix_micros(ts) - F.unix_micros(event_time) <= seconds * 1_000_000
    return frames.filter(F.coalesce(fresh, F.lit(True)))


def deduplicate(
    frames: DataFrame, identity: Sequence[str], ts: str = "recv_ts", order: str = "frame_id"
) -> DataFrame:
    """One frame per identity: the first received.

    Spark limits the ranking to one row per identity before the shuffle, so
    any number of copies is little work for one task. Frames that lack a part
    of their identity are no copies of each other and stay.
    """
    nameless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in identity])
    # The place of a row stands in for the identity it lacks.
    placed = frames.withColumn("_own", F.when(nameless, F.monotonically_increasing_id()))
    nth = F.row_number().over(Window.partitionBy(*identity, "_own").orderBy(ts, order))
    return placed.withColumn("_nth", nth).filter("_nth = 1").drop("_nth", "_own")


def outage_episodes(
    log: DataFrame,
    name: str = "name",
    ts: str = "ts",
    seq: str = "seq",
    ok: str = "ok",
    delay: int = defaults.RECONNECT_DELAY_SECONDS,
    max_attempts: int = defaults.MAX_RECONNECT_ATTEMPTS,
    chunk_seconds: int = 60,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``episode``, ``attempt``, ``expected_delay`` and ``outcome`` to each row.

    An episode is what happens up to and including a success; ``attempt`` is
    the number of failures before the row in its episode. Attempts wait
    ``delay * 2**attempt``. The failure that uses up the last attempt gives
    up; whatever fails after that in the episode finds the client stopped.

    Counts run within chunks of a name and are carried from chunk to chunk, so
    neither a long outage nor a busy name ends up in one task. A chunk ends
    after ``chunk_rows`` rows, at the next step of ``chunk_seconds``. Rows
    without a time come first in a name's history.
    """
    cut = log.withColumn("_step", interval_index(F.col(ts), chunk_seconds))
    upto_step = Window.partitionBy(name).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = cut.groupBy(name, "_step").agg(F.count("*").alias("_rows"))
    number = F.call_function("div", F.coalesce(F.sum("_rows").over(upto_step), F.lit(0)), F.lit(chunk_rows))
    cut = join_back(cut, steps.select(name, "_step", number.alias("_chunk")), [name, "_step"])
    within = Window.partitionBy(name, "_chunk").orderBy(ts, seq)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    is_ok = F.coalesce(F.col(ok), F.lit(False))
    counted = (
        cut.withColumn("_ok", is_ok)
        .withColumn("_oks", F.sum(F.col("_ok").cast("bigint")).over(upto))
        .withColumn("_fails", F.sum((~F.col("_ok")).cast("bigint")).over(upto))
        .withColumn("_fails_at_ok", F.max(F.when(F.col("_ok"), F.col("_fails"))).over(before))
    )
    chunks = counted.groupBy(name, "_chunk").agg(
        F.max("_oks").alias("_all_oks"),
        F.max("_fails").alias("_all_fails"),
        F.max(F.when(F.col("_ok"), F.col("_fails"))).alias("_at_last_ok"),
    )
    earlier = Window.partitionBy(name).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    carried = (
        chunks.withColumn("_oks_before", summed("_all_oks"))
        .withColumn("_fails_before", summed("_all_fails"))
        .withColumn(
            "_cleared", F.max(F.col("_fails_before") + F.col("_at_last_ok")).over(earlier)
        )
        .select(
            name,
            "_chunk",
            "_oks_before",
            (F.col("_fails_before") - F.coalesce("_cleared", F.lit(0))).alias("_pending"),
        )
    )
    rows = join_back(counted, carried, [name, "_chunk"])
    fails_before_row = F.col("_fails") - (~F.col("_ok")).cast("bigint")
    attempt = F.when(
        F.col("_fails_at_ok").isNotNull(), fails_before_row - F.col("_fails_at_ok")
    ).otherwise(fails_before_row + F.col("_pending"))
    outcome = (
        F.when(F.col("_ok") & (F.col("attempt") == 0), "steady")
        .when(F.col("_ok") & (F.col("attempt") < max_attempts), "recovered")
        .when(F.col("_ok"), "restarted")
        .when(F.col("attempt") + 1 < max_attempts, "failed")
        .when(F.col("attempt") + 1 == max_attempts, "gave_up")
        .otherwise("stopped")
    )
    wait = (F.lit(delay) * F.pow(F.lit(2.0), F.col("attempt"))).cast("bigint")
    return (
        rows.withColumn("episode", F.col("_oks_before") + F.col("_oks") - F.col("_ok").cast("bigint"))
        .withColumn("attempt", attempt)
        .withColumn("expected_delay", F.when(F.col("attempt") < max_attempts, wait))
        .withColumn("outcome", outcome)
        .select(*log.columns, "episode", "attempt", "expected_delay", "outcome")
    )
