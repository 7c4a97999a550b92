"""The client's metrics at regular report times, with states taken from their change logs.

Connection, bus, queue, attempts and pings are logs of changes. What a report tells
is the last change before it: an as-of join of all logs with the report times. Changes
are first aggregated to the last one per report interval, of all logs in one pass;
then the last one so far is carried along the intervals, a bounded stretch of them per
task. What is ordered is a row per interval, whatever the number of changes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.numbers import per_second, percent
from tapeworks.operators.metrics import INTERVALS_PER_BUCKET, tick_totals
from tapeworks.operators.running import with_running

# Kind of each log's values, and what holds before its first change.
STATES = {
    "running": ("boolean", True),
    "connected": ("boolean", False),
    "bus_connected": ("boolean", False),
    "queue_size": ("bigint", 0),
    "reconnect_attempts": ("bigint", 0),
    "last_ping_ms": ("bigint", None),
}


def _place(ts: str, seq: str) -> Column:
    """Time, then number, as one number, which Spark can aggregate by hashing."""
    step = F.lit("10000000000000000000").cast("decimal(20,0)")
    return (F.unix_micros(ts).cast("decimal(18,0)") * step + F.coalesce(F.col(seq), F.lit(-1)).cast("decimal(19,0)")).cast("decimal(38,0)")


def last_changes(
    logs: Mapping[str, DataFrame], kinds: Mapping[str, str], width: int, origin: int = 0, ts: str = "ts", seq: str = "seq"
) -> DataFrame:
    """``tick_ms`` and, per log, the last change before it as ``place, value``, of changes since the tick before."""
    ms = F.unix_millis(ts)
    tick = (ms - F.pmod(ms - F.lit(origin), F.lit(width)) + width).alias("tick_ms")
    place = _place(ts, seq)
    rows = [
        log.where(F.col(ts).isNotNull()).select(
            tick,
            *[(place if n == name else F.lit(None).cast("decimal(38,0)")).alias(f"at_{n}") for n in logs],
            *[(F.col("value").cast(kinds[n]) if n == name else F.lit(None).cast(kinds[n])).alias(n) for n in logs],
        )
        for name, log in logs.items()
    ]
    last = reduce(DataFrame.unionByName, rows).groupBy("tick_ms").agg(
        *[F.max(f"at_{n}").alias(f"at_{n}") for n in logs], *[F.max_by(n, f"at_{n}").alias(n) for n in logs]
    )
    changed = lambda n: F.when(F.col(f"at_{n}").isNotNull(), F.struct(F.col(f"at_{n}").alias("place"), F.col(n).alias("value")))
    return last.select("tick_ms", *[changed(n).alias(n) for n in logs])


def as_of_ticks(
    ticks: DataFrame,
    logs: Mapping[str, DataFrame],
    width: int,
    origin: int = 0,
    states: Mapping[str, tuple[str, object]] = STATES,
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """``ticks`` (by distinct ``tick_ms``, whole ``width`` milliseconds from ``origin``) with each state as it was before them.

    ``logs`` names logs of ``ts, seq, value``; a value may be NULL. The last change is
    that of the greatest time, then number, of which no two may be alike. Changes
    without a time have no place and are left out. A state without a log, and one
    before its first change, is as ``states`` has it.
    """
    unknown = set(logs) - set(states)
    if unknown:
        raise ValueError(f"no such states: {sorted(unknown)}")
    if not logs:
        return ticks.withColumns({n: F.lit(initial).cast(kind) for n, (kind, initial) in states.items()})
    told = F.struct(*[c for c in ticks.columns if c != "tick_ms"])
    kinds = {n: kind for n, (kind, _) in states.items()}
    changes = last_changes(logs, kinds, width, origin, ts, seq)
    both = ticks.select("tick_ms", F.lit(True).alias("is_tick"), told.alias("told")).unionByName(changes, allowMissingColumns=True)
    # One row per tick: its own columns, and the changes since the tick before.
    merged = both.groupBy("tick_ms").agg(
        F.max("is_tick").alias("is_tick"), F.first("told", ignorenulls=True).alias("told"), *[F.first(n, ignorenulls=True).alias(f"new_{n}") for n in logs]
    )
    bucket = F.call_function("div", F.col("tick_ms") - origin, F.lit(width * INTERVALS_PER_BUCKET))
    carried = with_running(merged, [], bucket, ["tick_ms"], maxima={f"last_{n}": F.col(f"new_{n}") for n in logs})
    start = lambda n: F.lit(states[n][1]).cast(kinds[n])
    now = lambda n: F.when(F.col(f"last_{n}").isNull(), start(n)).otherwise(F.col(f"last_{n}.value")) if n in logs else start(n)
    return carried.where("is_tick").select("tick_ms", "told.*", *[now(n).alias(n) for n in states])


def metrics_history(
    classified: DataFrame,
    logs: Mapping[str, DataFrame],
    seconds: int = defaults.HEARTBEAT_SECONDS,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
    start_ms: int | None = None,
    end_ms: int | None = None,
    capacity: int = defaults.QUEUE_CAPACITY,
    heartbeat_enabled: bool = True,
    ts: str = "recv_ts",
) -> DataFrame:
    """``report_ms`` and the columns of ``metrics.metrics_snapshot`` at every heartbeat.

    Report times are those of ``heartbeat_report``. A report knows the frames and
    changes before its time; see ``as_of_ticks`` for the logs, named as in ``STATES``.
    Frames without a receive time are in no report.
    """
    width, origin = seconds * 1000, start_ms or 0
    totals, _ = tick_totals(classified, seconds, start_ms, end_ms, ts)
    ticks = totals.where(F.col("slot").isNotNull()).select(
        ((F.col("slot") + 1) * width + origin).alias("tick_ms"),
        ((F.col("slot") + 1 - F.col("first")) * width).alias("uptime_ms"),
        "total_processed",
        "total_dropped",
        "last_received_ms",
    )
    known = as_of_ticks(ticks, logs, width, origin)
    status = lambda c: F.when(F.col(c), F.lit("connected")).otherwise(F.lit("disconnected"))
    return known.select(
        F.col("tick_ms").alias("report_ms"),
        F.col("connected").alias("is_connected"),
        F.col("running").alias("is_running"),
        status("connected").alias("connection_status"),
        "reconnect_attempts",
        F.col("total_processed").alias("processed_messages"),
        F.col("total_dropped").alias("dropped_messages"),
        F.lit(len(subscriptions)).alias("stream_count"),
        F.array(*[F.lit(s) for s in subscriptions]).alias("streams"),
        "queue_size",
        F.col("last_received_ms").alias("last_message_ms"),
        "last_ping_ms",
        status("connected").alias("websocket_state"),
        status("bus_connected").alias("nats_state"),
        "uptime_ms",
        per_second(F.col("total_processed"), F.col("uptime_ms")).alias("messages_per_second"),
        percent(F.col("queue_size"), F.lit(capacity).cast("bigint")).alias("queue_utilization_percent"),
        (F.col("tick_ms") - F.col("last_received_ms")).alias("ms_since_last_message"),
        F.lit(heartbeat_enabled).alias("heartbeat_enabled"),
        F.lit(seconds).alias("heartbeat_interval"),
    )
