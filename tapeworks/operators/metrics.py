"""Counters, rates and reports over classified frames.

Raw frames are always aggregated per interval before anything is ordered, so
what is ordered is bounded by the time span covered and not by the traffic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.numbers import per_second, percent
from tapeworks.operators.intake import COUNTED_AS_DROPPED, MALFORMED
from tapeworks.operators.running import with_running

# Intervals accumulated together by one task of a running total.
INTERVALS_PER_BUCKET = 10000


def is_processed() -> Column:
    return F.col("disposition") == "published"


def is_dropped() -> Column:
    return F.col("disposition").isin(*COUNTED_AS_DROPPED)


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def interval_index(ts: Column, seconds: int, start_ms: Column | int = 0) -> Column:
    """Number of the interval a time falls into, counting from ``start_ms``."""
    start = start_ms if isinstance(start_ms, Column) else F.lit(start_ms)
    return F.call_function("div", F.unix_millis(ts) - start, F.lit(seconds * 1000))


def running_totals(classified: DataFrame, seconds: int = defaults.HEARTBEAT_SECONDS, ts: str = "recv_ts") -> DataFrame:
    """Processed and dropped frames per interval with frames, and up to its end."""
    per_interval = (
        classified.groupBy(interval_index(F.col(ts), seconds).alias("interval"))
        .agg(_count(is_processed()).alias("processed"), _count(is_dropped()).alias("dropped"))
    )
    totals = with_running(
        per_interval,
        [],
        F.call_function("div", F.col("interval"), F.lit(INTERVALS_PER_BUCKET)),
        ["interval"],
        sums={"total_processed": F.col("processed"), "total_dropped": F.col("dropped")},
    )
    return totals.withColumn("interval_start_ms", F.col("interval") * seconds * 1000).drop("interval")


def heartbeat_report(
    classified: DataFrame,
    seconds: int = defaults.HEARTBEAT_SECONDS,
    start_ms: int | None = None,
    end_ms: int | None = None,
    ts: str = "recv_ts",
) -> DataFrame:
    """One row per heartbeat from start to end, empty intervals included.

    Tick ``k`` reports the interval that ends at ``start + k * seconds``. Start
    defaults to the first frame's time rounded down to a whole interval, end
    to the last frame's. Staleness counts from the last frame *received*,
    whether or not it could be routed; it is 0 before the first. Frames without
    a receive time are counted in a row without a tick, if there are any.
    """
    totals, per_interval = tick_totals(classified, seconds, start_ms, end_ms, ts)
    ticks = as_ticks(totals, seconds * 1000, start_ms or 0)
    # Frames without a receive time fall into no interval; they are counted in a row without a tick.
    nothing = {c: F.lit(None).cast(kind).alias(c) for c, kind in ticks.dtypes}
    counted = {"processed_since_last": F.col("processed"), "dropped_since_last": F.col("dropped")}
    untimed = per_interval.filter(F.col("slot").isNull() & (F.col("processed") + F.col("dropped") > 0))
    return ticks.unionByName(untimed.select(*[counted.get(c, nothing[c]).alias(c) for c in ticks.columns]))


def tick_totals(
    classified: DataFrame, seconds: int, start_ms: int | None = None, end_ms: int | None = None, ts: str = "recv_ts"
) -> tuple[DataFrame, DataFrame]:
    """Counts of every interval by ``slot`` with totals so far, and the counts of intervals with frames."""
    width = seconds * 1000
    received = F.when(F.col("shape") != MALFORMED, F.unix_millis(ts))
    per_interval = (
        classified.groupBy(interval_index(F.col(ts), seconds).alias("slot"))
        .agg(
            _count(is_processed()).alias("processed"),
            _count(is_dropped()).alias("dropped"),
            F.max(received).alias("last_ms"),
        )
    )
    if start_ms is not None:
        per_interval = (
            classified.filter(F.coalesce(F.unix_millis(ts) >= start_ms, F.lit(True)))
            .groupBy(interval_index(F.col(ts), seconds, start_ms).alias("slot"))
            .agg(
                _count(is_processed()).alias("processed"),
                _count(is_dropped()).alias("dropped"),
                F.max(received).alias("last_ms"),
            )
        )
    origin = start_ms or 0
    first = F.lit(0) if start_ms is not None else F.col("first")
    final = F.col("final") if end_ms is None else F.lit((end_ms - origin - 1) // width)
    # The slots of a long span, as one wrong clock makes it, are dealt to tasks in pieces.
    span = per_interval.agg(F.min("slot").alias("first"), F.max("slot").alias("final"))
    span = span.select(first.cast("bigint").alias("first"), final.cast("bigint").alias("final"))
    begins = F.when(F.col("first") <= F.col("final"), F.sequence("first", "final", F.lit(INTERVALS_PER_BUCKET)))
    pieces = span.withColumn("piece", F.explode(begins)).repartition("piece")
    last = F.least(F.col("piece") + (INTERVALS_PER_BUCKET - 1), F.col("final"))
    spine = pieces.select("first", F.explode(F.sequence("piece", last)).alias("slot"))
    ticks = spine.join(per_interval, "slot", "left").select(
        "slot",
        "first",
        F.coalesce("processed", F.lit(0)).alias("processed_since_last"),
        F.coalesce("dropped", F.lit(0)).alias("dropped_since_last"),
        "last_ms",
    )
    totals = with_running(
        ticks,
        [],
        F.call_function("div", F.col("slot"), F.lit(INTERVALS_PER_BUCKET)),
        ["slot"],
        sums={
            "total_processed": F.col("processed_since_last"),
            "total_dropped": F.col("dropped_since_last"),
        },
        maxima={"last_received_ms": F.col("last_ms")},
    )
    return totals, per_interval


def as_ticks(totals: DataFrame, width: int, origin: int = 0) -> DataFrame:
    """Heartbeats out of counts per ``slot`` of ``width`` milliseconds, with ``first``, totals and ``last_received_ms``."""
    tick_ms = (F.col("slot") + 1) * width + origin
    uptime_ms = (F.col("slot") + 1 - F.col("first")) * width
    return totals.select(
        tick_ms.alias("tick_ms"),
        "processed_since_last",
        "dropped_since_last",
        per_second(F.col("processed_since_last"), F.lit(width).cast("bigint")).alias("messages_per_second"),
        "total_processed",
        "total_dropped",
        per_second(F.col("total_processed"), uptime_ms).alias("overall_rate_per_second"),
        F.coalesce(tick_ms - F.col("last_received_ms"), F.lit(0)).alias("ms_since_last_message"),
        uptime_ms.alias("uptime_ms"),
    )


def heartbeat_records(
    ticks: DataFrame,
    service: str,
    subject: Column | None = None,
    fallback_subject: Column | None = None,
    tick_ms: str = "tick_ms",
    **details: Column,
) -> DataFrame:
    """``subject, value``: one service heartbeat per tick, as JSON.

    The subject is the one given, else the fallback, else ``heartbeat.<service>``.
    ``details`` are further fields (queue size, connection states, attempts,
    last ping); fields that are NULL are left out.
    """
    candidates = [F.nullif(c, F.lit("")) for c in (subject, fallback_subject) if c is not None]
    record = F.struct(
        F.lit(service).alias("service"),
        (F.col(tick_ms) / F.lit(1000)).cast("decimal(20,3)").alias("timestamp"),
        F.lit(defaults.SERVICE_VERSION).alias("version"),
        F.lit(defaults.HEALTHY).alias("status"),
        *[column.alias(name) for name, column in details.items()],
    )
    return ticks.select(
        F.coalesce(*candidates, F.lit(f"heartbeat.{service}")).alias("subject"),
        F.to_json(record).alias("value"),
    )


def metrics_snapshot(
    classified: DataFrame,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
    start_ms: int | None = None,
    report_ms: int | None = None,
    queue_size: int = 0,
    capacity: int = defaults.QUEUE_CAPACITY,
    connected: bool = True,
    bus_connected: bool = True,
    running: bool = True,
    reconnect_attempts: int = 0,
    last_ping_ms: int | None = None,
    heartbeat_enabled: bool = True,
    heartbeat_seconds: int = defaults.HEARTBEAT_SECONDS,
    ts: str = "recv_ts",
) -> DataFrame:
    """The client's metrics as one row.

    ``stream_count`` is the number of subscriptions, not of streams seen. Start
    and report time default to the first and last frame.
    """
    ms = F.unix_millis(ts)
    totals = classified.agg(
        _count(is_processed()).alias("processed_messages"),
        _count(is_dropped()).alias("dropped_messages"),
        F.max(F.when(F.col("shape") != MALFORMED, ms)).alias("last_message_ms"),
        F.min(ms).alias("_first"),
        F.max(ms).alias("_final"),
    )
    start = F.col("_first") if start_ms is None else F.lit(start_ms)
    report = F.col("_final") if report_ms is None else F.lit(report_ms)
    link, bus = (F.lit("connected" if up else "disconnected") for up in (connected, bus_connected))
    uptime = report - start
    return totals.select(
        F.lit(connected).alias("is_connected"),
        F.lit(running).alias("is_running"),
        link.alias("connection_status"),
        F.lit(reconnect_attempts).alias("reconnect_attempts"),
        "processed_messages",
        "dropped_messages",
        F.lit(len(subscriptions)).alias("stream_count"),
        F.array(*[F.lit(s) for s in subscriptions]).alias("streams"),
        F.lit(queue_size).alias("queue_size"),
        "last_message_ms",
        F.lit(last_ping_ms).cast("bigint").alias("last_ping_ms"),
        link.alias("websocket_state"),
        bus.alias("nats_state"),
        uptime.alias("uptime_ms"),
        per_second(F.col("processed_messages"), uptime).alias("messages_per_second"),
        percent(F.lit(queue_size).cast("bigint"), F.lit(capacity).cast("bigint")).alias(
            "queue_utilization_percent"
        ),
        (report - F.col("last_message_ms")).alias("ms_since_last_message"),
        F.lit(heartbeat_enabled).alias("heartbeat_enabled"),
        F.lit(heartbeat_seconds).alias("heartbeat_interval"),
    )


def stream_staleness(routed: DataFrame, report_ms: Column | int, ts: str = "recv_ts") -> DataFrame:
    """Milliseconds from each stream's last frame to the report time."""
    report = report_ms if isinstance(report_ms, Column) else F.lit(report_ms)
    return (
        routed.filter(F.col("stream").isNotNull())
        .groupBy("stream")
        .agg(F.max(F.unix_millis(ts)).alias("last_ms"))
        .withColumn("staleness_ms", report - F.col("last_ms"))
    )


def counts_by_stream(classified: DataFrame) -> DataFrame:
    """Processed frames per stream."""
    return classified.filter(is_processed()).groupBy("stream").agg(F.count("*").alias("messages"))


def throughput(df: DataFrame, group: str, ts: str = "recv_ts") -> DataFrame:
    """Frames, elapsed time and frames per second for each group."""
    ms = F.unix_millis(ts)
    return (
        df.groupBy(group)
        .agg(F.count("*").alias("frames"), (F.max(ms) - F.min(ms)).alias("elapsed_ms"))
        .withColumn("per_second", per_second(F.col("frames"), F.col("elapsed_ms")))
    )


def op_summary(
    operations: DataFrame,
    report_ms: Column | int,
    group: str | None = None,
    within_seconds: int = 3600,
    ts: str = "ts",
    success: str = "ok",
    duration: str = "duration_ms",
) -> DataFrame:
    """Success rate, number and mean duration of recent operations."""
    report = report_ms if isinstance(report_ms, Column) else F.lit(report_ms)
    recent = operations.filter(F.unix_millis(ts) >= report - within_seconds * 1000)
    grouped = recent.groupBy(group) if group else recent.groupBy()
    return grouped.agg(
        F.count(F.when(F.col(success), True)).alias("succeeded"),
        F.count("*").alias("total_operations"),
        F.sum(duration).alias("total_duration_ms"),
        (F.count(F.when(F.col(success), True)) / F.count("*")).alias("success_rate"),
        (F.sum(duration) / F.count("*")).alias("avg_duration_ms"),
    )


def health_alerts(
    report: DataFrame,
    rate: Column,
    dropped: Column,
    queue_percent: Column,
    connected: Column,
    staleness_ms: Column,
    min_rate: float = defaults.MIN_MESSAGES_PER_SECOND,
    max_queue_percent: float = defaults.MAX_QUEUE_PERCENT,
    max_staleness_seconds: float = defaults.MAX_STALENESS_SECONDS,
) -> DataFrame:
    """Add ``alerts``: which of the monitoring rules a report breaks, in order.

    What isn't known, such as the age of a message that never came, breaks its rule.
    """
    rules = {
        "low_rate": rate < min_rate,
        "dropped_messages": dropped > 0,
        "queue_full": queue_percent >= max_queue_percent,
        "disconnected": ~connected,
        "stale": staleness_ms >= max_staleness_seconds * 1000,
    }
    broken = [F.when(F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return report.withColumn("alerts", F.array_compact(F.array(*broken)))


def queue_utilisation(df: DataFrame, backlog: Column, capacity: Column | int) -> DataFrame:
    """Add ``utilisation_percent``: backlog of capacity, 0 for no capacity."""
    whole = capacity if isinstance(capacity, Column) else F.lit(capacity)
    value = F.when(whole > 0, backlog * F.lit(100.0) / whole).otherwise(F.lit(0.0))
    return df.withColumn("utilisation_percent", value)
