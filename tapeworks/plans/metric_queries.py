"""Queries over classified frames and outcome logs: counters, rates, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions import routing
from tapeworks.functions.numbers import percent
from tapeworks.operators import bucket, metrics, quantile, snapshots, throttle
from tapeworks.plans import inputs, sql
from tapeworks.plans.frame_queries import classified
from tapeworks.streaming.observe import counters

HOUR = 3600
# Fixed report time and start: the events cover January 2024.
REPORT_MS = 1706745600000
START_MS = 1704067200000


def running_totals(spark, d):
    k = F.col("k")
    frames = classified(spark, d, ("k",), not_connected=k % 10 == 3)
    return metrics.running_totals(frames, HOUR)


def heartbeat_report(spark, d):
    return metrics.heartbeat_report(classified(spark, d), HOUR)


def heartbeat_records(spark, d):
    own = F.when(F.col("total_processed") % 2 == 0, "ops.heartbeat")
    total = F.col("total_processed")
    return metrics.heartbeat_records(heartbeat_report(spark, d), "frames", own, queue_size=F.when(total % 3 == 0, total))


def metrics_snapshot(spark, d):
    snapshot = metrics.metrics_snapshot(classified(spark, d), queue_size=45, bus_connected=False)
    return snapshot.withColumn("streams", F.array_join("streams", ","))


def metrics_history(spark, d):
    """Hourly, with states out of five logs; a view or click tells a queue size or a ping, a signup or error a state."""
    events, k = inputs.events(spark, d), F.col("k")
    log = lambda kind, value: events.where(F.col("event_type") == kind).select("ts", F.col("event_id").alias("seq"), value.alias("value"))
    logs = {
        "connected": log("signup", k % 3 != 0),
        "bus_connected": log("error", k % 2 == 0),
        "queue_size": log("view", F.when(k % 7 != 0, k * 10)),
        "reconnect_attempts": log("error", k % 5),
        "last_ping_ms": log("click", F.unix_millis("ts")),
    }
    history = snapshots.metrics_history(classified(spark, d), logs, HOUR)
    return history.drop("streams", "stream_count", "heartbeat_enabled")


def _bucket(spark, d):
    log = inputs.histories(spark, d).withColumnsRenamed({"name": "sym", "seq": "event_id"})
    return bucket.leaky_bucket(log, "sym", "1/7200", 3, "ts", "event_id")


def leaky_bucket(spark, d):
    return _bucket(spark, d).select("sym", "seq", "dropped", "backlog_units")


def queue_utilisation(spark, d):
    used = metrics.queue_utilisation(_bucket(spark, d), F.col("backlog"), 3)
    return used.select("sym", "seq", "utilisation_percent")


def stream_staleness(spark, d):
    return metrics.stream_staleness(classified(spark, d), REPORT_MS)


def throttled_stats(spark, d):
    frames = classified(spark, d, ("k",), not_connected=F.col("k") % 10 == 3)
    keyed = frames.filter(F.col("stream").isNotNull()).withColumn(
        "symbol", routing.stream_symbol(F.col("stream"))
    )
    emitted = throttle.throttled_stats(
        keyed, "symbol", metrics.is_processed(), metrics.is_dropped(), START_MS, HOUR
    )
    return emitted.select("symbol", "seq", "processed", "dropped", "per_second")


def counts_by_stream(spark, d):
    return metrics.counts_by_stream(classified(spark, d))


def health_rules(spark, d):
    report = heartbeat_report(spark, d)
    alerts = metrics.health_alerts(
        report,
        rate=F.col("messages_per_second"),
        dropped=F.col("processed_since_last") % 7 - 5,
        queue_percent=percent(F.col("processed_since_last"), F.lit(15).cast("bigint")),
        connected=F.when(F.col("total_processed") % 7 != 0, F.col("total_processed") % 5 != 0),
        staleness_ms=F.when(F.col("total_processed") % 3 != 0, F.col("ms_since_last_message")),
        min_rate=0.01,
        max_staleness_seconds=600,
    )
    return alerts.select("tick_ms", F.array_join("alerts", ",").alias("alerts"))


def latency_p95(spark, d):
    return quantile.latency_summary(inputs.events(spark, d), "event_type", "p")


def throughput(spark, d):
    return metrics.throughput(inputs.events(spark, d), "sym", "ts")


def op_summary(spark, d):
    log = inputs.outcomes(spark, d)
    return metrics.op_summary(log, REPORT_MS, "name", within_seconds=10 * 86400)


def observed_counts(spark, d):
    k = F.col("k")
    return classified(spark, d, ("k",), not_connected=k % 10 == 3).agg(*counters())


_RATE = "CASE WHEN {ms} > 0 THEN ({n} * 200000 + {ms}) // ({ms} * 2) / 100.0::DOUBLE ELSE 0.0::DOUBLE END"

QUERIES = {
    "running_totals": (running_totals, f"""WITH {sql.FR}, agg AS (
      SELECT ms // 3600000 * 3600000 AS interval_start_ms,
        count(*) FILTER (disposition = 'published' AND k % 10 <> 3) AS processed,
        count(*) FILTER (disposition = 'published' AND k % 10 = 3) AS dropped FROM cl GROUP BY 1)
      SELECT *, CAST(sum(processed) OVER w AS BIGINT) AS total_processed,
        CAST(sum(dropped) OVER w AS BIGINT) AS total_dropped FROM agg WINDOW w AS (ORDER BY interval_start_ms)"""),
    "heartbeat_report": (heartbeat_report, f"""WITH {sql.BEAT} SELECT *,
      {_RATE.format(n='processed_since_last', ms='3600000')} AS messages_per_second,
      {_RATE.format(n='total_processed', ms='uptime_ms')} AS overall_rate_per_second FROM beat"""),
    "heartbeat_records": (heartbeat_records, f"""WITH {sql.BEAT}
      SELECT CASE WHEN total_processed % 2 = 0 THEN 'ops.heartbeat' ELSE 'heartbeat.frames' END AS subject,
        '{{"service":"frames","timestamp":' || tick_ms // 1000 || '.000,"version":"1.0.0","status":"healthy"' ||
          CASE WHEN total_processed % 3 = 0 THEN ',"queue_size":' || total_processed ELSE '' END || '}}' AS value
      FROM beat"""),
    "metrics_snapshot": (metrics_snapshot, f"""WITH {sql.FR}, t AS (
      SELECT count(*) FILTER (disposition = 'published') AS n, max(ms) FILTER (shape <> 'malformed') AS last_ms,
        min(ms) AS a, max(ms) AS b FROM cl)
      SELECT true AS is_connected, true AS is_running, 'connected' AS connection_status, 0 AS reconnect_attempts,
        n AS processed_messages, 0 AS dropped_messages, 8 AS stream_count,
        '{",".join(defaults.DEFAULT_STREAMS)}' AS streams, 45 AS queue_size, last_ms AS last_message_ms,
        NULL AS last_ping_ms, 'connected' AS websocket_state, 'disconnected' AS nats_state, b - a AS uptime_ms,
        {_RATE.format(n='n', ms='(b - a)')} AS messages_per_second, 0.9::DOUBLE AS queue_utilization_percent,
        b - last_ms AS ms_since_last_message, true AS heartbeat_enabled, 60 AS heartbeat_interval FROM t"""),
    "metrics_history": (metrics_history, f"""WITH {sql.BEAT}, changes AS (
      SELECT *, ms // 3600000 * 3600000 + 3600000 AS tick_ms, us::HUGEINT * 1000000000000 + event_id AS place FROM ev),
      c AS (SELECT tick_ms, arg_max(k % 3 <> 0, place) AS up FROM changes WHERE event_type = 'signup' GROUP BY 1),
      e AS (SELECT tick_ms, arg_max(k % 2 = 0, place) AS bus, arg_max(k % 5, place) AS attempts
        FROM changes WHERE event_type = 'error' GROUP BY 1),
      q AS (SELECT tick_ms, nullif(arg_max(CASE WHEN k % 7 <> 0 THEN k * 10 ELSE -1 END, place), -1) AS queue
        FROM changes WHERE event_type = 'view' GROUP BY 1),
      g AS (SELECT tick_ms, max(ms) AS ping FROM changes WHERE event_type = 'click' GROUP BY 1),
      s AS (SELECT beat.*, coalesce(up, false) AS up, coalesce(bus, false) AS bus, coalesce(attempts, 0) AS attempts,
          CASE WHEN q.tick_ms IS NULL THEN 0 ELSE queue END AS queue, ping
        FROM beat ASOF LEFT JOIN c ON beat.tick_ms >= c.tick_ms ASOF LEFT JOIN e ON beat.tick_ms >= e.tick_ms
        ASOF LEFT JOIN q ON beat.tick_ms >= q.tick_ms ASOF LEFT JOIN g ON beat.tick_ms >= g.tick_ms)
      SELECT tick_ms AS report_ms, up AS is_connected, true AS is_running, attempts AS reconnect_attempts,
        CASE WHEN up THEN 'connected' ELSE 'disconnected' END AS connection_status, total_processed AS processed_messages,
        0 AS dropped_messages, queue AS queue_size, tick_ms - nullif(ms_since_last_message, 0) AS last_message_ms,
        ping AS last_ping_ms, CASE WHEN up THEN 'connected' ELSE 'disconnected' END AS websocket_state,
        CASE WHEN bus THEN 'connected' ELSE 'disconnected' END AS nats_state, uptime_ms,
        {_RATE.format(n='total_processed', ms='uptime_ms')} AS messages_per_second,
        (queue * 20000 + {defaults.QUEUE_CAPACITY}) // ({defaults.QUEUE_CAPACITY} * 2) / 100.0::DOUBLE AS queue_utilization_percent,
        nullif(ms_since_last_message, 0) AS ms_since_last_message, 3600 AS heartbeat_interval FROM s"""),
    "queue_utilisation": (queue_utilisation, f"""{sql.BUCKET}
      SELECT sym, event_id AS seq, backlog_units / 7200000000.0::DOUBLE * 100.0::DOUBLE / 3 AS utilisation_percent
      FROM steps WHERE rn > 0 UNION ALL SELECT sym, event_id, NULL FROM hist WHERE us IS NULL"""),
    "leaky_bucket": (leaky_bucket, f"""{sql.BUCKET}
      SELECT sym, event_id AS seq, dropped, backlog_units FROM steps WHERE rn > 0 UNION ALL
      SELECT sym, event_id, NULL, NULL FROM hist WHERE us IS NULL"""),
    "stream_staleness": (stream_staleness, f"""WITH {sql.FR} SELECT stream, max(ms) AS last_ms,
      {REPORT_MS} - max(ms) AS staleness_ms FROM cl WHERE stream IS NOT NULL GROUP BY 1"""),
    "throttled_stats": (throttled_stats, f"""WITH RECURSIVE {sql.FR}, o AS (
      SELECT split_part(stream, '@', 1) AS symbol, event_id, us, k % 10 = 3 AS lost,
        count(*) FILTER (k % 10 <> 3) OVER w AS processed, count(*) FILTER (k % 10 = 3) OVER w AS dropped
      FROM cl WHERE disposition = 'published' WINDOW w AS (PARTITION BY split_part(stream, '@', 1) ORDER BY us, event_id)),
      p AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY us, event_id) AS rn FROM o WHERE NOT lost),
      steps AS (
        SELECT symbol, 0::BIGINT AS rn, 0::BIGINT AS event_id, 0::BIGINT AS us, 0::BIGINT AS processed, 0::BIGINT AS dropped,
               false AS emits, {START_MS}000::BIGINT AS last FROM (SELECT DISTINCT symbol FROM p)
        UNION ALL
        SELECT p.symbol, p.rn, p.event_id, p.us, p.processed, p.dropped, p.us - s.last >= 3600000000,
               CASE WHEN p.us - s.last >= 3600000000 THEN p.us ELSE s.last END
        FROM steps s JOIN p ON p.symbol = s.symbol AND p.rn = s.rn + 1)
      SELECT symbol, event_id AS seq, processed, dropped,
        {_RATE.format(n='processed', ms=f'(us // 1000 - {START_MS})')} AS per_second FROM steps WHERE emits"""),
    "counts_by_stream": (counts_by_stream, f"""WITH {sql.FR}
      SELECT stream, count(*) AS messages FROM cl WHERE disposition = 'published' GROUP BY 1"""),
    "health_rules": (health_rules, f"""WITH {sql.BEAT} SELECT tick_ms, concat_ws(',',
      CASE WHEN {_RATE.format(n='processed_since_last', ms='3600000')} < 0.01 THEN 'low_rate' END,
      CASE WHEN processed_since_last % 7 > 5 THEN 'dropped_messages' END,
      CASE WHEN processed_since_last >= 12 THEN 'queue_full' END,
      CASE WHEN total_processed % 5 = 0 OR total_processed % 7 = 0 THEN 'disconnected' END,
      CASE WHEN ms_since_last_message >= 600000 OR total_processed % 3 = 0 THEN 'stale' END) AS alerts FROM beat"""),
    "latency_p95": (latency_p95, f"""WITH {sql.EV}, r AS (
      SELECT event_type, p, row_number() OVER (PARTITION BY event_type ORDER BY p) - 1 AS i,
        count(*) OVER (PARTITION BY event_type) AS n FROM ev)
      SELECT event_type, n, CAST(sum(p) AS DOUBLE) / n AS mean,
        max(p) FILTER (i = n * 95 // 100) AS p_value FROM r GROUP BY event_type, n"""),
    "throughput": (throughput, f"""WITH {sql.EV}, t AS (
      SELECT sym, count(*) AS frames, max(ms) - min(ms) AS elapsed_ms FROM ev GROUP BY 1)
      SELECT *, {_RATE.format(n='frames', ms='elapsed_ms')} AS per_second FROM t"""),
    "op_summary": (op_summary, f"""WITH {sql.EV} SELECT sym AS name, count(*) FILTER (event_type <> 'error') AS succeeded,
      count(*) AS total_operations, CAST(sum(k) AS BIGINT) AS total_duration_ms,
      count(*) FILTER (event_type <> 'error') / count(*) AS success_rate, CAST(sum(k) AS BIGINT) / count(*) AS avg_duration_ms
      FROM ev WHERE ms >= {REPORT_MS} - 864000000 GROUP BY 1"""),
    "observed_counts": (observed_counts, f"""WITH {sql.FR} SELECT count(*) AS offered,
      count(*) FILTER (disposition = 'published' AND k % 10 <> 3) AS processed,
      count(*) FILTER (disposition = 'published' AND k % 10 = 3) AS dropped FROM cl"""),
}
