"""Queries with order-dependent rules: shedding, breakers, outages, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks.operators import breaker, intake_limits, payloads
from tapeworks.plans import inputs, sql
from tapeworks.plans.frame_queries import published
from tapeworks.plans.metric_queries import HOUR, REPORT_MS

THRESHOLD, RECOVERY = 3, HOUR


def _replay(spark, d):
    return breaker.breaker_replay(inputs.histories(spark, d), THRESHOLD, RECOVERY)


def breaker_replay(spark, d):
    return _replay(spark, d).select(
        "name", "seq", "ok", "state_before", "state_after", "result", "failure_count"
    )


def breaker_metrics(spark, d):
    return breaker.breaker_metrics(
        inputs.histories(spark, d), THRESHOLD, RECOVERY, REPORT_MS
    )


def recent_transitions(spark, d):
    recent = breaker.transitions(_replay(spark, d), REPORT_MS, within_seconds=31 * 86400)
    return recent.select("name", F.unix_millis("ts").alias("ms"), "seq", "state_before", "state_after", "failure_count")


def outage_episodes(spark, d):
    episodes = intake_limits.outage_episodes(
        inputs.outcomes(spark, d), max_attempts=3
    )
    return episodes.select("name", "seq", "ok", "episode", "attempt", "expected_delay", "outcome")


def quota_shed(spark, d):
    shed = intake_limits.quota_shed(inputs.frames(spark, d), HOUR, 8)
    return shed.select("frame_id", "interval", "shed")


def ttl_filter(spark, d):
    frames = inputs.events(spark, d)
    sent = F.timestamp_micros(F.unix_micros("ts") - F.col("k") * 1_000_000)
    sent = F.when(F.col("event_id") % 13 != 0, sent)
    return intake_limits.within_ttl(frames, sent, ts="ts").select("event_id", "k")


def dedup_trades(spark, d):
    """A second collector delivers every trade again, some earlier and some later; some have no id."""
    keep = ("frame_id", "recv_ts")
    once = payloads.trades(published(spark, d), keep=keep)
    once = once.withColumn("trade_id", F.when(F.col("trade_id") % 9 != 0, F.col("trade_id")))
    lag = (F.col("quantity").cast("bigint") - 50) * 1_000_000
    again = once.withColumn("recv_ts", F.timestamp_micros(F.unix_micros("recv_ts") + lag)).withColumn(
        "frame_id", F.col("frame_id") + 1_000_000_000
    )
    kept = intake_limits.deduplicate(once.unionByName(again), ["symbol", "trade_id"])
    return kept.select("symbol", "trade_id", "frame_id", F.unix_micros("recv_ts").alias("recv_us"))


QUERIES = {
    "breaker_replay": (breaker_replay, f"""{sql.BREAKER} SELECT sym AS name, event_id AS seq, ok, state_before,
      state_after, result, failure_count FROM steps WHERE rn > 0 UNION ALL
      SELECT sym, event_id, event_type <> 'error', NULL, NULL, 'no_time', NULL FROM hist WHERE us IS NULL"""),
    "breaker_metrics": (breaker_metrics, f"""{sql.BREAKER}, final AS (
      SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY sym ORDER BY rn DESC) = 1)
      SELECT sym AS name, state_after AS state, failure_count, 3 AS failure_threshold, 3600 AS recovery_timeout,
        failed_us // 1000 AS last_failure_ms, {REPORT_MS} - failed_us // 1000 AS ms_since_last_failure FROM final"""),
    "recent_transitions": (recent_transitions, f"""{sql.BREAKER}
      SELECT sym AS name, us // 1000 AS ms, event_id AS seq, state_before, state_after, failure_count FROM steps
      WHERE rn > 0 AND state_before <> state_after AND us // 1000 >= {REPORT_MS} - 2678400000"""),
    "outage_episodes": (outage_episodes, f"""WITH {sql.EV}, e AS (
      SELECT *, event_type <> 'error' AS ok, count(*) FILTER (event_type <> 'error') OVER (
        PARTITION BY sym ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS episode FROM ev),
      a AS (SELECT *, row_number() OVER (PARTITION BY sym, episode ORDER BY us, event_id) - 1 AS attempt FROM e)
      SELECT sym AS name, event_id AS seq, ok, episode, attempt,
        CASE WHEN attempt < 3 THEN CAST(5 * pow(2, attempt) AS BIGINT) END AS expected_delay,
        CASE WHEN ok AND attempt = 0 THEN 'steady' WHEN ok AND attempt < 3 THEN 'recovered' WHEN ok THEN 'restarted'
             WHEN attempt < 2 THEN 'failed' WHEN attempt = 2 THEN 'gave_up' ELSE 'stopped' END AS outcome FROM a"""),
    "quota_shed": (quota_shed, f"""WITH {sql.EV} SELECT event_id AS frame_id, ms // 3600000 AS interval,
      row_number() OVER (PARTITION BY ms // 3600000 ORDER BY us, event_id) > 8 AS shed FROM ev"""),
    "ttl_filter": (ttl_filter, f"WITH {sql.EV} SELECT event_id, k FROM ev WHERE k <= 60 OR event_id % 13 = 0"),
    "dedup_trades": (dedup_trades, f"""WITH {sql.EV}, both_ AS (
      SELECT sym, CASE WHEN event_id % 9 <> 0 THEN event_id END AS id, event_id AS frame_id, us FROM ev WHERE event_type = 'purchase' UNION ALL
      SELECT sym, CASE WHEN event_id % 9 <> 0 THEN event_id END, event_id + 1000000000, us + (k - 49) * 1000000 FROM ev WHERE event_type = 'purchase')
      SELECT sym AS symbol, id AS trade_id, frame_id, us AS recv_us FROM both_
      QUALIFY id IS NULL OR row_number() OVER (PARTITION BY sym, id ORDER BY us, frame_id) = 1"""),
}
