"""Queries over candles, extraction completions and job runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks.functions import numbers
from tapeworks.operators import history, payloads
from tapeworks.plans import inputs, sql
from tapeworks.plans.frame_queries import published
from tapeworks.plans.metric_queries import REPORT_MS
from tapeworks.sources import readers

PATTERNS = ("binance.extraction.klines.*", "binance.extraction.klines.*.15m", "binance.extraction.>")
TWO_HOURS_MS = 7200000


def _candles(spark, d):
    return history.candles(payloads.trades(published(spark, d)), ("1h", "1d"))


def candles(spark, d):
    """With some trades of something very cheap."""
    trades = payloads.trades(published(spark, d))
    tiny = (F.col("price") * F.lit("0.0000000001").cast("decimal(12,10)")).cast("decimal(38,18)")
    return history.candles(trades.withColumn("price", F.when(F.col("trade_id") % 4 == 0, tiny).otherwise(F.col("price"))), ("1h", "1d"))


def candle_gaps(spark, d):
    return history.candle_gaps(_candles(spark, d))


def gap_chunks(spark, d):
    return history.gap_chunks(history.candle_gaps(_candles(spark, d)), 2, TWO_HOURS_MS)


def high_water(spark, d):
    return history.high_water(_candles(spark, d))


def completeness(spark, d):
    return history.completeness(_candles(spark, d), REPORT_MS)


def completion_events(spark, d):
    return history.completion_events(inputs.completions(spark, d))


def batch_completion(spark, d):
    batches = history.batch_completion(inputs.completions(spark, d))
    return batches.withColumns(
        {
            "symbols": F.array_join("symbols", ","),
            "symbols_processed": F.col("symbols_processed").cast("bigint"),
        }
    )


def batch_errors(spark, d):
    return history.batch_errors(inputs.completions(spark, d))


def failed_extractions(spark, d):
    return history.failed_extractions(inputs.completions(spark, d)).select(
        "event_id", "extraction_type", "symbol", "period", F.col("error_count").cast("bigint").alias("error_count")
    )


def job_rollup(spark, d):
    runs = history.job_rollup(inputs.job_results(spark, d))
    runs = runs.withColumn("job_durations", F.array_compact("job_durations"))
    return runs.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("jobs", "job_success", "job_durations")}
    )


def subject_filter(spark, d):
    columns = F.col("extraction_type"), F.col("symbol"), F.col("period")
    value = F.when(F.col("records_fetched") % 4 == 0, F.lit("no json")).otherwise(
        F.to_json(F.struct("symbol", "success"))
    )
    messages = inputs.completions(spark, d).select(
        "event_id",
        numbers.subject("binance.extraction", *columns).alias("subject"),
        F.encode(value, "UTF-8").alias("value"),
    )
    return readers.subscribe(messages, PATTERNS).select(
        "pattern", "event_id", "text", F.try_variant_get("data", "$.symbol", "string").alias("symbol")
    )


_JSON_LIST = "'[' || coalesce(array_to_string(list_transform(errors, lambda x: '\"' || x || '\"'), ','), '') || ']'"

QUERIES = {
    "candles": (candles, "WITH " + sql.CANDLES.replace(", candles AS", """, tiny AS (
      SELECT * REPLACE (CAST(p AS DECIMAL(24,12)) * CASE WHEN event_id % 4 = 0 THEN 0.0000000001 ELSE 1.0000000000 END AS p) FROM ev
      ), candles AS""").replace("FROM ev CROSS", "FROM tiny CROSS") + " SELECT * FROM candles"),
    "candle_gaps": (candle_gaps, f"WITH {sql.GAPS} SELECT * FROM gaps"),
    "gap_chunks": (gap_chunks, f"""WITH {sql.GAPS}, c AS (
      SELECT symbol, period, gap_start_ms, gap_end_ms,
        unnest(generate_series(gap_start_ms, gap_end_ms, {TWO_HOURS_MS})) AS chunk_start_ms FROM gaps WHERE missing >= 2)
      SELECT *, least(chunk_start_ms + {TWO_HOURS_MS - 1}, gap_end_ms) AS chunk_end_ms FROM c"""),
    "high_water": (high_water, f"""WITH {sql.CANDLES}
      SELECT symbol, period, max(open_ms) AS last_open_ms FROM candles GROUP BY 1, 2"""),
    "completeness": (completeness, f"""WITH {sql.GAPS}, e AS (
      SELECT symbol, period, count(*) AS expected FROM slots GROUP BY 1, 2), p AS (
      SELECT symbol, period, count(*) AS present, max(open_ms) AS last FROM candles GROUP BY 1, 2)
      SELECT symbol, period, present, expected, (present * 20000 + expected) // (expected * 2) / 100.0::DOUBLE AS completeness_percent,
        {REPORT_MS} - last AS lag_ms FROM p JOIN e USING (symbol, period)"""),
    "completion_events": (completion_events, f"""WITH {sql.COMPLETIONS}
      SELECT 'binance.extraction.' || extraction_type || '.' || symbol || '.' || period AS subject,
        '{{"event_type":"extraction_completed","extraction_type":"' || extraction_type || '","symbol":"' || symbol ||
        '","period":"' || period || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '","success":' || success ||
        ',"metrics":{{"records_fetched":' || records_fetched || ',"records_written":' || records_written ||
        ',"duration_seconds":' || duration_seconds || ',"gaps_found":' || gaps_found || ',"gaps_filled":' || gaps_filled ||
        '}},"errors":' || {_JSON_LIST} || '}}' AS value FROM comp"""),
    "batch_completion": (batch_completion, f"""WITH {sql.COMPLETIONS}, t AS (
      SELECT extraction_type, period, count(*) AS extractions, bool_and(success) AS success,
        CAST(sum(records_fetched) AS BIGINT) AS total_records_fetched, CAST(sum(records_written) AS BIGINT) AS total_records_written,
        sum(duration_seconds) AS duration_seconds, CAST(sum(gaps_found) AS BIGINT) AS total_gaps_found,
        CAST(sum(gaps_filled) AS BIGINT) AS total_gaps_filled,
        string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols, count(DISTINCT symbol) AS symbols_processed,
        CAST(sum(len(errors)) AS BIGINT) AS total_errors
      FROM comp GROUP BY 1, 2)
      SELECT * FROM t"""),
    "batch_errors": (batch_errors, f"""WITH {sql.COMPLETIONS}
      SELECT extraction_type, period, error, count(*) AS n FROM (
        SELECT extraction_type, period, unnest(errors) AS error FROM comp) GROUP BY 1, 2, 3"""),
    "failed_extractions": (failed_extractions, f"""WITH {sql.COMPLETIONS}
      SELECT event_id, extraction_type, symbol, period, len(errors) AS error_count FROM comp WHERE NOT success"""),
    "job_rollup": (job_rollup, f"""WITH {sql.EV}, j AS (
      SELECT event_id // 4 AS run_id, event_id % 4 AS ord,
        CASE WHEN event_id % 16 <> 3 THEN p * CASE WHEN event_id % 6 = 0 THEN 2 ELSE 1 END END AS p,
        event_id % 16 <> 3 AND k % 10 <> 0 AND event_type <> 'error' AS ok FROM ev)
      SELECT run_id, bool_and(ok) AS success, sum(p) AS total_duration,
        string_agg(['klines', 'funding', 'trades', 'gap-filler'][ord + 1], ',' ORDER BY ord) AS jobs,
        string_agg(CAST(ok AS VARCHAR), ',' ORDER BY ord) AS job_success,
        string_agg(CAST(p AS VARCHAR), ',' ORDER BY ord) AS job_durations FROM j GROUP BY 1"""),
    "subject_filter": (subject_filter, f"""WITH {sql.COMPLETIONS}, m AS (
      SELECT pattern, event_id, k * 10 % 4 = 0 AS plain, symbol, success FROM comp
      CROSS JOIN (VALUES ('binance.extraction.klines.*.15m'), ('binance.extraction.>')) AS t(pattern)
      WHERE pattern = 'binance.extraction.>' OR (extraction_type = 'klines' AND period = '15m'))
      SELECT pattern, event_id,
        CASE WHEN plain THEN 'no json' ELSE '{{"symbol":"' || symbol || '","success":' || success || '}}' END AS text,
        CASE WHEN NOT plain THEN symbol END AS symbol FROM m"""),
}
