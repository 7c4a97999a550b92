"""Queries over raw frames: reading, parsing, routing, enveloping, typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions import envelope as env
from tapeworks.functions import numbers, routing
from tapeworks.operators import intake, payloads
from tapeworks.plans import inputs, sql
from tapeworks.sources import readers, writers

# Payload columns that keep their place in time as epoch milliseconds.
def _as_ms(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.withColumn(name, F.unix_millis(name)).withColumnRenamed(name, f"{name}_ms")
    return df


def classified(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = (), **happened) -> DataFrame:
    return intake.classify(inputs.frames(spark, sf_dir, keep), **happened)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.published(classified(spark, sf_dir))


def enveloped(spark: SparkSession, sf_dir: str, trace=None) -> DataFrame:
    identity = env.stable_message_id(F.col("stream"), F.col("frame_id"))
    return intake.attach_envelope(published(spark, sf_dir), message_id=identity, trace=trace)


def streams_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline: raw frames to messages per stream and kind."""
    return (
        published(spark, sf_dir)
        .groupBy("stream", routing.message_kind(F.col("stream")).alias("kind"))
        .agg(F.count("*").alias("messages"))
    )


def src_raw_frames(spark, d):
    frames = readers.table_frames(inputs.frames(spark, d))
    return frames.select("frame_id", F.unix_millis("recv_ts").alias("recv_ms"), "raw")


def subscription_list(spark, d):
    sym, k = F.lower("sym"), F.col("k")
    spec = (
        F.when(k % 3 == 0, F.lit(""))
        .when(k % 3 == 1, F.concat(F.lit(" "), sym, F.lit("@trade , "), sym, F.lit("@ticker")))
        .otherwise(F.concat(sym, F.lit("@depth5,"), F.col("event_type"), F.lit("@x ,  ")))
    )
    listed = readers.subscription_list(spec)
    return inputs.events(spark, d).select("event_id", F.posexplode(listed).alias("pos", "stream"))


def sink_envelope_json(spark, d):
    """Some frames come with line breaks, numbers that are not finite and such words in strings."""
    raw = F.replace(F.col("raw"), F.lit('{"e":'), F.lit('{\n"x":NaN,\r\n"note":"a\\" NaN","e":'))
    odd = inputs.frames(spark, d).withColumn("raw", F.when(F.col("frame_id") % 3 == 0, raw).otherwise(F.col("raw")))
    identity = env.stable_message_id(F.col("stream"), F.col("frame_id"))
    return writers.to_messages(intake.attach_envelope(intake.published(intake.classify(odd)), message_id=identity))


def parse_frames(spark, d):
    is_object = F.col("shape") == intake.OBJECT
    return intake.parse(inputs.frames(spark, d)).select(
        "frame_id",
        "shape",
        F.when(is_object, F.col("event")).alias("event"),
        F.when(is_object, F.col("symbol")).alias("symbol"),
    )


def reject_non_object(spark, d):
    return intake.rejected(classified(spark, d), "invalid_format").select("frame_id", "raw")


def reject_unroutable(spark, d):
    return intake.rejected(classified(spark, d), "unknown_stream").select("frame_id", "raw")


def validate_envelope(spark, d):
    checked = intake.validate_messages(inputs.messages(spark, d))
    return checked.select("event_id", "error", F.col("error").isNull().alias("valid"))


def required_fields(spark, d):
    return intake.missing_fields(inputs.messages(spark, d)).select(
        "event_id", F.array_join("missing", ",").alias("missing")
    )


def size_filter(spark, d):
    kept = intake.within_size(inputs.frames(spark, d), 100)
    return kept.select("frame_id", F.octet_length("raw").cast("bigint").alias("bytes"))


def subscribed_only(spark, d):
    return intake.subscribed_only(published(spark, d), defaults.DEFAULT_STREAMS).select("frame_id", "stream")


def disposition_counts(spark, d):
    k = F.col("k")
    return intake.disposition_counts(
        classified(
            spark, d, ("k",), queue_full=k % 10 == 7, not_connected=k % 10 == 3, publish_error=k % 10 == 4
        )
    )


def route_stream(spark, d):
    return classified(spark, d).select("frame_id", "stream")


def message_kind(spark, d):
    return published(spark, d).select("frame_id", routing.message_kind(F.col("stream")).alias("kind"))


def stream_parts(spark, d):
    stream = F.col("stream")
    return published(spark, d).select(
        "frame_id",
        routing.stream_symbol(stream).alias("symbol"),
        routing.stream_type(stream).alias("stream_type"),
        routing.stream_qualifier(stream).alias("qualifier"),
    )


def stream_format_ok(spark, d):
    sym = F.col("sym")
    candidates = F.array(
        F.concat(F.lower(sym), F.lit("@trade")), F.concat(sym, F.lit("@trade")), F.lit("123@trade"),
        F.lit("@trade"), F.lower(sym), F.concat(F.lit("1"), F.lower(sym), F.lit("@")),
        F.concat(F.initcap(sym), F.lit("@a@b")),
    )
    named = inputs.events(spark, d).select(
        "event_id", F.get(candidates, (F.col("event_id") % 7).cast("int")).alias("stream")
    )
    return named.withColumn("ok", routing.stream_format_ok(F.col("stream")))


def envelope(spark, d):
    e = F.col("envelope")
    return enveloped(spark, d).select(
        e["stream"].alias("stream"), e["data"].alias("data"),
        F.unix_millis(e["timestamp"]).alias("timestamp_ms"), e["message_id"].alias("message_id"),
        e["source"].alias("source"), e["version"].alias("version"),
    )


def envelope_json(spark, d):
    return enveloped(spark, d).select("frame_id", env.envelope_json(F.col("envelope")).alias("json"))


def parse_envelope_ts(spark, d):
    ts, k = F.col("ts"), F.col("k")
    micros, whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(k % 5 == 0, F.concat(micros, F.lit("Z")))
        .when(k % 5 == 1, micros)
        .when(k % 5 == 2, F.concat(whole, F.lit("Z")))
        .when(k % 5 == 3, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("at "), whole))
    )
    return inputs.events(spark, d).select(
        "event_id", F.unix_micros(env.parse_envelope_ts(text)).alias("ts_us")
    )


def format_envelope_ts(spark, d):
    ts = F.when(F.col("k") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return inputs.events(spark, d).select("event_id", env.format_envelope_ts(ts).alias("text"))


def message_id(spark, d):
    return published(spark, d).select(
        "frame_id",
        env.stable_message_id(F.col("stream"), F.col("frame_id")).alias("stable_id"),
        F.length(env.random_message_id()).cast("bigint").alias("random_id_length"),
    )


def trace_context(spark, d):
    traced = F.when(
        F.col("frame_id") % 2 == 0,
        F.create_map(F.lit("traceparent"), F.concat(F.lit("00-"), F.col("frame_id").cast("string"))),
    )
    e = F.col("envelope")
    return enveloped(spark, d, traced).select(
        "frame_id",
        e[env.TRACE_FIELD]["traceparent"].alias("traceparent"),
        F.get_json_object(env.envelope_json(e), f"$.{env.TRACE_FIELD}").alias("published_trace"),
    )


def backoff_schedule(spark, d):
    waits = numbers.backoff_schedule(F.col("k") % 10 + 1, F.col("event_id") % 12)
    return inputs.events(spark, d).select(
        "event_id", F.posexplode(waits).alias("attempt", "wait_seconds")
    )


def subject_build(spark, d):
    prefix = defaults.EXTRACTION_PREFIX
    columns = F.col("extraction_type"), F.col("symbol"), F.col("period")
    return inputs.completions(spark, d).select(
        "event_id",
        numbers.subject(prefix, *columns).alias("single"),
        numbers.subject(prefix, columns[0], None, columns[2]).alias("batch"),
    )


def klines_typed(spark, d):
    typed = payloads.klines(published(spark, d), keep=("frame_id",))
    return _as_ms(typed, "open_time", "close_time").select(
        "frame_id", "symbol", "interval", "open_time_ms", "close_time_ms", "open", "close", "high", "low", "volume", "trade_count", "is_closed"
    )


def mark_prices_typed(spark, d):
    typed = payloads.mark_prices(published(spark, d), keep=("frame_id",)).drop("settle_price")
    return _as_ms(typed, "event_time", "next_funding_time")


def funding_typed(spark, d):
    return _as_ms(payloads.funding_rates(published(spark, d), keep=("frame_id",)), "event_time", "funding_time")


def trades_typed(spark, d):
    return _as_ms(payloads.trades(published(spark, d)), "event_time", "trade_time")


def tickers_typed(spark, d):
    return _as_ms(payloads.tickers(published(spark, d)), "event_time", "open_time", "close_time")


def depth_typed(spark, d):
    levels = lambda c: F.array_join(F.transform(c, lambda p: F.array_join(p, ":")), ",")
    typed = _as_ms(payloads.depth_updates(published(spark, d)), "event_time")
    return typed.withColumns({"bids": levels("bids"), "asks": levels("asks")})


def book_typed(spark, d):
    return payloads.books(published(spark, d), keep=("frame_id",)).select(
        "frame_id", "stream", "last_update_id",
        F.size("bids").cast("bigint").alias("bid_levels"), F.col("asks").isNull().alias("no_asks"),
    )


def book_levels(spark, d):
    return payloads.book_levels(published(spark, d), keep=("frame_id",))


_PUB = "FROM cl WHERE disposition = 'published'"
_RPUB = "FROM rw WHERE disposition = 'published'"
_MESSAGE_JSON = """'{"stream":"' || stream || '","data":' || raw || ',"timestamp":"' ||
  CASE WHEN us % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END ||
  '","message_id":"' || sha256(stream || '~' || event_id) || '","source":"binance-websocket","version":"1.0"}'"""
_NUMBERS = "DECIMAL(38,18)"

QUERIES = {
    "streams_by_kind": (streams_by_kind, f"""WITH {sql.FR}
      SELECT stream, CASE WHEN stream LIKE '%@trade%' THEN 'trade' WHEN stream LIKE '%@ticker%' THEN 'ticker'
        WHEN stream LIKE '%@depth%' THEN 'depth' ELSE 'generic' END AS kind, count(*) AS messages
      {_PUB} GROUP BY 1, 2"""),
    "src_raw_frames": (src_raw_frames, f"WITH {sql.RAW} SELECT event_id AS frame_id, ms AS recv_ms, raw FROM rw"),
    "subscription_list": (subscription_list, f"""WITH {sql.EV}, l AS (
      SELECT event_id, CASE k % 3
        WHEN 0 THEN ['btcusdt@trade','btcusdt@ticker','btcusdt@depth20@100ms','btcusdt@kline_1h',
                     'ethusdt@trade','ethusdt@ticker','ethusdt@depth20@100ms','ethusdt@kline_1h']
        WHEN 1 THEN [lower(sym) || '@trade', lower(sym) || '@ticker']
        ELSE [lower(sym) || '@depth5', event_type || '@x', ''] END AS streams FROM ev)
      SELECT event_id, CAST(unnest(range(len(streams))) AS INTEGER) AS pos, unnest(streams) AS stream FROM l"""),
    "sink_envelope_json": (sink_envelope_json, f"""WITH {sql.RAW}
      SELECT 'binance.websocket.data' AS topic, stream AS key, {_MESSAGE_JSON} AS value FROM (
        SELECT * REPLACE (CASE WHEN frame_id % 3 = 0
          THEN replace(raw, '{{"e":', '{{ "x":null,  "note":"a\\" NaN","e":') ELSE raw END AS raw) {_RPUB})"""),
    "parse_frames": (parse_frames, f"""WITH {sql.FR}
      SELECT frame_id, shape, CASE event_type
          WHEN 'purchase' THEN 'trade' WHEN 'view' THEN '24hrTicker' WHEN 'click' THEN 'depthUpdate'
          WHEN 'signup' THEN ['kline','markPriceUpdate','fundingRate','aggTrade'][event_id % 4 + 1]
          ELSE CASE WHEN event_id % 8 = 4 THEN 'trade' END END AS event,
        CASE WHEN event_type <> 'error' OR event_id % 8 IN (3, 6) THEN ls END AS symbol
      FROM cl"""),
    "reject_non_object": (reject_non_object, f"WITH {sql.RAW} SELECT frame_id, raw FROM rw WHERE disposition = 'invalid_format'"),
    "reject_unroutable": (reject_unroutable, f"WITH {sql.RAW} SELECT frame_id, raw FROM rw WHERE disposition = 'unknown_stream'"),
    "validate_envelope": (validate_envelope, f"""WITH {sql.EV}, v AS (
      SELECT event_id, [NULL, 'Missing required field: ''stream''', 'Missing required field: ''data''',
        'Missing required field: ''stream''', 'Invalid message format: not an object',
        'Invalid message format: data is not an object', 'Invalid message format: stream is not a string',
        'Invalid message format: message_id is not a string'][event_id % 8 + 1] AS error FROM ev)
      SELECT event_id, error, error IS NULL AS valid FROM v"""),
    "required_fields": (required_fields, f"""WITH {sql.EV}
      SELECT event_id, ['', 'stream', 'data,timestamp', 'stream,data,timestamp', 'stream,data,timestamp',
        'timestamp', '', 'timestamp'][event_id % 8 + 1] AS missing FROM ev"""),
    "size_filter": (size_filter, f"WITH {sql.RAW} SELECT frame_id, strlen(raw) AS bytes FROM rw WHERE strlen(raw) <= 100"),
    "subscribed_only": (subscribed_only, f"""WITH {sql.FR} SELECT frame_id, stream {_PUB}
      AND ls IN ('btcusdt', 'ethusdt') AND split_part(stream, '@', 1) IN ('btcusdt', 'ethusdt')
      AND (split_part(stream, '@', 2) IN ('trade', 'ticker', 'depth20') OR (stream LIKE '%@kline' AND event_id % 8 = 0))
      UNION ALL SELECT frame_id, stream {_PUB} AND ls NOT IN ('btcusdt', 'ethusdt') AND stream = 'btcusdt@depth20@100ms'"""),
    "disposition_counts": (disposition_counts, f"""WITH {sql.FR}, d AS (
      SELECT CASE WHEN disposition = 'malformed_json' THEN disposition WHEN k % 10 = 7 THEN 'queue_full'
        WHEN disposition <> 'published' THEN disposition WHEN k % 10 = 3 THEN 'not_connected'
        WHEN k % 10 = 4 THEN 'publish_error' ELSE disposition END AS disposition FROM cl)
      SELECT disposition, count(d.disposition) AS frames
      FROM (VALUES ('malformed_json'), ('queue_full'), ('invalid_format'), ('unknown_stream'),
                   ('not_connected'), ('publish_error'), ('published')) AS t(disposition)
      LEFT JOIN d USING (disposition) GROUP BY 1"""),
    "route_stream": (route_stream, f"WITH {sql.FR} SELECT frame_id, stream FROM cl"),
    "message_kind": (message_kind, f"""WITH {sql.FR} SELECT frame_id, CASE event_type
      WHEN 'purchase' THEN 'trade' WHEN 'view' THEN 'ticker' WHEN 'signup' THEN 'generic' ELSE 'depth' END AS kind {_PUB}"""),
    "stream_parts": (stream_parts, f"""WITH {sql.FR} SELECT frame_id, split_part(stream, '@', 1) AS symbol,
      split_part(stream, '@', 2) AS stream_type, nullif(split_part(stream, '@', 3), '') AS qualifier {_PUB}"""),
    "stream_format_ok": (stream_format_ok, f"""WITH {sql.EV} SELECT event_id,
      [lower(sym) || '@trade', sym || '@trade', '123@trade', '@trade', lower(sym), '1' || lower(sym) || '@',
       upper(sym[1]) || lower(sym[2:]) || '@a@b'][event_id % 7 + 1] AS stream, event_id % 7 IN (0, 5) AS ok FROM ev"""),
    "envelope": (envelope, f"""WITH {sql.RAW} SELECT stream, raw AS data, ms AS timestamp_ms,
      sha256(stream || '~' || event_id) AS message_id, 'binance-websocket' AS source, '1.0' AS version {_RPUB}"""),
    "envelope_json": (envelope_json, f"WITH {sql.RAW} SELECT frame_id, {_MESSAGE_JSON} AS json {_RPUB}"),
    "parse_envelope_ts": (parse_envelope_ts, f"""WITH {sql.EV} SELECT event_id,
      CASE WHEN k % 5 < 2 THEN us WHEN k % 5 = 2 THEN us // 1000000 * 1000000
           WHEN k % 5 = 3 THEN us // 86400000000 * 86400000000 END AS ts_us FROM ev"""),
    "format_envelope_ts": (format_envelope_ts, f"""WITH {sql.EV} SELECT event_id,
      CASE WHEN k % 2 = 0 OR us % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
           ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS text FROM ev"""),
    "message_id": (message_id, f"""WITH {sql.FR} SELECT frame_id, sha256(stream || '~' || event_id) AS stable_id,
      CAST(36 AS BIGINT) AS random_id_length {_PUB}"""),
    "trace_context": (trace_context, f"""WITH {sql.FR} SELECT frame_id,
      CASE WHEN event_id % 2 = 0 THEN '00-' || event_id END AS traceparent,
      CASE WHEN event_id % 2 = 0 THEN '{{"traceparent":"00-' || event_id || '"}}' END AS published_trace {_PUB}"""),
    "backoff_schedule": (backoff_schedule, f"""WITH {sql.EV}, s AS (
      SELECT event_id, k % 10 + 1 AS delay, unnest(range(event_id % 12)) AS attempt FROM ev)
      SELECT event_id, CAST(attempt AS INTEGER) AS attempt, CAST(delay * pow(2, attempt) AS DOUBLE) AS wait_seconds FROM s"""),
    "subject_build": (subject_build, f"""WITH {sql.COMPLETIONS} SELECT event_id,
      'binance.extraction.' || extraction_type || '.' || symbol || '.' || period AS single,
      'binance.extraction.' || extraction_type || '.batch.' || period AS batch FROM comp"""),
    "klines_typed": (klines_typed, f"""WITH {sql.EV} SELECT event_id AS frame_id, sym AS symbol,
      CASE WHEN event_id % 8 = 0 THEN '1h' ELSE '5m' END AS interval, ms - ms % 60000 AS open_time_ms,
      ms - ms % 60000 + 59999 AS close_time_ms, p AS open, p + 1 AS close, p + 2 AS high, p AS low, k + 1 AS volume,
      k + 1 AS trade_count, event_id % 2 = 0 AS is_closed FROM ev WHERE event_type = 'signup' AND event_id % 4 = 0"""),
    "mark_prices_typed": (mark_prices_typed, f"""WITH {sql.EV} SELECT event_id AS frame_id, ms AS event_time_ms, sym AS symbol,
      p + 1 AS mark_price, p AS index_price, 0.0001 AS funding_rate, ms AS next_funding_time_ms
      FROM ev WHERE event_type = 'signup' AND event_id % 4 = 1"""),
    "funding_typed": (funding_typed, f"""WITH {sql.EV} SELECT event_id AS frame_id, ms AS event_time_ms, sym AS symbol,
      -0.0003 AS funding_rate, ms AS funding_time_ms FROM ev WHERE event_type = 'signup' AND event_id % 4 = 2"""),
    "trades_typed": (trades_typed, f"""WITH {sql.FR} SELECT ms AS event_time_ms, sym AS symbol, event_id AS trade_id,
      CAST(p AS {_NUMBERS}) AS price, CAST(k + 1 AS {_NUMBERS}) AS quantity, user_id AS buyer_order_id,
      event_id % 97 AS seller_order_id, ms AS trade_time_ms, event_id % 2 = 0 AS is_buyer_maker, true AS ignore_flag
      FROM cl WHERE event_type = 'purchase'"""),
    "tickers_typed": (tickers_typed, f"""WITH {sql.FR} SELECT ms AS event_time_ms, sym AS symbol,
      """ + ", ".join(f"CAST(NULL AS {_NUMBERS}) AS {c}" for c in (
        "price_change", "price_change_pct", "weighted_avg", "prev_close", "last_qty", "bid", "bid_qty", "ask",
        "ask_qty", "high", "low", "quote_volume")) + f""",
      CAST(p AS {_NUMBERS}) AS last_price, CAST(p + 1 AS {_NUMBERS}) AS open, CAST(k + 1 AS {_NUMBERS}) AS base_volume,
      CAST(NULL AS BIGINT) AS open_time_ms, CAST(NULL AS BIGINT) AS close_time_ms,
      CAST(NULL AS BIGINT) AS first_id, CAST(NULL AS BIGINT) AS last_id, k + 1 AS trade_count
      FROM cl WHERE event_type = 'view'"""),
    "depth_typed": (depth_typed, f"""WITH {sql.FR} SELECT ms AS event_time_ms, sym AS symbol, event_id AS first_update_id,
      event_id + 1 AS last_update_id, p || ':' || (k + 1) AS bids,
      CAST(p + 1 AS DECIMAL(18,2)) || ':' || (k + 1) || ',' || CAST(p + 2 AS DECIMAL(18,2)) || ':' || (k + 2) AS asks
      FROM cl WHERE event_type = 'click'"""),
    "book_typed": (book_typed, f"""WITH {sql.FR} SELECT frame_id, stream, event_id AS last_update_id,
      CAST(1 AS BIGINT) AS bid_levels, true AS no_asks {_PUB} AND event_type = 'error'"""),
    "book_levels": (book_levels, f"""WITH {sql.FR}
      SELECT frame_id, 'bid' AS side, 0 AS level, CAST(p AS {_NUMBERS}) AS price, CAST(k + 1 AS {_NUMBERS}) AS quantity
      {_PUB} AND event_type IN ('click', 'error')
      UNION ALL SELECT frame_id, 'ask', n, CAST(p + n + 1 AS {_NUMBERS}), CAST(k + 1 + n AS {_NUMBERS})
      FROM cl CROSS JOIN (VALUES (0), (1)) AS t(n) WHERE event_type = 'click'"""),
}
