"""Common table expressions the SQL counterparts of the queries start from.

They give what each event's frame should turn into straight from the event's
columns, without any JSON being parsed.
"""

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us,
         ['BTCUSDT','ETHUSDT','BNBUSDT','SOLUSDT','ADAUSDT'][user_id % 5 + 1] AS sym,
         CAST(value AS DECIMAL(18,2)) AS p,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events)"""

FR = EV + """, fr AS (
  SELECT *, event_id AS frame_id, lower(sym) AS ls,
    CASE WHEN event_type = 'error' AND event_id % 8 = 0 THEN 'malformed'
         WHEN event_type = 'error' AND event_id % 8 IN (1, 2) THEN 'other_json'
         ELSE 'object' END AS shape,
    CASE event_type
      WHEN 'purchase' THEN lower(sym) || '@trade'
      WHEN 'view' THEN lower(sym) || '@ticker'
      WHEN 'click' THEN lower(sym) || '@depth20@100ms'
      WHEN 'signup' THEN lower(sym) || ['@kline','@markPrice@1s','@fundingRate@1s','@aggTrade'][event_id % 4 + 1]
      ELSE CASE event_id % 8 WHEN 5 THEN 'btcusdt@depth20@100ms'
                             WHEN 6 THEN lower(sym) || '@depth20@100ms' END END AS stream
  FROM ev), cl AS (
  SELECT *, CASE WHEN shape = 'malformed' THEN 'malformed_json'
                 WHEN shape = 'other_json' THEN 'invalid_format'
                 WHEN stream IS NULL THEN 'unknown_stream'
                 ELSE 'published' END AS disposition
  FROM fr)"""

# The same with the text of each frame.
RAW = FR + """, rw AS (
  SELECT *, CASE event_type
    WHEN 'purchase' THEN '{"e":"trade","E":' || ms || ',"s":"' || sym || '","t":' || event_id ||
      ',"p":"' || p || '","q":"' || (k + 1) || '","b":' || user_id || ',"a":' || (event_id % 97) ||
      ',"T":' || ms || ',"m":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || ',"M":true}'
    WHEN 'view' THEN '{"e":"24hrTicker","E":' || ms || ',"s":"' || sym || '","c":"' || p || '","o":"' ||
      CAST(p + 1.00 AS DECIMAL(18,2)) || '","v":"' || (k + 1) || '","n":' || (k + 1) || '}'
    WHEN 'click' THEN '{"e":"depthUpdate","E":' || ms || ',"s":"' || sym || '","U":' || event_id ||
      ',"u":' || (event_id + 1) || ',"b":[["' || p || '","' || (k + 1) || '"]],"a":[["' ||
      CAST(p + 1.00 AS DECIMAL(18,2)) || '","' || (k + 1) || '"],["' ||
      CAST(p + 2.00 AS DECIMAL(18,2)) || '","' || (k + 2) || '"]]}'
    WHEN 'signup' THEN '{"e":"' || ['kline','markPriceUpdate','fundingRate','aggTrade'][event_id % 4 + 1] ||
      '","E":' || ms || ',"s":"' || sym || '"' || CASE event_id % 4
        WHEN 0 THEN ',"k":{"t":' || (ms - ms % 60000) || ',"T":' || (ms - ms % 60000 + 59999) || ',"s":"' || sym || '","i":"' ||
          CASE WHEN event_id % 8 = 0 THEN '1h' ELSE '5m' END || '","o":"' || p || '","c":"' || CAST(p + 1.00 AS DECIMAL(18,2)) ||
          '","h":"' || CAST(p + 2.00 AS DECIMAL(18,2)) || '","l":"' || p || '","v":"' || (k + 1) || '","n":' || (k + 1) ||
          ',"x":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || '}'
        WHEN 1 THEN ',"p":"' || CAST(p + 1.00 AS DECIMAL(18,2)) || '","i":"' || p || '","r":"0.0001","T":' || ms
        WHEN 2 THEN ',"r":"-0.0003","T":' || ms ELSE '' END || '}'
    ELSE CASE event_id % 8
      WHEN 0 THEN '{"e":"trade","s":'
      WHEN 1 THEN '[1,2]'
      WHEN 2 THEN 'null'
      WHEN 3 THEN '{"s":"' || sym || '"}'
      WHEN 4 THEN '{"e":"trade","s":null}'
      WHEN 5 THEN '{"lastUpdateId":' || event_id || ',"bids":[["' || p || '","' || (k + 1) || '"]],"asks":null}'
      WHEN 6 THEN '{"lastUpdateId":' || event_id || ',"bids":[["' || p || '","' || (k + 1) || '"]],"asks":null,"s":"' || sym || '"}'
      ELSE '{"stream":"btcusdt@trade","data":{"e":"trade","s":"BTCUSDT"}}' END END AS raw
  FROM cl)"""

# Counts per heartbeat interval of an hour, every interval from first to last.
BEAT = FR + """, agg AS (
  SELECT ms // 3600000 AS slot,
         count(*) FILTER (disposition = 'published') AS n,
         max(ms) FILTER (shape <> 'malformed') AS last_ms
  FROM cl GROUP BY 1), spine AS (
  SELECT unnest(generate_series(a, b)) AS slot, a AS origin
  FROM (SELECT min(slot) AS a, max(slot) AS b FROM agg)), beat AS (
  SELECT (slot + 1) * 3600000 AS tick_ms,
         coalesce(n, 0) AS processed_since_last, 0 AS dropped_since_last,
         CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS total_processed, 0 AS total_dropped,
         (slot + 1 - origin) * 3600000 AS uptime_ms,
         coalesce((slot + 1) * 3600000 - max(last_ms) OVER w, 0) AS ms_since_last_message
  FROM spine LEFT JOIN agg USING (slot)
  WINDOW w AS (ORDER BY slot))"""

# Histories, some without a key and some rows without a time.
SYMBOLS_BY_TIME = """hist AS (
  SELECT * REPLACE (CASE WHEN event_id % 50 <> 0 THEN sym END AS sym, CASE WHEN event_id % 51 <> 0 THEN us END AS us) FROM ev),
  ordered AS (
  SELECT *, row_number() OVER (PARTITION BY sym ORDER BY us, event_id) AS rn FROM hist WHERE us IS NOT NULL)"""
# Breaker with threshold 3 and recovery of an hour, stepped row by row.
BREAKER = "WITH RECURSIVE " + EV + ", " + SYMBOLS_BY_TIME + """, steps AS (
  SELECT sym, 0::BIGINT AS rn, 0::BIGINT AS event_id, 0::BIGINT AS us, true AS ok, 'closed' AS state_before,
         'closed' AS state_after, '' AS result, 0::BIGINT AS failure_count, NULL::BIGINT AS failed_us
  FROM (SELECT DISTINCT sym FROM ordered)
  UNION ALL
  SELECT o.sym, o.rn, o.event_id, o.us, o.event_type <> 'error', s.state_after,
    CASE WHEN s.state_after = 'open' AND o.us - s.failed_us < 3600000000 THEN 'open'
         WHEN o.event_type <> 'error' THEN 'closed'
         WHEN s.failure_count + 1 >= 3 THEN 'open' ELSE s.state_after END,
    CASE WHEN s.state_after = 'open' AND o.us - s.failed_us < 3600000000 THEN 'rejected'
         WHEN o.event_type <> 'error' THEN 'ok' ELSE 'failed' END,
    CASE WHEN s.state_after = 'open' AND o.us - s.failed_us < 3600000000 THEN s.failure_count
         WHEN o.event_type <> 'error' THEN 0 ELSE s.failure_count + 1 END,
    CASE WHEN s.state_after = 'open' AND o.us - s.failed_us < 3600000000 THEN s.failed_us
         WHEN o.event_type <> 'error' THEN s.failed_us ELSE o.us END
  FROM steps s JOIN ordered o ON o.sym IS NOT DISTINCT FROM s.sym AND o.rn = s.rn + 1)"""

# Leaky bucket for 3 messages that drains one in two hours; one message is
# 7,200,000,000 units and a microsecond drains one.
BUCKET = "WITH RECURSIVE " + EV + ", " + SYMBOLS_BY_TIME + """, steps AS (
  SELECT sym, 0::BIGINT AS rn, 0::BIGINT AS event_id, 0::BIGINT AS us, false AS dropped, 0::BIGINT AS backlog_units
  FROM (SELECT DISTINCT sym FROM ordered)
  UNION ALL
  SELECT o.sym, o.rn, o.event_id, o.us,
    greatest(0, s.backlog_units - (o.us - s.us)) + 7200000000 > 21600000000,
    greatest(0, s.backlog_units - (o.us - s.us)) +
      CASE WHEN greatest(0, s.backlog_units - (o.us - s.us)) + 7200000000 > 21600000000 THEN 0 ELSE 7200000000 END
  FROM steps s JOIN ordered o ON o.sym IS NOT DISTINCT FROM s.sym AND o.rn = s.rn + 1)"""

# Hourly and daily candles.
CANDLES = EV + """, candles AS (
  SELECT sym AS symbol, period, ms // step * step AS open_ms, ms // step * step + step - 1 AS close_ms,
         arg_min(p, (ms, event_id)) AS open, max(p) AS high, min(p) AS low, arg_max(p, (ms, event_id)) AS close,
         CAST(sum(k + 1) AS BIGINT) AS volume, sum(p * (k + 1)) AS quote_volume, count(*) AS trade_count,
         CAST(coalesce(sum(k + 1) FILTER (event_id % 2 = 1), 0) AS BIGINT) AS taker_buy_volume,
         coalesce(sum(p * (k + 1)) FILTER (event_id % 2 = 1), 0) AS taker_buy_quote_volume
  FROM ev CROSS JOIN (VALUES ('1h', 3600000), ('1d', 86400000)) AS t(period, step)
  WHERE event_type = 'purchase'
  GROUP BY sym, period, step, ms // step)"""

GAPS = CANDLES + """, slots AS (
  SELECT symbol, period, close_ms - open_ms + 1 AS step, unnest(generate_series(min(open_ms), max(open_ms), close_ms - open_ms + 1)) AS open_ms
  FROM candles GROUP BY symbol, period, close_ms - open_ms + 1), missing AS (
  SELECT s.* FROM slots s ANTI JOIN candles c USING (symbol, period, open_ms)), islands AS (
  SELECT *, open_ms // step - row_number() OVER (PARTITION BY symbol, period ORDER BY open_ms) AS island
  FROM missing), gaps AS (
  SELECT symbol, period, min(open_ms) AS gap_start_ms, max(open_ms) AS gap_end_ms, count(*) AS missing
  FROM islands GROUP BY symbol, period, island)"""

COMPLETIONS = EV + """, comp AS (
  SELECT event_id, ts, CASE WHEN event_type = 'view' THEN 'klines_gap_filling' ELSE 'klines' END AS extraction_type,
         sym AS symbol, ['15m','1h','1d'][k % 3 + 1] AS period, event_type <> 'error' AS success,
         k * 10 AS records_fetched, CASE WHEN event_type = 'error' THEN 0 ELSE k * 10 END AS records_written,
         p AS duration_seconds, k % 4 AS gaps_found, CASE WHEN event_type = 'error' THEN 0 ELSE k % 4 END AS gaps_filled,
         CASE WHEN event_type <> 'error' THEN CAST([] AS VARCHAR[])
              WHEN event_id % 2 = 0 THEN ['API rate limit exceeded']
              ELSE ['API rate limit exceeded', 'Connection timeout'] END AS errors, k
  FROM ev)"""
