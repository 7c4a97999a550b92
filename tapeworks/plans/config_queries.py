"""Queries over configuration changes and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks.operators import config_log, config_rules
from tapeworks.plans import inputs, sql

BASE = ("btcusdt@trade", " ethusdt@ticker")


def subscriptions_current(spark, d):
    current = config_log.subscriptions_current(inputs.config_log(spark, d), BASE)
    return current.withColumn("pos", F.col("pos").cast("bigint"))


def settings_current(spark, d):
    return config_log.settings_current(inputs.config_log(spark, d))


def _validated(spark, d):
    return config_rules.validate_config(inputs.config_requests(spark, d))


def config_validation(spark, d):
    listed = lambda f: F.array_join(F.transform("errors", lambda e: e[f]), ",")
    return _validated(spark, d).select(
        "event_id",
        "validation_passed",
        listed("field").alias("fields"),
        listed("code").alias("codes"),
        "risk_level",
        "affected_scope",
    )


def suggested_fixes(spark, d):
    return _validated(spark, d).select("event_id", F.posexplode("suggested_fixes").alias("pos", "fix"))


def request_ranges(spark, d):
    k = F.col("k")
    requests = inputs.events(spark, d).select(
        "event_id",
        F.when(k % 11 != 0, k * 4).alias("reconnect_delay"),
        (k + 3).alias("max_reconnect_attempts"),
        (k / F.lit(8.0)).alias("backoff_multiplier"),
        k.alias("failure_threshold"),
        (k * 8).alias("recovery_timeout"),
        (k % 13).alias("half_open_max_calls"),
    )
    return config_rules.request_ranges(requests, ("reconnect_delay", "changed_by")).select(
        "event_id",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("out_of_range", ",").alias("out_of_range"),
        F.col("error_count").cast("bigint").alias("error_count"),
    )


def update_outcome(spark, d):
    k, sym = F.col("k"), F.col("sym")
    kinds = F.array(*[F.lit(t) for t in ("streams", "reconnection", "circuit_breaker")])
    good = F.concat(F.lower(sym), F.lit("@trade"))
    requests = inputs.events(spark, d).select(
        "event_id",
        "k",
        F.get(kinds, (k % 3).cast("int")).alias("config_type"),
        F.when(k % 4 == 0, F.array(good, F.concat(sym, F.lit("@x")), F.lit("bad"))).otherwise(F.array(good)).alias("streams"),
        (F.col("event_id") % 2 == 0).alias("validate_only"),
    )
    return config_rules.update_outcome(requests, in_range=k.between(1, 80)).select(
        "event_id", "outcome", "success", "message"
    )


_STREAMS = """CASE WHEN change = 'set' AND event_id % 2 = 0 THEN [s0, s1, s0] ELSE [s0] END"""
_LOG = "WITH RECURSIVE " + sql.EV + f""", lg AS (
  SELECT event_id AS seq, 'user-' || user_id AS scope, k, event_type,
    CASE event_type WHEN 'signup' THEN 'set' WHEN 'purchase' THEN 'add' WHEN 'view' THEN 'add' ELSE 'remove' END AS change,
    lower(sym) || '@' || ['trade','ticker','kline_1h'][event_id % 3 + 1] AS s0,
    lower(sym) || '@' || ['trade','ticker','kline_1h'][(event_id + 1) % 3 + 1] AS s1, event_id FROM ev),
  ops AS (SELECT scope, seq, change, s0, {_STREAMS} AS streams,
    row_number() OVER (PARTITION BY scope ORDER BY seq) AS rn FROM lg WHERE k % 4 >= 2)"""

_CASES = sql.EV + """, rq AS (
  SELECT event_id, k, sym, k % 6 AS c,
    ['streams','reconnection','circuit_breaker','other'][event_id % 4 + 1] AS kind FROM ev), er AS (
  SELECT *, CASE kind
    WHEN 'streams' THEN CASE c
      WHEN 1 THEN [('streams', 'INVALID_FORMAT', lower(sym) || '@trade'), ('streams', 'INVALID_FORMAT', 'bad')]
      WHEN 2 THEN [('streams', 'INVALID_TYPE', '[]')]
      WHEN 3 THEN [('streams', 'INVALID_TYPE', '5'), ('streams', 'INVALID_TYPE', 'True'), ('streams', 'INVALID_TYPE', 'None')]
      WHEN 5 THEN [('streams', 'INVALID_FORMAT', NULL)] END
    WHEN 'reconnection' THEN CASE c
      WHEN 0 THEN list_filter([
        CASE WHEN k NOT BETWEEN 1 AND 300 THEN ('reconnect_delay', 'OUT_OF_RANGE', '5') END,
        CASE WHEN k + 40 NOT BETWEEN 1 AND 100 THEN ('max_reconnect_attempts', 'OUT_OF_RANGE', '10') END], lambda x: x IS NOT NULL)
      WHEN 1 THEN [('reconnect_delay', 'OUT_OF_RANGE', '5'), ('max_reconnect_attempts', 'OUT_OF_RANGE', '10')]
      WHEN 2 THEN [('reconnect_delay', 'INVALID_TYPE', '5')]
      WHEN 3 THEN [('reconnect_delay', 'INVALID_TYPE', '5')]
      WHEN 4 THEN [('max_reconnect_attempts', 'OUT_OF_RANGE', '10')] END
    WHEN 'circuit_breaker' THEN CASE c
      WHEN 0 THEN list_filter([
        CASE WHEN k NOT BETWEEN 1 AND 50 THEN ('failure_threshold', 'OUT_OF_RANGE', '5') END,
        CASE WHEN k * 10 NOT BETWEEN 10 AND 600 THEN ('recovery_timeout', 'OUT_OF_RANGE', '60') END], lambda x: x IS NOT NULL)
      WHEN 1 THEN [('failure_threshold', 'INVALID_TYPE', '5'), ('recovery_timeout', 'INVALID_TYPE', '60')]
      WHEN 2 THEN [('failure_threshold', 'OUT_OF_RANGE', '5')]
      WHEN 3 THEN [('recovery_timeout', 'OUT_OF_RANGE', '60')]
      WHEN 4 THEN CASE WHEN k NOT BETWEEN 1 AND 50 THEN [('failure_threshold', 'OUT_OF_RANGE', '5')] END
      WHEN 5 THEN CASE WHEN k * 8 NOT BETWEEN 10 AND 600 THEN [('recovery_timeout', 'OUT_OF_RANGE', '60')] END END
    ELSE [('config_type', 'INVALID_VALUE', 'streams')] END AS raw_errors FROM rq), ve AS (
  SELECT *, coalesce(raw_errors, []) AS errors FROM er)"""

QUERIES = {
    "subscriptions_current": (subscriptions_current, f"""{_LOG}, steps AS (
      SELECT scope, 0::BIGINT AS rn, ['btcusdt@trade', ' ethusdt@ticker'] AS list FROM (SELECT DISTINCT scope FROM lg)
      UNION ALL
      SELECT o.scope, o.rn, CASE o.change WHEN 'set' THEN o.streams
        WHEN 'add' THEN CASE WHEN list_contains(s.list, o.s0) THEN s.list ELSE list_append(s.list, o.s0) END
        ELSE CASE WHEN list_contains(s.list, o.s0)
          THEN s.list[1:list_position(s.list, o.s0) - 1] || s.list[list_position(s.list, o.s0) + 1:] ELSE s.list END END
      FROM steps s JOIN ops o ON o.scope = s.scope AND o.rn = s.rn + 1), final AS (
      SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY scope ORDER BY rn DESC) = 1)
      SELECT scope, unnest(range(len(list))) AS pos, unnest(list) AS stream FROM final"""),
    "settings_current": (settings_current, f"""WITH {sql.EV}, s AS (
      SELECT 'user-' || user_id AS scope, CASE k % 4 WHEN 0 THEN 'reconnection' ELSE 'circuit_breaker' END AS config_type,
        CASE k % 4 WHEN 0 THEN '{{"reconnect_delay":' || (k + 1) || '}}' ELSE '{{"failure_threshold":' || (k % 50 + 1) || '}}' END AS parameters,
        event_type AS changed_by, 'ticket ' || k AS reason, event_id AS seq FROM ev WHERE k % 4 < 2)
      SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY scope, config_type ORDER BY seq DESC) = 1"""),
    "config_validation": (config_validation, f"""WITH {_CASES}
      SELECT event_id, len(errors) = 0 AS validation_passed,
        coalesce(array_to_string(list_transform(errors, lambda e: e[1]), ','), '') AS fields,
        coalesce(array_to_string(list_transform(errors, lambda e: e[2]), ','), '') AS codes,
        CASE kind WHEN 'streams' THEN 'low' WHEN 'reconnection' THEN 'low' WHEN 'circuit_breaker' THEN 'medium' END AS risk_level,
        CASE kind WHEN 'streams' THEN [1, 2, 3, 3, 0, 1][c + 1] || ' streams' WHEN 'reconnection' THEN 'reconnection behavior'
          WHEN 'circuit_breaker' THEN 'circuit breaker behavior' END AS affected_scope FROM ve"""),
    "suggested_fixes": (suggested_fixes, f"""WITH {_CASES}, fx AS (
      SELECT event_id, list_transform(list_filter(errors, lambda e: e[3] IS NOT NULL), lambda e: 'Set ' || e[1] || ' to ' || e[3]) AS fixes FROM ve)
      SELECT event_id, CAST(unnest(range(len(fixes))) AS INTEGER) AS pos, unnest(fixes) AS fix FROM fx"""),
    "request_ranges": (request_ranges, f"""WITH {sql.EV}, f AS (SELECT event_id, list_filter([
        CASE WHEN k % 11 <> 0 AND k * 4 NOT BETWEEN 1 AND 300 THEN 'reconnect_delay' END,
        CASE WHEN k + 3 NOT BETWEEN 1 AND 100 THEN 'max_reconnect_attempts' END,
        CASE WHEN k / 8.0 NOT BETWEEN 1 AND 10 THEN 'backoff_multiplier' END,
        CASE WHEN k NOT BETWEEN 1 AND 50 THEN 'failure_threshold' END,
        CASE WHEN k * 8 NOT BETWEEN 10 AND 600 THEN 'recovery_timeout' END,
        CASE WHEN k % 13 NOT BETWEEN 1 AND 10 THEN 'half_open_max_calls' END], lambda x: x IS NOT NULL) AS bad,
        CASE WHEN k % 11 = 0 THEN ['reconnect_delay', 'changed_by'] ELSE ['changed_by'] END AS gone FROM ev)
      SELECT event_id, coalesce(array_to_string(bad, ','), '') AS out_of_range, array_to_string(gone, ',') AS missing,
        len(bad) + len(gone) AS error_count FROM f"""),
    "update_outcome": (update_outcome, f"""WITH {sql.EV}, u AS (
      SELECT event_id, k % 3 AS t, event_id % 2 = 0 AS dry, k % 3 = 0 AND k % 4 = 0 AS bad_stream,
        k % 3 <> 0 AND k NOT BETWEEN 1 AND 80 AS bad_range, sym FROM ev)
      SELECT event_id, CASE WHEN bad_stream OR bad_range THEN 'rejected' WHEN dry THEN 'validated' ELSE 'applied' END AS outcome,
        NOT bad_range AND (NOT bad_stream OR dry) AS success,
        CASE WHEN bad_stream THEN 'Invalid stream format: ' || sym || '@x' || CASE WHEN dry THEN ' (validate_only=true)' ELSE '' END
          WHEN bad_range THEN 'Field out of range'
          ELSE ['Streams', 'Reconnection config', 'Circuit breaker config'][t + 1] ||
            CASE WHEN dry THEN CASE t WHEN 0 THEN ' are' ELSE ' is' END || ' valid but not saved (validate_only=true)'
                 ELSE ' updated' END END AS message FROM u"""),
}
