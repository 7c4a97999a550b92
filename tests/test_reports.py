"""Metrics, configuration and history on small literal inputs."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from tapeworks.functions import numbers
from tapeworks.operators import config_log, config_rules, history, metrics

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T0_MS = 1704067200000


def classified(spark, rows):
    return spark.createDataFrame(
        [(T0 + timedelta(seconds=s), shape, disposition, stream) for s, shape, disposition, stream in rows],
        "recv_ts timestamp, shape string, disposition string, stream string",
    )


def frames(spark):
    ok = [(i * 0.5, "object", "published", "a@trade") for i in range(100)]
    lost = [(i, "object", "not_connected", "a@trade") for i in range(5)]
    late = [(200, "other_json", "invalid_format", None), (205, "malformed", "malformed_json", None)]
    return classified(spark, ok + lost + late)


def test_heartbeat_reports_empty_intervals(spark):
    report = metrics.heartbeat_report(frames(spark), 60).orderBy("tick_ms").collect()
    assert [r.tick_ms - T0_MS for r in report] == [60000, 120000, 180000, 240000]
    assert [r.processed_since_last for r in report] == [100, 0, 0, 0]
    assert [r.dropped_since_last for r in report] == [5, 0, 0, 0]
    assert [r.messages_per_second for r in report] == [1.67, 0.0, 0.0, 0.0]
    assert [r.overall_rate_per_second for r in report] == [1.67, 0.83, 0.56, 0.42]
    # The last frame that could be parsed counts, routable or not.
    assert [r.ms_since_last_message for r in report] == [10500, 70500, 130500, 40000]


def test_heartbeat_over_a_given_range(spark):
    report = metrics.heartbeat_report(frames(spark), 30, T0_MS - 30000, T0_MS + 60000).orderBy("tick_ms").collect()
    assert [r.tick_ms - T0_MS for r in report] == [0, 30000, 60000]
    assert [r.total_processed for r in report] == [0, 60, 100]
    assert report[0].ms_since_last_message == 0


def test_heartbeats_since_a_wrong_clock(spark):
    """A frame of 1970 makes half a million hours of ticks, which are made in pieces."""
    rows = frames(spark).unionByName(classified(spark, [(-T0_MS / 1000, "object", "published", "a@trade")]))
    report = metrics.heartbeat_report(rows, 3600)
    ends = report.agg(F.count("*"), F.countDistinct("tick_ms"), F.min("tick_ms"), F.max("tick_ms"), F.sum("processed_since_last"), F.max("total_processed"))
    assert tuple(ends.first()) == (T0_MS // 3600000 + 1, T0_MS // 3600000 + 1, 3600000, T0_MS + 3600000, 101, 101)
    assert metrics.heartbeat_report(rows, 3600, T0_MS, T0_MS - 7200000).count() == 0


def test_running_totals_and_snapshot(spark):
    totals = metrics.running_totals(frames(spark), 10).orderBy("interval_start_ms").collect()
    assert [r.total_processed for r in totals][:5] == [20, 40, 60, 80, 100]
    assert totals[-1].total_dropped == 5
    row = metrics.metrics_snapshot(frames(spark), ["a", "b"], T0_MS, T0_MS + 300000, queue_size=45).first()
    assert (row.processed_messages, row.dropped_messages, row.stream_count) == (100, 5, 2)
    assert (row.messages_per_second, row.queue_utilization_percent) == (0.33, 0.9)
    assert row.ms_since_last_message == 100000
    assert row.connection_status == "connected"


def test_snapshot_without_frames(spark):
    row = metrics.metrics_snapshot(frames(spark).limit(0), start_ms=T0_MS, report_ms=T0_MS, capacity=0).first()
    assert (row.processed_messages, row.messages_per_second, row.queue_utilization_percent) == (0, 0.0, 0.0)
    assert row.ms_since_last_message is None


def test_heartbeat_subjects(spark):
    ticks = spark.createDataFrame([(T0_MS, "own", "env"), (T0_MS, "", "env"), (T0_MS, None, None)], "tick_ms bigint, a string, b string")
    records = metrics.heartbeat_records(ticks, "feed", F.col("a"), F.col("b"), last_ping=F.lit(None).cast("long"), queue_size=F.lit(3)).collect()
    assert [r.subject for r in records] == ["own", "env", "heartbeat.feed"]
    assert records[0].value == (
        '{"service":"feed","timestamp":1704067200.000,"version":"1.0.0","status":"healthy","queue_size":3}'
    )


def test_alerts(spark):
    rows = [(1500.0, 0, 10.0, True, 0), (999.0, 3, 80.0, False, 1000)]
    table = spark.createDataFrame(rows, "rate double, dropped bigint, queue double, up boolean, stale bigint")
    alerts = metrics.health_alerts(table, F.col("rate"), F.col("dropped"), F.col("queue"), F.col("up"), F.col("stale"))
    assert [r.alerts for r in alerts.collect()] == [[], ["low_rate", "dropped_messages", "queue_full", "disconnected", "stale"]]


def test_backoff(spark):
    waits = spark.range(1).select(numbers.backoff_schedule()).first()[0]
    assert waits == [5.0 * 2**i for i in range(10)] and sum(waits) == 5115
    assert spark.range(1).select(numbers.backoff_schedule(5, 0)).first()[0] == []


def changes(spark, rows):
    return spark.createDataFrame(
        [("s", i, op, parameters) for i, (op, parameters) in enumerate(rows)],
        "scope string, seq bigint, op string, parameters string",
    )


def current(spark, rows, base=()):
    found = config_log.subscriptions_current(changes(spark, rows), base).orderBy("pos").collect()
    return [r.stream for r in found]


def test_subscription_changes(spark):
    put = lambda *s: ("set", '{"streams":[%s]}' % ",".join(f'"{x}"' for x in s))
    add, remove = (lambda s: ("add", f'{{"stream":"{s}"}}')), (lambda s: ("remove", f'{{"stream":"{s}"}}'))
    assert current(spark, [put("a", "b", "a")]) == ["a", "b", "a"]
    assert current(spark, [put("a", "b", "a"), remove("a")]) == ["b", "a"]
    assert current(spark, [put("a", "b", "a"), remove("a"), add("a"), add("c")]) == ["b", "a", "c"]
    assert current(spark, [put("a", "b", "a"), remove("a"), remove("a"), add("a")]) == ["b", "a"]
    assert current(spark, [add("x"), put("a"), remove("a"), remove("a"), add("b"), add("a"), add("a")]) == ["b", "a"]
    assert current(spark, [add("x"), remove("y"), add("x"), remove("x"), add("z"), add("x")], ["y", "y"]) == ["y", "z", "x"]
    assert current(spark, [put("a"), put()]) == []


def test_config_validation_messages(spark):
    cases = [
        ("reconnection", '{"reconnect_delay":301}', ["Must be between 1 and 300 seconds"], ["Set reconnect_delay to 5"]),
        ("reconnection", '{"max_reconnect_attempts":5.0}', ["Must be an integer"], ["Set max_reconnect_attempts to 10"]),
        ("reconnection", '{"backoff_multiplier":-1}', [], []),
        ("circuit_breaker", '{"recovery_timeout":5}', ["Must be between 10 and 600 seconds"], ["Set recovery_timeout to 60"]),
        ("circuit_breaker", '{"failure_threshold":true}', [], []),
        ("streams", '{"streams":["INVALID"]}', ["Invalid stream format: INVALID"], ["Set streams to invalid"]),
        ("streams", '{"streams":[1.5]}', ["Stream must be a string, got float"], ["Set streams to 1.5"]),
        ("streams", '{"streams":{"a":1}}', ["Streams must be a list"], ["Set streams to []"]),
        ("other", "{}", ["Unknown config type: other"], ["Set config_type to streams"]),
    ]
    table = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "i int, config_type string, parameters string")
    for r in config_rules.validate_config(table).collect():
        _, _, messages, fixes = cases[r.i]
        assert [e.message for e in r.errors] == messages, cases[r.i]
        assert r.suggested_fixes == fixes
        assert r.validation_passed == (not messages)
        assert r.warnings == [] and r.conflicts == []


def test_streams_without_a_length_fail_internally(spark):
    table = spark.createDataFrame([("streams", p) for p in ('{"streams":null}', '{"streams":5}')], "config_type string, parameters string")
    assert [(r.validation_passed, r.errors) for r in config_rules.validate_config(table).collect()] == [(None, None)] * 2


def trades(spark, rows):
    return spark.createDataFrame(
        [("BTC", i, Decimal(p), Decimal(q), T0 + timedelta(seconds=s), maker) for i, (s, p, q, maker) in enumerate(rows)],
        "symbol string, trade_id bigint, price decimal(38,18), quantity decimal(38,18), trade_time timestamp, is_buyer_maker boolean",
    )


def test_candles_roll_up(spark):
    made = trades(spark, [(0, "10", "1", True), (0, "12", "2", False), (299, "9", "1", False), (300, "11", "1", True), (3600, "8", "1", True)])
    got = {(r.period, r.open_ms - T0_MS): r for r in history.candles(made, ("5m", "1h")).collect()}
    assert set(got) == {("5m", 0), ("5m", 300000), ("5m", 3600000), ("1h", 0), ("1h", 3600000)}
    hour = got["1h", 0]
    assert [int(v) for v in (hour.open, hour.high, hour.low, hour.close, hour.volume, hour.quote_volume)] == [10, 12, 9, 11, 5, 54]
    assert (hour.trade_count, int(hour.taker_buy_volume), int(hour.taker_buy_quote_volume)) == (4, 3, 33)
    assert hour.close_ms - hour.open_ms == 3599999


def test_gaps_inside_and_at_the_edges(spark):
    made = trades(spark, [(s * 300, "1", "1", True) for s in (2, 3, 6, 9)])
    candles = history.candles(made, ("5m",))
    slots = lambda gaps: sorted(((r.gap_start_ms - T0_MS) // 300000, (r.gap_end_ms - T0_MS) // 300000, r.missing) for r in gaps.collect())
    assert slots(history.candle_gaps(candles)) == [(4, 5, 2), (7, 8, 2)]
    ranged = history.candle_gaps(candles, T0_MS, T0_MS + 12 * 300000)
    assert slots(ranged) == [(0, 1, 2), (4, 5, 2), (7, 8, 2), (10, 11, 2)]
    assert history.completeness(candles, T0_MS + 3000000).first().completeness_percent == 50.0


def test_long_gaps_are_cut_into_weeks(spark):
    week = 7 * 86400 * 1000
    gaps = spark.createDataFrame([("BTC", "1d", 0, 2 * week + 5, 15)], "symbol string, period string, gap_start_ms bigint, gap_end_ms bigint, missing bigint")
    got = [(r.chunk_start_ms, r.chunk_end_ms) for r in history.gap_chunks(gaps).orderBy("chunk_start_ms").collect()]
    assert got == [(0, week - 1), (week, 2 * week - 1), (2 * week, 2 * week + 5)]
    assert history.gap_chunks(gaps, min_missing=16).count() == 0


def test_job_rollup_counts_missing_results_as_failed(spark):
    rows = [("r1", 1, "a", True, 1.5), ("r1", 1, "b", None, 2.0), ("r2", 1, "b", False, 1.0), ("r2", 2, "b", True, 1.0), ("r2", 1, "a", True, 4.0), ("r3", 1, "b", True, 1.0)]
    results = spark.createDataFrame(rows, "run_id string, attempt int, job string, success boolean, duration_seconds double")
    got = {r.run_id: (r.success, r.total_duration, r.jobs, r.job_success) for r in history.job_rollup(results, ("a", "b")).collect()}
    assert got == {
        "r1": (False, 3.5, ["a", "b"], [True, False]), "r2": (True, 6.0, ["a", "b"], [True, True]), "r3": (False, 1.0, ["a", "b"], [False, True]),
    }


def test_batch_completion_and_errors(spark):
    rows = [
        ("klines", "15m", "BTC", True, 10, 10, 1.0, 0, 0, []),
        ("klines", "15m", "ETH", False, 0, 0, 2.0, 1, 0, ["limit", "timeout"]),
        ("klines", "15m", "ETH", False, 0, 0, 2.0, 1, 0, ["limit"]),
    ]
    schema = (
        "extraction_type string, period string, symbol string, success boolean, records_fetched bigint, "
        "records_written bigint, duration_seconds double, gaps_found bigint, gaps_filled bigint, errors array<string>"
    )
    frame = spark.createDataFrame(rows, schema)
    row = history.batch_completion(frame).first()
    assert (row.success, row.symbols, row.symbols_processed) == (False, ["BTC", "ETH"], 2)
    assert row.total_errors == 3
    assert sorted((r.error, r.n) for r in history.batch_errors(frame).collect()) == [("limit", 2), ("timeout", 1)]
