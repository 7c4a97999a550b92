"""Chunked folds give what one pass over the whole history gives."""

import random
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeworks.operators import breaker, bucket, folds, intake_limits, quantile, throttle

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T0_US = 1704067200000000


def breaker_pass(rows, threshold, recovery_us):
    state, failed_at, failures, out = "closed", None, 0, []
    for us, seq, ok, counted in rows:
        before = state
        if state == "open" and us - failed_at < recovery_us:
            out.append((seq, before, state, "rejected", failures))
            continue
        if state == "open":
            state = "half_open"
        if ok:
            state, failures, result = "closed", 0, "ok"
        elif counted:
            failures, failed_at, result = failures + 1, us, "failed"
            if failures >= threshold:
                state = "open"
        else:
            result = "uncounted"
        out.append((seq, before, state, result, failures))
    return out, failed_at


def bucket_pass(rows, capacity, unit, drain):
    backlog, last, out = 0, None, []
    for us, seq in rows:
        backlog = max(0, backlog - drain * (us - last)) if last is not None else 0
        dropped = backlog + unit > capacity * unit
        backlog += 0 if dropped else unit
        last = us
        out.append((seq, dropped, backlog))
    return out


def throttle_pass(rows, start_us, gap_us):
    since, done, lost, out = start_us, 0, 0, []
    for us, seq, processed in rows:
        done, lost = done + processed, lost + (not processed)
        if processed and us - since >= gap_us:
            out.append((seq, done, lost))
            since = us
    return out


def log(seed, n, span_seconds, p_fail=0.4):
    r = random.Random(seed)
    times = sorted(r.randint(0, span_seconds * 10) for _ in range(n))
    return [(T0_US + t * 100_000, i, r.random() > p_fail, r.random() > 0.1) for i, t in enumerate(times)]


def table(spark, logs):
    rows = [
        (name, T0 + timedelta(microseconds=us - T0_US), seq, ok, counted)
        for name, entries in logs.items()
        for us, seq, ok, counted in entries
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "name string, ts timestamp, seq bigint, ok boolean, counted boolean")


@pytest.fixture(scope="module")
def logs():
    # One name has most of the rows; one fails throughout; one is sparse.
    return {
        "hot": log(1, 900, 600),
        "down": log(2, 200, 600, 1.0),
        "calm": log(3, 100, 600, 0.05),
        "sparse": log(4, 12, 600),
    }


@pytest.mark.parametrize("chunk_rows", [1, 60, 10**6])
def test_breaker(spark, logs, chunk_rows):
    replayed = breaker.breaker_replay(table(spark, logs), 3, 20, counted="counted", chunk_rows=chunk_rows)
    got = {}
    for r in replayed.collect():
        got.setdefault(r.name, []).append((r.seq, r.state_before, r.state_after, r.result, r.failure_count))
    final = breaker.breaker_metrics(
        table(spark, logs), 3, 20, T0_US // 1000 + 700_000, counted="counted", chunk_rows=chunk_rows
    )
    final = {r.name: r for r in final.collect()}
    for name, entries in logs.items():
        want, failed_at = breaker_pass(entries, 3, 20_000_000)
        assert sorted(got[name]) == want
        assert (final[name].state, final[name].failure_count) == (want[-1][2], want[-1][4])
        assert final[name].last_failure_ms == (None if failed_at is None else failed_at // 1000)


def test_breaker_that_never_failed(spark):
    never = table(spark, {"a": [(T0_US, 0, True, True), (T0_US + 1, 1, False, False)]})
    row = breaker.breaker_metrics(never, 1, 10, 0, counted="counted").first()
    assert (row.state, row.failure_count, row.last_failure_ms, row.ms_since_last_failure) == ("closed", 0, None, None)


def test_breaker_sequences_of_the_contract(spark):
    second = 1_000_000
    opens = [(T0_US + i, i, False, True) for i in range(3)] + [(T0_US + 10, 3, True, True)]
    recovers = opens + [(T0_US + 60 * second + 2, 4, True, True), (T0_US + 61 * second, 5, False, True)]
    reopens = opens + [(T0_US + 60 * second + 2, 4, False, True)]
    resets = [(T0_US, 0, False, True), (T0_US + 1, 1, False, True), (T0_US + 2, 2, True, True), (T0_US + 3, 3, False, True)]
    out = breaker.breaker_replay(table(spark, {"recovers": recovers, "reopens": reopens, "resets": resets}), 3, 60)
    by_name = {}
    for r in out.orderBy("seq").collect():
        by_name.setdefault(r.name, []).append((r.result, r.state_after, r.failure_count))
    assert by_name["recovers"][2:] == [("failed", "open", 3), ("rejected", "open", 3), ("ok", "closed", 0), ("failed", "closed", 1)]
    assert by_name["reopens"][-1] == ("failed", "open", 4)
    assert by_name["resets"][-1] == ("failed", "closed", 1)


@pytest.mark.parametrize("chunk_rows", [1, 60, 10**6])
@pytest.mark.parametrize("rate,capacity", [("1/2", 3), (5, 2), ("1/50", 4)])
def test_leaky_bucket(spark, logs, chunk_rows, rate, capacity):
    unit, drain = bucket.units(rate)
    out = bucket.leaky_bucket(table(spark, logs), "name", rate, capacity, "ts", "seq", chunk_rows=chunk_rows)
    got = {}
    for r in out.collect():
        got.setdefault(r.name, []).append((r.seq, r.dropped, r.backlog_units))
    for name, entries in logs.items():
        assert sorted(got[name]) == bucket_pass([e[:2] for e in entries], capacity, unit, drain)


@pytest.mark.parametrize("chunk_rows", [1, 60, 10**6])
def test_throttle(spark, logs, chunk_rows):
    out = throttle.throttled_stats(
        table(spark, logs), "name", F.col("ok"), ~F.col("ok"), T0_US // 1000, 17, "ts", "seq", chunk_rows
    )
    got = {}
    for r in out.collect():
        got.setdefault(r.name, []).append((r.seq, r.processed, r.dropped))
    for name, entries in logs.items():
        want = throttle_pass([e[:3] for e in entries], T0_US, 17_000_000)
        assert sorted(got.get(name, [])) == want


@pytest.mark.parametrize("fan,levels", [(4, 1)])
def test_many_groups_of_chunks(spark, logs, monkeypatch, fan, levels):
    """More chunks than one group composes, with tables left to chain above it."""
    monkeypatch.setattr(folds, "FAN", fan)
    monkeypatch.setattr(folds, "LEVELS", levels)
    test_breaker(spark, logs, 1)
    test_leaky_bucket(spark, logs, 1, 5, 2)
    test_throttle(spark, logs, 1)


def test_throttle_is_not_one_per_calendar_minute(spark):
    entries = [(T0_US + s * 1_000_000, s, True, True) for s in (10, 59, 60, 100, 121, 180, 200)]
    out = throttle.throttled_stats(
        table(spark, {"a": entries}), "name", F.lit(True), F.lit(False), T0_US // 1000, 60, "ts", "seq", 1
    )
    assert sorted(r.seq for r in out.collect()) == [60, 121, 200]


def chained(chunks, advance, state):
    for number, rows in chunks:
        state = advance(state, number, rows)
    return state


@pytest.mark.parametrize("seed", range(300))
def test_bucket_tables_hold_for_any_start(seed):
    r = random.Random(seed)
    capacity, unit, drain = r.choice([1, 2, 3, 7, 40]), r.choice([1, 3, 10, 25]), r.choice([1, 2, 3])
    times = sorted(r.randint(0, r.choice([100, 400, 3000])) for _ in range(r.randint(1, 400)))
    rows = pd.DataFrame({"t": times})
    lines = bucket._summarise(rows, capacity, unit, drain).sort_values("upto")
    drained = [t * drain for t in times]
    for level in range(-1, drained[0] + capacity * unit + 1, r.choice([1, 3, 7])):
        line = lines.iloc[min(int(lines["upto"].to_numpy().searchsorted(level)), len(lines) - 1)]
        levels, _ = bucket._admit(drained, level, capacity, unit)
        assert int(line["value"]) + (0 if line["fixed"] else level) == levels[-1]


def test_chunks_hold_the_rows_asked_for(spark):
    entries = [(T0_US + i * 1_000_000, i, True, True) for i in range(3000)]
    rows = table(spark, {"hot": entries, "sparse": [(T0_US + i * 10**9, i, True, True) for i in range(50)]})
    sizes = folds.chunked(rows, "name", "ts", "seq", 100).groupBy("key", "chunk").count().collect()
    assert {r["count"] for r in sizes if r.key == "=hot"} == {100}
    assert [r["count"] for r in sizes if r.key == "=sparse"] == [50]


def test_no_job_runs_before_the_caller_asks(spark, logs):
    tracker, rows = spark.sparkContext.statusTracker(), table(spark, logs)
    spark.sparkContext.setJobGroup("fold-plans", "")
    breaker.breaker_replay(rows, 3, 20)
    bucket.leaky_bucket(rows, "name", 5, 3, "ts", "seq")
    throttle.throttled_stats(rows, "name", F.col("ok"), ~F.col("ok"), 0, 17, "ts", "seq")
    assert list(tracker.getJobIdsForGroup("fold-plans")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_without_key_or_time(spark):
    second = timedelta(seconds=1)
    rows = [
        (7, T0, 0, False), (None, T0, 1, False), (7, None, 2, True), (None, T0 + second, 3, True),
        (7, T0 + 2 * second, 4, True), (None, None, 5, False),
    ]
    frame = spark.createDataFrame(rows, "name bigint, ts timestamp, seq bigint, ok boolean")
    replayed = breaker.breaker_replay(frame, 1, 60)
    assert dict(replayed.dtypes)["name"] == "bigint"
    assert sorted((r.seq, r.name, r.result) for r in replayed.collect()) == [
        (0, 7, "failed"), (1, None, "failed"), (2, 7, "no_time"), (3, None, "rejected"), (4, 7, "rejected"), (5, None, "no_time"),
    ]
    admitted = bucket.leaky_bucket(frame, "name", "1/100", 1, "ts", "seq", keep=("ok",))
    assert sorted((r.seq, r.name, r.dropped, r.ok) for r in admitted.collect()) == [
        (0, 7, False, False), (1, None, False, False), (2, 7, None, True), (3, None, True, True), (4, 7, True, True), (5, None, None, False),
    ]
    with pytest.raises(TypeError):
        bucket.leaky_bucket(frame, "name", 0.1, 1, "ts", "seq")


def test_rows_are_shuffled_once_for_both_steps(spark, logs):
    out = breaker.breaker_replay(table(spark, logs), 3, 20, counted="counted", chunk_rows=60)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_outage_episodes_across_chunks(spark, logs):
    for chunk_seconds, chunk_rows in ((5, 1), (1, 17), (60, 40), (3600, folds.CHUNK_ROWS)):
        got = {}
        out = intake_limits.outage_episodes(table(spark, logs), max_attempts=4, chunk_seconds=chunk_seconds, chunk_rows=chunk_rows)
        for r in out.collect():
            got.setdefault(r.name, []).append((r.seq, r.episode, r.attempt, r.expected_delay, r.outcome))
        for name, entries in logs.items():
            want, episode, attempt = [], 0, 0
            for _, seq, ok, _ in entries:
                if ok:
                    outcome = "steady" if attempt == 0 else "recovered" if attempt < 4 else "restarted"
                else:
                    outcome = "failed" if attempt < 3 else "gave_up" if attempt == 3 else "stopped"
                want.append((seq, episode, attempt, 5 * 2**attempt if attempt < 4 else None, outcome))
                episode, attempt = (episode + 1, 0) if ok else (episode, attempt + 1)
            assert sorted(got[name]) == want


def test_quantile_takes_the_element_at_int_q_n(spark):
    r = random.Random(5)
    groups = {
        "hundred": list(range(100)),
        "one": [7],
        "equal": [3] * 500,
        "two values": [1] * 95 + [2] * 5,
        "wide": [r.randint(0, 10**9) for _ in range(5000)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    out = quantile.latency_summary(spark.createDataFrame(rows, "g string, v bigint"), "g", "v")
    got = {r.g: (r.n, r.p_value) for r in out.collect()}
    assert got == {g: (len(v), sorted(v)[int(0.95 * len(v))]) for g, v in groups.items()}
    assert got["hundred"][1] == 95


def test_quota_keeps_the_first_of_each_interval(spark):
    rows = [(i, T0 + timedelta(seconds=i // 10)) for i in range(1000)]
    frames = spark.createDataFrame(rows, "frame_id bigint, recv_ts timestamp").repartition(8)
    shed = intake_limits.quota_shed(frames, 10, 30)
    got = {r.frame_id: r.shed for r in shed.collect()}
    assert got == {i: i % 100 >= 30 for i in range(1000)}
    plan = shed._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_duplicates_keep_the_first_received(spark):
    rows = [(i, T0 + timedelta(seconds=100 - i), i % 7, "x%d" % i) for i in range(50)]
    frames = spark.createDataFrame(rows, "frame_id bigint, recv_ts timestamp, trade_id bigint, note string")
    kept = intake_limits.deduplicate(frames, ["trade_id"])
    assert kept.columns == frames.columns
    assert sorted(r.frame_id for r in kept.collect()) == list(range(43, 50))
    nameless = frames.withColumn("trade_id", F.lit(None).cast("bigint"))
    assert intake_limits.deduplicate(nameless, ["trade_id"]).count() == 50


def test_frames_without_event_time_stay(spark):
    frames = spark.createDataFrame([(0, T0, None), (1, T0, T0), (2, T0 + timedelta(seconds=61), T0)], "i int, recv_ts timestamp, sent timestamp")
    assert sorted(r.i for r in intake_limits.within_ttl(frames, F.col("sent")).collect()) == [0, 1]
