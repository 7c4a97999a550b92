"""States at report times, taken from logs of changes, against a plain search of the logs."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from tapeworks.operators import intake, metrics, snapshots

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
KINDS = {"connected": "boolean", "queue_size": "bigint", "last_ping_ms": "bigint"}


def log(spark, rows, kind):
    return spark.createDataFrame(rows, f"ts timestamp, seq bigint, value {kind}")


@pytest.mark.parametrize("bucket", [10000, 3])
def test_last_change_before_each_report(spark, monkeypatch, bucket):
    monkeypatch.setattr(snapshots, "INTERVALS_PER_BUCKET", bucket)
    rng = random.Random(7)
    value = {"connected": lambda: rng.random() < 0.5, "queue_size": lambda: rng.choice([None, 1, 5, 900]), "last_ping_ms": lambda: rng.randrange(100)}
    at = lambda: START + timedelta(milliseconds=rng.choice([rng.randrange(-900_000, 1_500_000), 60_000 * rng.randrange(25)]))
    logs = {n: [(at(), i, value[n]()) for i in range(60)] + [(None, 99, value[n]())] for n in KINDS}
    ticks = [(int(START.timestamp() * 1000) + 60_000 * i, f"tick {i}") for i in range(0, 30, 2)]
    frame = spark.createDataFrame(ticks, "tick_ms bigint, name string")
    got = snapshots.as_of_ticks(frame, {n: log(spark, rows, KINDS[n]) for n, rows in logs.items()}, 60_000)
    rows = {r.tick_ms: r for r in got.collect()}
    assert len(rows) == len(ticks) == got.count()
    for tick, name in ticks:
        row = rows[tick]
        assert row.name == name and row.running is True and row.reconnect_attempts == 0
        for n in KINDS:
            earlier = [r for r in logs[n] if r[0] is not None and r[0].timestamp() * 1000 < tick]
            expected = max(earlier, key=lambda r: r[:2])[2] if earlier else snapshots.STATES[n][1]
            assert row[n] == expected, (tick, n)


def frames(spark):
    rows = [(i, START + timedelta(seconds=s), raw) for i, (s, raw) in enumerate([(5, '{"e":"trade","s":"BTCUSDT"}'), (70, "no json"), (200, '{"e":"trade","s":"BTCUSDT"}')])]
    rows.append((9, None, '{"e":"trade","s":"BTCUSDT"}'))
    return intake.classify(spark.createDataFrame(rows, "frame_id bigint, recv_ts timestamp, raw string"))


def test_reports_follow_the_logs(spark):
    up = log(spark, [(START + timedelta(seconds=1), 1, True), (START + timedelta(seconds=60), 2, False), (START + timedelta(seconds=130), 3, True)], "boolean")
    got = snapshots.metrics_history(frames(spark), {"connected": up}, 60, capacity=10).orderBy("report_ms").collect()
    assert [r.connection_status for r in got] == ["connected", "disconnected", "connected", "connected"]
    assert [r.processed_messages for r in got] == [1, 1, 1, 2] and [r.queue_size for r in got] == [0] * 4
    assert [r.ms_since_last_message for r in got] == [55_000, 115_000, 175_000, 40_000]
    snapshot = metrics.metrics_snapshot(frames(spark).where("recv_ts is not null")).first()
    assert set(got[0].asDict()) == {*snapshot.asDict(), "report_ms"}
    assert got[-1].processed_messages == snapshot.processed_messages and got[-1].last_message_ms == snapshot.last_message_ms


def test_no_logs_and_empty_ones(spark):
    none = snapshots.metrics_history(frames(spark), {}, 60).orderBy("report_ms").collect()
    empty = snapshots.metrics_history(frames(spark), {"connected": log(spark, [], "boolean")}, 60).orderBy("report_ms").collect()
    assert none == empty and [r.is_connected for r in none] == [False] * 4 and none[0].last_ping_ms is None
    assert snapshots.metrics_history(frames(spark).limit(0), {"connected": log(spark, [], "boolean")}, 60).count() == 0
    with pytest.raises(ValueError):
        snapshots.metrics_history(frames(spark), {"mood": log(spark, [], "boolean")}, 60)
