"""Heartbeats of a stream are those of the report, and go on without data."""

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tapeworks.operators import intake, metrics
from tapeworks.plans import inputs
from tapeworks.streaming import heartbeats

SF = "/root/testdata/sf0.001"


def started(spark, stream, tmp_path, name, **trigger):
    out = stream.writeStream.format("memory").queryName(name).outputMode("append")
    return out.option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(**trigger).start()


def test_ticks_equal_the_report(spark, tmp_path):
    """Frames in three files in any order, a gap of days before the last."""
    frames = inputs.frames(spark, SF)
    later = frames.limit(2).withColumn("recv_ts", F.col("recv_ts") + F.expr("interval 40 days"))
    folder = str(tmp_path / "frames")
    for part in range(3):
        frames.where(F.pmod(F.xxhash64("frame_id"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(folder)
    later.coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream = heartbeats.heartbeat_stream(intake.classify(source), 3600, delay_seconds=32 * 86400)
    query = started(spark, stream, tmp_path, "ticks", availableNow=True)
    query.awaitTermination(240)
    got = [tuple(r) for r in spark.table("ticks").orderBy("tick_ms").collect()]
    report = metrics.heartbeat_report(intake.classify(spark.read.parquet(folder)), 3600)
    expected = [tuple(r) for r in report.select(*spark.table("ticks").columns).orderBy("tick_ms").collect()]
    assert len(got) > 100 and any(row[1] == 0 for row in got)
    assert got == expected[: len(got)]


def test_a_silent_stream_goes_on(spark, tmp_path):
    folder, now = str(tmp_path / "now"), datetime.now(timezone.utc)
    schema = "raw string, recv_ts timestamp, frame_id bigint"
    write = lambda n, at: spark.createDataFrame(
        [('{"e":"trade","s":"BTCUSDT"}', at + timedelta(milliseconds=i), i) for i in range(n)], schema
    ).coalesce(1).write.mode("append").parquet(folder)
    write(5, now)
    source = spark.readStream.schema(schema).parquet(folder)
    stream = heartbeats.heartbeat_stream(intake.classify(source), 1, delay_seconds=0, wall_clock=True)
    query = started(spark, stream, tmp_path, "live", processingTime="1 second")
    try:
        deadline = time.time() + 120
        while time.time() < deadline and spark.table("live").count() < 6:
            time.sleep(1)
        # Late by its own time: counts in the next heartbeat that is told.
        write(3, now)
        told = spark.table("live").agg(F.max("total_processed")).first()[0]
        assert told == 5
        while time.time() < deadline and spark.table("live").agg(F.max("total_processed")).first()[0] < 8:
            time.sleep(1)
    finally:
        query.stop()
    rows = spark.table("live").orderBy("tick_ms").collect()
    assert [b.tick_ms - a.tick_ms for a, b in zip(rows, rows[1:])] == [1000] * (len(rows) - 1)
    assert rows[-1].total_processed == 8 and sum(r.processed_since_last for r in rows) == 8
    assert sum(r.processed_since_last == 0 for r in rows) >= 4


def test_report_counts_frames_without_a_time(spark):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    made = [("published", "object", t0), ("published", "object", None), ("queue_full", "object", None), ("published", "object", t0 + timedelta(minutes=3))]
    frames = spark.createDataFrame(made, "disposition string, shape string, recv_ts timestamp")
    rows = metrics.heartbeat_report(frames, 60).orderBy(F.col("tick_ms").asc_nulls_first()).collect()
    assert [(r.processed_since_last, r.dropped_since_last, r.total_processed) for r in rows] == [(1, 1, None), (1, 0, 1), (0, 0, 1), (0, 0, 1), (1, 0, 2)]
