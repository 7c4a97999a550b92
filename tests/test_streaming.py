"""Streams give what the batch operators give."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import intake_limits, payloads, breaker, bucket, intake, metrics, throttle
from tapeworks.plans import inputs
from tapeworks.sources import readers
from tapeworks.streaming import observe, pipelines, stateful

SF = "/root/testdata/sf0.001"
START_MS = 1704067200000


@pytest.fixture
def landed(spark, tmp_path):
    """Events in four files in mixed order, then one far in the future."""
    folder = str(tmp_path / "landed")
    events = inputs.events(spark, SF).withColumn("ok", F.col("event_type") != "error")
    last = events.orderBy(F.desc("event_id")).limit(1)
    later = last.withColumns(
        {"event_id": F.lit(10**9).cast("bigint"), "ts": F.col("ts") + F.expr("interval 400 days"), "sym": F.lit("END")}
    )
    events.repartition(4, F.xxhash64("event_id")).write.parquet(folder)
    later.coalesce(1).write.mode("append").parquet(folder)
    return events, folder


def run(stream, tmp_path, name):
    out = stream.writeStream.format("memory").queryName(name).outputMode("append")
    query = out.option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return stream.sparkSession.table(name)


def read(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).parquet(folder)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_breaker(spark, tmp_path, landed):
    events, folder = landed
    columns = ("sym", "seq", "state_before", "state_after", "result", "failure_count")
    batch = breaker.breaker_replay(events.withColumnRenamed("event_id", "seq"), 2, 7200, "sym", chunk_rows=200)
    stream = stateful.breaker_stream(
        read(spark, folder).withColumnRenamed("event_id", "seq"), 2, 7200, "sym", delay="31 days"
    )
    got = run(stream, tmp_path, "breaker_out")
    assert rows(got, *columns) == rows(batch, *columns)


def test_leaky_bucket(spark, tmp_path, landed):
    events, folder = landed
    columns = ("sym", "seq", "dropped", "backlog_units")
    batch = bucket.leaky_bucket(events, "sym", "1/14400", 2, "ts", "event_id", chunk_rows=200)
    stream = stateful.leaky_bucket_stream(
        read(spark, folder), "sym", "1/14400", 2, "ts", "event_id", delay="31 days"
    )
    assert rows(run(stream, tmp_path, "bucket_out"), *columns) == rows(batch, *columns)


def test_throttled_stats(spark, tmp_path, landed):
    events, folder = landed
    done, lost = F.col("ok"), ~F.col("ok")
    columns = ("sym", "seq", "processed", "dropped")
    batch = throttle.throttled_stats(events, "sym", done, lost, START_MS, 7200, "ts", "event_id", 200)
    stream = stateful.throttled_stats_stream(
        read(spark, folder), "sym", done, lost, START_MS, 7200, "ts", "event_id", delay="31 days"
    )
    assert rows(run(stream, tmp_path, "throttle_out").filter("sym <> 'END'"), *columns) == rows(batch, *columns)


def test_publish_counts_and_envelopes(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frames = inputs.frames(spark, SF)
    frames.select("raw").repartition(3).write.text(source)
    totals = observe.RunningTotals()
    spark.streams.addListener(totals)
    try:
        query = pipelines.publish(spark, source, target, files_per_trigger=1, once=True)
        query.awaitTermination(240)
    finally:
        spark.streams.removeListener(totals)
    expected = intake.published(intake.classify(frames))
    texts = [r.value for r in spark.read.text(target).collect()]
    assert len(texts) == expected.count()
    streams = sorted(json.loads(t)["stream"] for t in texts)
    assert streams == sorted(r.stream for r in expected.select("stream").collect())
    # Running it again finds nothing new: the checkpoint remembers.
    pipelines.publish(spark, source, target, once=True).awaitTermination(240)
    assert spark.read.text(target).count() == len(texts)
    assert totals.totals["offered"] == frames.count()
    assert totals.totals["processed"] == len(texts)


def test_interval_counts_match_running_totals(spark, tmp_path):
    folder = str(tmp_path / "frames")
    frames = inputs.frames(spark, SF)
    later = frames.limit(1).withColumn("recv_ts", F.col("recv_ts") + F.expr("interval 400 days"))
    frames.unionByName(later).repartition(2, F.xxhash64("frame_id")).write.parquet(folder)
    stream = pipelines.interval_counts(intake.classify(read(spark, folder)), 86400, "32 days")
    got = run(stream, tmp_path, "interval_out").withColumn("interval_start_ms", F.unix_millis("interval_start"))
    batch = metrics.running_totals(intake.classify(frames), 86400)
    columns = ("interval_start_ms", "processed", "dropped")
    assert rows(got, *columns) == rows(batch, *columns)


def test_deduplicate_and_ttl(spark, tmp_path):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    made = [(i % 3, t0 + timedelta(seconds=i), t0 + timedelta(seconds=i - 30 * i)) for i in range(9)]
    folder = str(tmp_path / "copies")
    spark.createDataFrame(made, "id bigint, recv_ts timestamp, event_time timestamp").write.parquet(folder)
    once = run(pipelines.deduplicate_stream(read(spark, folder), ["id"]), tmp_path, "dedup_out")
    assert rows(once, "id") == [(0,), (1,), (2,)]
    fresh = run(pipelines.within_ttl_stream(read(spark, folder), "event_time"), tmp_path, "ttl_out")
    assert fresh.count() == 3


def test_observed_batch_counts(spark, tmp_path):
    frames, observation = observe.observed(intake.classify(inputs.frames(spark, SF)))
    frames.write.format("noop").mode("overwrite").save()
    counted = observation.get
    assert intake.classify(inputs.frames(spark, SF)).agg(*observe.counters()).first().asDict() == counted
    assert counted["offered"] == 1000
    assert counted["processed"] == intake.published(intake.classify(inputs.frames(spark, SF))).count()


def test_reading_landed_text(spark, tmp_path):
    folder = str(tmp_path / "text")
    inputs.frames(spark, SF).select("raw").write.text(folder)
    read_back = readers.read_frames(spark, folder)
    assert read_back.columns == ["raw", "recv_ts", "frame_id", "file"]
    assert read_back.count() == 1000
    assert read_back.select("frame_id").distinct().count() == 1000
    # The operators take what the library's own source gives.
    typed = payloads.trades(intake.published(intake.classify(read_back)), keep=("recv_ts", "frame_id"))
    assert intake_limits.deduplicate(typed, ["symbol", "trade_id"]).count() == typed.count()
    shed = intake_limits.quota_shed(read_back, 3600, 10)
    assert shed.filter(~F.col("shed")).count() == 10
    admitted = bucket.leaky_bucket(read_back.withColumn("feed", F.lit("x")), "feed", 1, 5, keep=("raw",))
    assert admitted.filter(~F.col("dropped")).count() == 5
    queued = intake.classify(admitted, queue_full=F.col("dropped"))
    assert queued.filter(F.col("disposition") == "queue_full").count() > 900
    by_event = F.timestamp_millis(F.get_json_object("value", "$.E").cast("bigint"))
    assert readers.read_frames(spark, folder, by_event).select(F.min("recv_ts")).first()[0].year == 2024


def test_missing_keys_and_times(spark, tmp_path):
    """A missing key is not the empty one, and rows without a time come back as such."""
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    made = [(None, 1, False, 1), ("", 2, True, 2), (None, 2, True, 3), ("a", None, True, 4), (None, None, False, 5), ("a", 9, False, 6)]
    made = [(n, t and t0 + timedelta(seconds=t), ok, seq) for n, t, ok, seq in made]
    log = spark.createDataFrame(made, "name string, ts timestamp, ok boolean, seq bigint")
    later = spark.createDataFrame([("END", t0 + timedelta(days=9), True, 9)], log.schema)
    folder = str(tmp_path / "log")
    log.unionByName(later).coalesce(1).write.parquet(folder)
    order = lambda df, *cs: sorted((tuple(r) for r in df.select(*cs).collect()), key=str)
    columns = ("name", "seq", "state_before", "state_after", "result", "failure_count")
    got = run(stateful.breaker_stream(read(spark, folder), 1, 60), tmp_path, "odd_breaker")
    assert order(got, *columns) == order(breaker.breaker_replay(log, 1, 60), *columns)
    columns = ("name", "seq", "dropped", "backlog_units")
    got = run(stateful.leaky_bucket_stream(read(spark, folder), "name", 1, 1, "ts", "seq"), tmp_path, "odd_bucket")
    assert order(got, *columns) == order(bucket.leaky_bucket(log, "name", 1, 1, "ts", "seq"), *columns)


def test_slots_are_read_once_they_are_due(spark, tmp_path):
    """Rows of one slot that come in several triggers, in any order, are folded once, in order."""
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    folder = str(tmp_path / "slots")
    for part in range(4):
        made = [("k", t0 + timedelta(milliseconds=250 * (4 * n + part)), n % 3 > 0, 4 * n + part) for n in range(30)]
        spark.createDataFrame(made, "name string, ts timestamp, ok boolean, seq bigint").coalesce(1).write.mode("append").parquet(folder)
    log = spark.read.parquet(folder)
    later = spark.createDataFrame([("END", t0 + timedelta(days=9), True, 999)], log.schema)
    later.coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    columns = ("name", "seq", "state_before", "state_after", "result", "failure_count")
    got = run(stateful.breaker_stream(source, 2, 3, delay="1 hour"), tmp_path, "slots_out")
    assert rows(got, *columns) == rows(breaker.breaker_replay(log.filter("name = 'k'"), 2, 3), *columns)


def test_outages(spark, tmp_path, landed):
    events, folder = landed
    columns = ("sym", "seq", "episode", "attempt", "expected_delay", "outcome")
    named = lambda df: df.withColumnsRenamed({"event_id": "seq"})
    batch = intake_limits.outage_episodes(named(events), "sym", delay=3, max_attempts=2)
    stream = stateful.outage_stream(named(read(spark, folder)), "sym", delay=3, max_attempts=2, watermark="31 days")
    key = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert key(run(stream, tmp_path, "outage_out").filter("sym <> 'END'")) == key(batch)
