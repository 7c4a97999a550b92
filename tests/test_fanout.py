"""Messages and rejects of a stream reconcile with its frames, whatever breaks in between."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tapeworks.operators import intake
from tapeworks.plans import inputs
from tapeworks.streaming import fanout

SF = "/root/testdata/sf0.001"


@pytest.fixture
def landed(spark, tmp_path):
    """Frames in four files, among them malformed ones, and what they come to in batch."""
    frames = inputs.frames(spark, SF).where("raw not like '%\n%'")
    source = str(tmp_path / "in")
    frames.select("raw").repartition(4, F.xxhash64("raw")).write.text(source)
    classified = intake.classify(spark.read.text(source).select(F.col("value").alias("raw")))
    expected = {r["disposition"]: r["n"] for r in classified.groupBy("disposition").agg(F.count("*").alias("n")).collect()}
    assert expected["published"] and expected["malformed_json"]
    return source, classified, expected


def check(spark, target, classified, expected):
    lines = fanout.ledger(spark, target)
    sums = lines.agg(*[F.sum(c).alias(c) for c in ("frames", *intake.DISPOSITIONS)]).first().asDict()
    assert sums["frames"] == sum(expected.values())
    assert {d: n for d, n in sums.items() if n and d != "frames"} == expected
    streams = sorted(json.loads(r.value)["stream"] for r in fanout.messages(spark, target).collect())
    assert streams == sorted(r.stream for r in intake.published(classified).select("stream").collect())
    got = sorted((r.disposition, r.raw) for r in fanout.rejects(spark, target).select("disposition", "raw").collect())
    others = classified.where("disposition <> 'published'").select("disposition", "raw")
    assert got == sorted((r.disposition, r.raw) for r in others.collect())
    return lines.count()


def test_restart_after_a_batch_without_its_line(spark, tmp_path, landed, monkeypatch):
    """The driver is lost when a batch's data is written but not noted; nothing is lost or doubled."""
    source, classified, expected = landed
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    note, calls = fanout._note, []

    def lost(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        note(*args)

    monkeypatch.setattr(fanout, "_note", lost)
    start = lambda: fanout.publish_all(spark, source, target, checkpoint, files_per_trigger=1, once=True)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination(240)
    # The second batch is there, but it does not count.
    assert fanout.ledger(spark, target).count() == 1
    assert spark.read.text(f"{target}/data").select("batch").distinct().count() == 2
    assert fanout.messages(spark, target).select("batch").distinct().count() == 1
    start().awaitTermination(240)
    assert check(spark, target, classified, expected) == 4
    # Nothing new: a third start adds nothing.
    start().awaitTermination(240)
    assert check(spark, target, classified, expected) == 4


def test_replayed_batch_leaves_no_copy(spark, tmp_path, landed):
    source, classified, expected = landed
    target = str(tmp_path / "out")
    frames = classified.withColumns({"recv_ts": F.timestamp_seconds(F.lit(0)), "frame_id": F.xxhash64("raw"), "file": F.lit("f")})
    assert fanout.commit_batch(frames, target, "q", 0)
    assert not fanout.commit_batch(frames, target, "q", 0)
    assert not fanout.commit_batch(frames.limit(1), target, "q", 0)
    assert check(spark, target, classified, expected) == 1
    # Another query's batch of the same number is another batch.
    assert fanout.commit_batch(frames.limit(0), target, "r", 0)
    assert check(spark, target, classified, expected) == 2
