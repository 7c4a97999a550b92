"""A stream lets in the frames that the batch does, in whatever order they arrive."""

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import intake_limits
from tapeworks.plans import inputs
from tapeworks.streaming import quota

SF = "/root/testdata/sf0.001"


def judged(spark, tmp_path, frames, name, **options):
    """Frames in four files in mixed order, one file a trigger, then one far ahead that closes all intervals."""
    folder = str(tmp_path / name)
    for part in range(4):
        frames.where(F.pmod(F.xxhash64("frame_id", F.lit(part % 2)), F.lit(4)) == part).limit(0).coalesce(1).write.mode("append").parquet(folder)
        frames.where(F.pmod(F.xxhash64("frame_id"), F.lit(4)) == part).repartition(2, "frame_id").write.mode("append").parquet(folder)
    later = frames.where("recv_ts is not null").limit(1).withColumns({"recv_ts": F.col("recv_ts") + F.expr("interval 400 days"), "frame_id": F.lit(-1).cast("bigint")})
    later.coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    stream = quota.quota_stream(source, 43200, delay="60 days", **options)
    out = stream.writeStream.format("memory").queryName(name).outputMode("append")
    query = out.option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return spark.table(name).where("seq <> -1")


@pytest.mark.parametrize("limit", [1, 5])
def test_same_frames_as_the_batch(spark, tmp_path, limit):
    frames = inputs.frames(spark, SF).select("frame_id", "recv_ts", F.when(F.col("frame_id") % 3 > 0, F.col("frame_id") % 3).alias("feed"))
    got = judged(spark, tmp_path, frames, f"by_feed_{limit}", quota=limit, key="feed")
    batch = intake_limits.quota_shed(frames, 43200, limit, ["feed"])
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert order(got.select("feed", "interval", "seq", "shed")) == order(batch.select("feed", "interval", "frame_id", "shed"))
    assert got.where("shed").count() > 0 and got.count() == frames.count()


def test_all_frames_and_those_without_a_time(spark, tmp_path):
    frames = inputs.frames(spark, SF).select("frame_id", F.when(F.col("frame_id") % 10 > 0, F.col("recv_ts")).alias("recv_ts"))
    got = judged(spark, tmp_path, frames, "all_frames", quota=3)
    batch = intake_limits.quota_shed(frames.where("recv_ts is not null"), 43200, 3)
    rows = lambda df, c: sorted(tuple(r) for r in df.select("interval", c, "shed").collect())
    assert rows(got, "seq") == rows(batch, "frame_id")
