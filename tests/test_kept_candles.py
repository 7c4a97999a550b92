"""Candles kept up to date equal those of all trades at once, after every batch and whatever comes late or again."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tapeworks.operators import history, payloads
from tapeworks.plans.frame_queries import published
from tapeworks.streaming import candles as kept

SF = "/root/testdata/sf0.001"
PERIODS = ("5m", "1h", "1d")


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.drop("day").collect())


@pytest.fixture(scope="module")
def trades(spark, tmp_path_factory):
    """Typed trades, some of one millisecond, some of no symbol, dealt to batches whatever their time."""
    path = str(tmp_path_factory.mktemp("trades") / "t")
    found = payloads.trades(published(spark, SF)).select("symbol", "trade_id", "price", "quantity", "trade_time", "is_buyer_maker")
    found = found.withColumn("symbol", F.when(F.col("trade_id") % 7 > 0, F.col("symbol")))
    same = found.withColumns({"trade_time": F.date_trunc("hour", "trade_time"), "trade_id": -F.col("trade_id")})
    found.unionByName(same).withColumn("part", F.pmod(F.xxhash64("trade_id"), F.lit(3))).write.parquet(path)
    return spark.read.parquet(path)


def test_every_batch_equals_the_trades_so_far(spark, tmp_path, trades):
    target = str(tmp_path / "out")
    assert kept.candles(spark, target) is None and kept.parts(spark, target) is None
    for batch in range(3):
        kept.commit_batch(trades.where(F.col("part") == batch), target, batch, PERIODS)
        so_far = history.candles(trades.where(F.col("part") <= batch), PERIODS)
        assert rows(kept.candles(spark, target)) == rows(so_far)
    report = 1706745600000
    assert rows(history.high_water(kept.candles(spark, target))) == rows(history.high_water(so_far))
    assert rows(history.completeness(kept.candles(spark, target), report)) == rows(history.completeness(so_far, report))
    assert rows(history.candle_gaps(kept.candles(spark, target))) == rows(history.candle_gaps(so_far))
    # A batch again, and one without a trade that has a time, change nothing.
    kept.commit_batch(trades.where("part = 1"), target, 1, PERIODS)
    kept.commit_batch(trades.where("part = 1").withColumn("trade_time", F.lit(None).cast("timestamp")), target, 3, PERIODS)
    assert rows(kept.candles(spark, target)) == rows(so_far)


def test_only_days_of_the_batch_are_written(spark, tmp_path, trades):
    target = str(tmp_path / "out")
    kept.commit_batch(trades, target, 0, PERIODS)
    files = lambda: {r.f: r.day for r in kept.candles(spark, target).select(F.input_file_name().alias("f"), "day").distinct().collect()}
    before = files()
    day = min(before.values())
    late = trades.where(F.unix_date(F.to_date("trade_time")) == day).limit(2).withColumn("price", (F.col("price") * 2).cast(dict(trades.dtypes)["price"]))
    kept.commit_batch(late, target, 1, PERIODS)
    changed = {before.get(f) or d for f, d in files().items() if f not in before}
    assert changed == {day} and len(set(before.values())) > 5


def test_merged_parts_count_once(spark, tmp_path, trades):
    target = str(tmp_path / "out")
    for batch in range(2):
        kept.commit_batch(trades.where(F.col("part") == batch), target, batch, PERIODS)
        assert kept.compact(spark, target, batch)
    assert not kept.compact(spark, target, 1)
    # The last merged batch comes again after a lost driver; then a new one.
    kept.commit_batch(trades.where("part = 1"), target, 1, PERIODS)
    kept.commit_batch(trades.where("part = 2"), target, 2, PERIODS)
    assert rows(kept.candles(spark, target)) == rows(history.candles(trades, PERIODS))
    assert kept.parts(spark, target).dtypes == kept._found(spark, f"{target}/parts").drop("batch").dtypes


def test_stream_restarted_within_a_batch(spark, tmp_path, trades, monkeypatch):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in range(3):
        trades.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(source)
    read = lambda: spark.readStream.schema(trades.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(source)
    start = lambda: kept.keep_candles(read(), target, checkpoint, PERIODS, once=True)
    replace, calls = kept._replace, []

    def lost(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        replace(*args)

    monkeypatch.setattr(kept, "_replace", lost)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination(240)
    start().awaitTermination(240)
    assert rows(kept.candles(spark, target)) == rows(history.candles(trades, PERIODS))


def test_periods_must_divide_a_day(spark, trades):
    with pytest.raises(ValueError):
        kept.commit_batch(trades, "unused", 0, {"7h": 25200})
