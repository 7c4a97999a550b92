"""Candles of every period kept up to date by a stream of trades, however late these come.

A trigger's trades are aggregated to mergeable candles of the shortest period and
written as parts, by batch and day. The candles of the days they touch, and of no
others, are then rolled up anew from the parts of those days and replace the day's
partition. A batch that is tried again replaces its own parts and arrives at the
same candles, so nothing counts twice. No trade is too late: an old day is made anew
from its parts, not from its trades. Nothing is kept in the state store.

Parts of many batches are merged by ``compact``. Days are of UTC.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks import defaults
from tapeworks.operators import history
from tapeworks.session import prepare, shared_dir

DAY = 86400
# Days replaced by one job; a batch that touches more goes on with the next ones.
DAYS_AT_ONCE = 366


def _lengths(periods: Mapping[str, int] | Sequence[str]) -> tuple[dict[str, int], int]:
    lengths, base = history.period_lengths(periods)
    if any(DAY % seconds for seconds in lengths.values()):
        raise ValueError("every period must divide a day")
    return lengths, base


def _day(base: int) -> Column:
    return F.call_function("div", F.col("slot"), F.lit(DAY // base)).cast("int").alias("day")


def _found(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _through(spark: SparkSession, target: str) -> int:
    """The last batch whose parts are merged; -1 if none."""
    noted = _found(spark, f"{target}/compacted")
    return -1 if noted is None else noted.agg(F.max("through")).first()[0]


def parts(spark: SparkSession, target: str) -> DataFrame | None:
    """Mergeable candles by ``day``: the merged ones, and those of later batches. None before the first batch."""
    through = _through(spark, target)
    merged = None if through < 0 else _found(spark, f"{target}/merged/through={through}")
    each = _found(spark, f"{target}/parts")
    later = None if each is None else each.where(F.col("batch") > through).drop("batch")
    if merged is None or later is None:
        return later if merged is None else merged
    return merged.unionByName(later)


def commit_batch(
    trades: DataFrame,
    target: str,
    batch: int,
    periods: Mapping[str, int] | Sequence[str] = tuple(defaults.CANDLE_PERIODS),
    ts: str = "trade_time",
) -> None:
    """Add the trades of a batch, and make the candles of the days they fall on anew.

    Committing a batch number again replaces what it held. A source that replays
    gives the same trades; if it did not and left a day without any, that day's
    candles would stay. Trades without a time have no candle. Columns must be of the
    same types in every batch, as those of a stream are.
    """
    spark = trades.sparkSession
    if batch <= _through(spark, target):
        return
    lengths, base = _lengths(periods)
    own = f"{target}/parts/batch={batch}"
    earlier = _found(spark, own)
    before = [] if earlier is None else [r.day for r in earlier.select("day").distinct().collect()]
    found = history.partial_candles(trades.where(F.col(ts).isNotNull()), base, ts).withColumn("day", _day(base))
    found.repartition("day").write.mode("overwrite").partitionBy("day").parquet(own)
    written = _found(spark, own)
    touched = [] if written is None else [r.day for r in written.select("day").distinct().collect()]
    days = sorted({*touched, *before})
    for n in range(0, len(days), DAYS_AT_ONCE):
        _replace(spark, target, days[n : n + DAYS_AT_ONCE], lengths, base)


def _replace(spark: SparkSession, target: str, days: list[int], lengths: Mapping[str, int], base: int) -> None:
    """Candles of these days from their parts; no other day's files are read or written."""
    known = parts(spark, target)
    if known is None:
        return
    rolled = history.roll_up(known.where(F.col("day").isin(days)).drop("day"), lengths, base)
    day = F.call_function("div", F.col("open_ms"), F.lit(DAY * 1000)).cast("int")
    placed = rolled.withColumn("day", day).repartition("day", "period")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{target}/candles")


def candles(spark: SparkSession, target: str) -> DataFrame | None:
    """The candles as ``history.candles`` gives them, and their ``day``, by which reads are pruned. None before the first batch."""
    return _found(spark, f"{target}/candles")


def compact(spark: SparkSession, target: str, through: int) -> bool:
    """Merge the parts of all batches up to ``through``; whether there was anything to merge.

    The merged parts count from the line that is written last, so a lost driver
    leaves the old parts in force. Folders of merged batches are not read any
    more and may be deleted once no batch is being committed. A batch that is merged
    cannot be committed again: call this for batches that the stream's checkpoint has passed.
    """
    if through <= _through(spark, target):
        return False
    each = _found(spark, f"{target}/parts")
    if each is None:
        return False
    passed = _through(spark, target)
    old = each.where((F.col("batch") > passed) & (F.col("batch") <= through)).drop("batch")
    if passed >= 0:
        merged = _found(spark, f"{target}/merged/through={passed}")
        old = old if merged is None else old.unionByName(merged)
    whole = history.merge_partials(old, ["symbol", "slot", "day"])
    whole.repartition("day").write.mode("overwrite").partitionBy("day").parquet(f"{target}/merged/through={through}")
    line = spark.createDataFrame([(through,)], "through bigint")
    line.coalesce(1).write.mode("append").parquet(f"{target}/compacted")
    return True


def keep_candles(
    trades: DataFrame,
    target: str,
    checkpoint: str | None = None,
    periods: Mapping[str, int] | Sequence[str] = tuple(defaults.CANDLE_PERIODS),
    ts: str = "trade_time",
    once: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Keep the candles at ``target`` up to date with a stream of typed trades.

    A target belongs to one checkpoint; the default is a place in the shared
    folder that belongs to the target. While a day's partition is replaced a reader
    may miss it; ``history.high_water``, ``completeness`` and ``candle_gaps`` of
    ``candles`` are as of the last batch.
    """
    spark = prepare(trades.sparkSession)
    _lengths(periods)
    if checkpoint is None:
        checkpoint = f"{shared_dir(spark)}/keep-candles-{hashlib.sha256(target.encode()).hexdigest()[:16]}"

    def commit(rows: DataFrame, batch: int) -> None:
        commit_batch(rows, target, batch, periods, ts)

    writer = trades.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
