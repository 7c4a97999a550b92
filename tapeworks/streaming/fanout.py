"""One parse of a live stream, fanned out to messages and rejects, each frame exactly once.

A trigger's frames are classified once and written by one job, messages and
rejects in folders of their own, below a folder named by query and batch. Then a
line in the ledger says what the batch holds; it counts only from there on. A
batch that is tried again finds its line and does nothing, or no line, and
replaces what the first attempt left behind. So neither a lost driver nor a replay
writes a frame twice or loses one, on any file system; no transactions are needed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks import defaults
from tapeworks.functions.envelope import envelope_json
from tapeworks.operators import intake
from tapeworks.session import prepare, shared_dir
from tapeworks.sources import readers

MESSAGES, REJECTS = "messages", "rejects"
PLACE = "query string, batch bigint"
LEDGER = f"{PLACE}, frames bigint, " + ", ".join(f"{d} bigint" for d in intake.DISPOSITIONS)
REJECT = "disposition string, raw string, recv_ts timestamp, frame_id bigint, file string"


def _ledger(target: str, query: str, batch: int) -> str:
    return f"{target}/ledger/query={query}/batch={batch}"


def is_committed(spark: SparkSession, target: str, query: str, batch: int) -> bool:
    """Whether the batch has its line in the ledger."""
    try:
        return not spark.read.schema(LEDGER).json(_ledger(target, query, batch)).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def commit_batch(
    classified: DataFrame, target: str, query: str, batch: int, message_id: Column | None = None
) -> bool:
    """Write a batch and its line in the ledger, unless it has one; whether it was written.

    Published frames become envelope messages, one JSON value a line. All
    others become JSON with their ``disposition``, text, time and origin.
    """
    spark = classified.sparkSession
    if is_committed(spark, target, query, batch):
        return False
    published = F.col("disposition") == "published"
    known = [c for c in ("disposition", "raw", "recv_ts", "frame_id", "file") if c in classified.columns]
    reject = F.to_json(F.struct(*known))
    counted = Observation()
    counts = [F.count("*").alias("frames"), *[F.count_if(F.col("disposition") == d).alias(d) for d in intake.DISPOSITIONS]]
    lines = intake.attach_envelope(classified.observe(counted, *counts), message_id=message_id).select(
        F.when(published, envelope_json(F.col("envelope"))).otherwise(reject).alias("value"),
        F.when(published, MESSAGES).otherwise(REJECTS).alias("sink"),
    )
    lines.write.mode("overwrite").partitionBy("sink").text(f"{target}/data/query={query}/batch={batch}")
    _note(spark, target, query, batch, counted.get)
    return True


def _note(spark: SparkSession, target: str, query: str, batch: int, counts: dict[str, int]) -> None:
    """The line that makes a batch count: one file, put in its place when it is whole."""
    line = spark.createDataFrame([(query, batch, *[counts[c] for c in ("frames", *intake.DISPOSITIONS)])], LEDGER)
    line.drop("query", "batch").coalesce(1).write.mode("overwrite").json(_ledger(target, query, batch))


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """``query, batch, frames`` and a count per disposition of every committed batch."""
    found = spark.read.schema(LEDGER).json(f"{target}/ledger")
    return found.select(*[c.split()[0] for c in LEDGER.split(", ")])


def _written(spark: SparkSession, target: str, sink: str) -> DataFrame:
    found = spark.read.schema(f"value string, {PLACE}, sink string").text(f"{target}/data")
    return found.where(F.col("sink") == sink).join(ledger(spark, target).select("query", "batch"), ["query", "batch"], "left_semi")


def messages(spark: SparkSession, target: str) -> DataFrame:
    """``value, query, batch`` of the messages of committed batches."""
    return _written(spark, target, MESSAGES).select("value", "query", "batch")


def rejects(spark: SparkSession, target: str) -> DataFrame:
    """``disposition, raw, recv_ts, frame_id, file, query, batch`` of the other frames of committed batches."""
    read = F.from_json("value", REJECT).alias("reject")
    return _written(spark, target, REJECTS).select(read, "query", "batch").select("reject.*", "query", "batch")


def publish_all(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str | None = None,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
    files_per_trigger: int | None = None,
    recv_ts: Column | None = None,
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Landed frames in, messages and rejects out, see ``messages``, ``rejects`` and ``ledger``.

    The checkpoint defaults to a place in the shared folder that belongs to
    the target, so that a restart finds it again. A new checkpoint is a new
    query: it reads the source again and its batches get folders of their own.
    """
    prepare(spark)
    if checkpoint is None:
        checkpoint = f"{shared_dir(spark)}/publish-all-{hashlib.sha256(target.encode()).hexdigest()[:16]}"
    frames = readers.stream_frames(spark, source, files_per_trigger, recv_ts)
    named: list[str] = []

    def commit(batch_frames: DataFrame, batch: int) -> None:
        if not named:
            named.append(json.loads(batch_frames.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        commit_batch(batch_frames, target, named[0], batch)

    writer = intake.classify(frames, subscriptions).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
