"""Live pipelines: the column functions of the batch operators on streams.

Reads per trigger are bounded at the source; nothing is shed unless a quota or
a bucket is asked for. Output files are written exactly once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks import defaults
from tapeworks.operators import intake, intake_limits
from tapeworks.operators.metrics import is_dropped, is_processed
from tapeworks.session import shared_dir
from tapeworks.sources import readers, writers
from tapeworks.streaming.observe import observed_stream


def messages(
    frames: DataFrame,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
    message_id: Column | None = None,
    subject: str = defaults.PUBLISH_SUBJECT,
) -> DataFrame:
    """Raw frames to ``topic, key, value`` messages, counted on the way."""
    counted = observed_stream(intake.classify(frames, subscriptions))
    return writers.to_messages(
        intake.attach_envelope(intake.published(counted), message_id=message_id), subject
    )


def publish(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str | None = None,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
    files_per_trigger: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Landed frames in, envelope messages out.

    The checkpoint defaults to a place in the shared folder that belongs to
    the target, so that a restart finds it again.
    """
    if checkpoint is None:
        checkpoint = f"{shared_dir(spark)}/publish-{hashlib.sha256(target.encode()).hexdigest()[:16]}"
    frames = readers.stream_frames(spark, source, files_per_trigger)
    return writers.stream_messages(messages(frames, subscriptions), target, checkpoint, once)


def interval_counts(
    classified: DataFrame,
    seconds: int = defaults.HEARTBEAT_SECONDS,
    delay: str = "1 minute",
    ts: str = "recv_ts",
) -> DataFrame:
    """Processed and dropped frames per interval, emitted as intervals close.

    Empty intervals do not appear in a stream; ``heartbeat_report`` over the
    landed counts or frames lists them.
    """
    return (
        classified.withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{seconds} seconds").alias("window"))
        .agg(
            F.count(F.when(is_processed(), True)).alias("processed"),
            F.count(F.when(is_dropped(), True)).alias("dropped"),
            F.max(ts).alias("last_received"),
        )
        .select(F.col("window.start").alias("interval_start"), "processed", "dropped", "last_received")
    )


def deduplicate_stream(
    frames: DataFrame, identity: Sequence[str], ts: str = "recv_ts", delay: str = "10 minutes"
) -> DataFrame:
    """First of each identity; copies are recognised for the watermark delay."""
    return frames.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(identity))


def within_ttl_stream(
    frames: DataFrame, event_time: str, seconds: int = defaults.MESSAGE_TTL_SECONDS, ts: str = "recv_ts"
) -> DataFrame:
    """Drop frames older than ``seconds`` on receipt, and let state expire alike.

    The filter compares each frame's own two times. The watermark, which
    frees state downstream, compares with the latest event time seen.
    """
    fresh = intake_limits.within_ttl(frames, F.col(event_time), seconds, ts)
    return fresh.withWatermark(event_time, f"{seconds} seconds")
