"""Publishing envelopes: one subject, one JSON value per message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeworks import defaults
from tapeworks.functions.envelope import envelope_json
from tapeworks.functions.routing import landed_type


def to_messages(enveloped: DataFrame, subject: str = defaults.PUBLISH_SUBJECT) -> DataFrame:
    """``topic, key, value`` records; keyed by stream so one stream stays in order."""
    env = F.col("envelope")
    return enveloped.select(
        F.lit(subject).alias("topic"),
        env["stream"].alias("key"),
        envelope_json(env).alias("value"),
    )


def write_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Land messages as text, one JSON value per line."""
    messages.select("value").write.mode(mode).text(path)


def land_routed(routed: DataFrame, path: str, ts: str = "recv_ts", mode: str = "append") -> None:
    """Land routed frames as Parquet, by date and stream type.

    Known types have a folder each and all others share one, since an event
    may call itself anything.
    Rebalancing brings the rows of a folder together into few files, and cuts
    up the folder of a busy day or type instead of giving it to one task.
    """
    placed = routed.withColumns(
        {"date": F.to_date(ts), "stream_type": landed_type(F.col("stream"))}
    )
    balanced = placed.hint("rebalance", "date", "stream_type").sortWithinPartitions(
        "date", "stream_type", "stream"
    )
    balanced.write.mode(mode).partitionBy("date", "stream_type").parquet(path)


def stream_messages(
    messages: DataFrame, path: str, checkpoint: str, once: bool = False, every: str = "10 seconds"
) -> StreamingQuery:
    """Land messages as they come, one batch of files per ``every``. Checkpointed, so each is written exactly once."""
    writer = (
        messages.select("value")
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def stream_to_kafka(messages: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    """Publish to a topic. Needs the Kafka connector on the class path."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )
