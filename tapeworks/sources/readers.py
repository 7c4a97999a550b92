"""Frame sources, batch and streaming, and the subscription list."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.frames import is_json


def read_frames(spark: SparkSession, path: str, recv_ts: Column | None = None) -> DataFrame:
    """Landed frames, one JSON text per line: ``raw, recv_ts, frame_id, file``.

    ``frame_id`` follows the lines of a file. Without ``recv_ts``, an expression
    over ``value`` (the line) and ``_metadata``, a frame counts as received when
    its file was last modified, which is all that plain text knows.
    """
    return _landed(spark.read.text(path), recv_ts, F.monotonically_increasing_id())


def table_frames(
    table: DataFrame, raw: str = "raw", recv_ts: str = "recv_ts", frame_id: str = "frame_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Frames of any table that has their text, receive time and position: ``frame_id, recv_ts, raw``."""
    return table.select(
        F.col(frame_id).cast("bigint").alias("frame_id"),
        F.col(recv_ts).cast("timestamp").alias("recv_ts"),
        F.col(raw).cast("string").alias("raw"),
        *keep,
    )


def stream_frames(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, recv_ts: Column | None = None
) -> DataFrame:
    """Frames of files as they land; bounded reads per trigger, nothing is shed.

    ``recv_ts`` as for ``read_frames``: without it all frames of a file share one time.
    ``frame_id`` is a hash of file and text: the same when a file is read again.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _landed(reader.text(path), recv_ts, F.xxhash64("_metadata.file_path", "value"))


def _landed(lines: DataFrame, recv_ts: Column | None, frame_id: Column) -> DataFrame:
    modified = F.col("_metadata.file_modification_time")
    return lines.select(
        F.col("value").alias("raw"),
        (modified if recv_ts is None else F.coalesce(recv_ts, modified)).alias("recv_ts"),
        frame_id.alias("frame_id"),
        F.col("_metadata.file_path").alias("file"),
    )


def read_routed(
    spark: SparkSession,
    path: str,
    streams: Sequence[str] | None = None,
    first_date: str | None = None,
    last_date: str | None = None,
) -> DataFrame:
    """Frames landed by ``writers.land_routed``; only the folders asked for are read."""
    landed = spark.read.parquet(path)
    if first_date:
        landed = landed.filter(F.col("date") >= F.lit(first_date).cast("date"))
    if last_date:
        landed = landed.filter(F.col("date") <= F.lit(last_date).cast("date"))
    if streams is not None:
        named = {s.split("@")[1] for s in streams if "@" in s}
        types = sorted({t if t in defaults.LANDED_TYPES else "other" for t in named})
        landed = landed.filter(F.col("stream_type").isin(types) & F.col("stream").isin(list(streams)))
    return landed


def kafka_frames(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = True,
    offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Frames from a topic, in the order of their offsets within a partition.

    Needs the Kafka connector on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic)
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return reader.options(**options).load().select(
        F.decode("value", "UTF-8").alias("raw"),
        F.col("timestamp").alias("recv_ts"),
        (F.shiftleft(F.col("partition").cast("bigint"), 44) + F.col("offset")).alias("frame_id"),
        "partition",
        "offset",
    )


def subscription_list(spec: Column) -> Column:
    """Comma-separated stream names, trimmed; the defaults when there are none."""
    given = F.transform(F.split(spec, ","), lambda s: F.btrim(s, F.lit(" \t\n\r")))
    fallback = F.array(*[F.lit(s) for s in defaults.DEFAULT_STREAMS])
    return F.when(F.coalesce(spec, F.lit("")) == "", fallback).otherwise(given)


def subscriptions(spark: SparkSession, streams: Sequence[str] = defaults.DEFAULT_STREAMS) -> DataFrame:
    """The subscription list as a table ``pos, stream``."""
    return spark.createDataFrame(list(enumerate(streams)), "pos int, stream string")


def subject_regex(pattern: str) -> str:
    """Regular expression of a dotted subject pattern.

    ``*`` stands for exactly one token, a final ``>`` for one or more.
    """
    tokens = pattern.split(".")
    tail = r"\..+" if tokens[-1] == ">" and len(tokens) > 1 else ""
    if tokens == [">"]:
        return "^.+$"
    if tail:
        tokens = tokens[:-1]
    parts = [r"[^.]+" if t == "*" else re.escape(t) for t in tokens]
    return "^" + r"\.".join(parts) + tail + "$"


def subject_matches(subject: Column, pattern: str) -> Column:
    return F.regexp_like(subject, F.lit(subject_regex(pattern)))


def subscribe(
    messages: DataFrame, patterns: str | Sequence[str], subject: str = "subject", value: str = "value"
) -> DataFrame:
    """Messages under subject patterns, with ``pattern``, ``text`` and, if JSON, ``data``.

    A message under several of the patterns comes once for each. Bytes are
    decoded as UTF-8. Text that is no JSON keeps ``data`` NULL and stays
    readable as ``text``.
    """
    listed = [patterns] if isinstance(patterns, str) else list(patterns)
    hits = F.array(*[F.when(subject_matches(F.col(subject), p), F.lit(p)) for p in listed])
    text = F.decode(F.col(value).cast("binary"), "UTF-8")
    return (
        messages.select("*", F.explode(F.array_compact(hits)).alias("pattern"))
        .withColumn("text", text)
        .withColumn("data", F.when(is_json(F.col("text")), F.try_parse_json("text")))
    )


def subscribe_table(
    messages: DataFrame, patterns: DataFrame, pattern: str = "pattern", subject: str = "subject", value: str = "value"
) -> DataFrame:
    """``subscribe`` for a table of patterns, however many: a message under several comes once for each.

    Patterns have few shapes, which tokens are ``*`` and whether they end in
    ``>``. For each shape a subject has one pattern that it could fall
    under, so messages meet patterns in a plain join on text. Shapes, not
    patterns, are what a message is tried against. NULL patterns and
    subjects match nothing; repeated patterns count once.
    """
    listed = patterns.select(F.col(pattern).alias("pattern")).where("pattern is not null").distinct()
    parts = F.split("pattern", r"\.")
    shape = F.transform(parts, lambda t: F.when(t.isin("*"), t).otherwise("="))
    tail = F.endswith("pattern", F.lit(".>")) | (F.col("pattern") == ">")
    shapes = [(list(r["shape"]), r["tail"]) for r in listed.select(shape.alias("shape"), tail.alias("tail")).distinct().collect()]
    tokens = F.split(subject, r"\.")
    candidates = []
    for marks, open_end in sorted(shapes, key=str):
        size = len(marks) - open_end
        at = [F.lit("*") if mark == "*" else F.get(tokens, F.lit(i)) for i, mark in enumerate(marks[:size])]
        fits = F.size(tokens) > size if open_end else F.size(tokens) == size
        for i, mark in enumerate(marks[:size]):
            fits = fits & (F.get(tokens, F.lit(i)) != "") if mark == "*" else fits
        if open_end:
            rest = F.array_join(F.slice(tokens, size + 1, F.greatest(F.size(tokens) - size, F.lit(0))), ".")
            fits = fits & (rest != "")
            at.append(F.lit(">"))
        candidates.append(F.when(fits, F.concat_ws(".", *at)))
    text = F.decode(F.col(value).cast("binary"), "UTF-8")
    # A subject's own ``*`` makes one pattern out of two shapes.
    found = F.array_distinct(F.array_compact(F.array(*candidates))) if candidates else F.array().cast("array<string>")
    return (
        messages.select("*", F.explode(found).alias("pattern"))
        .join(listed, "pattern", "left_semi")
        .select(*messages.columns, "pattern", text.alias("text"))
        .withColumn("data", F.when(is_json(F.col("text")), F.try_parse_json("text")))
    )
