"""From raw frames to routed frames, with one disposition for each."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions import envelope as env
from tapeworks.functions import frames as fr
from tapeworks.functions import routing

DISPOSITIONS = (
    "malformed_json",
    "queue_full",
    "invalid_format",
    "unknown_stream",
    "not_connected",
    "publish_error",
    "published",
)
COUNTED_AS_DROPPED = ("queue_full", "not_connected")

# Subscriptions to a partial book, whatever its depth and speed.
ANY_BOOK = r"@depth[0-9]*(@[0-9]+ms)?$"

OBJECT, OTHER_JSON, MALFORMED = "object", "other_json", "malformed"


ROUTING_KEYS = ("is_object", "event", "symbol", "odd_symbol", "is_book")


def parse(frames: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``shape`` and the routing keys ``is_object, event, symbol, odd_symbol, is_book``.

    What the keys are made of is generated with ``inline`` rather than
    projected: a filter on the result is then evaluated after the parse, while
    a projection would have it pushed below and the JSON read again for it.
    The text to parse is projected first, where it is compiled code.
    """
    text = F.col(raw)
    probed = frames.withColumn("_probe", fr.object_probe(text))
    facts = F.transform(F.array(fr.parsed_probe(F.col("_probe"))), lambda f: fr.frame_facts(f, text))
    parsed = probed.select(*frames.columns, F.inline(facts))
    shape = F.when(F.col("is_object"), OBJECT).when(fr.is_other_json(text), OTHER_JSON).otherwise(MALFORMED)
    fields = ("e_type", "e_text", "s_type", "s_text")
    keys = routing.routing_keys(*[F.col(c) for c in fields])
    return parsed.withColumns({"shape": shape, **keys}).drop(*fields)


def route(parsed: DataFrame, subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS) -> DataFrame:
    """Replace the routing keys, but for ``event``, by ``stream``, NULL where there is none."""
    keys = [F.col(c) for c in ROUTING_KEYS[1:]]
    stream = F.when(F.col("is_object"), routing.route_stream(*keys, subscriptions))
    return parsed.withColumn("stream", stream).drop(*[k for k in ROUTING_KEYS if k != "event"])


def classify(
    frames: DataFrame,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
    queue_full: Column | None = None,
    not_connected: Column | None = None,
    publish_error: Column | None = None,
    raw: str = "raw",
) -> DataFrame:
    """Frames with ``shape``, ``stream`` and ``disposition``.

    The three optional conditions report what happened outside the frame
    itself (shed by a bounded intake, sink away, sink failed).
    """
    happened = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    routed = route(parse(frames, raw), subscriptions)
    disposition = (
        F.when(F.col("shape") == MALFORMED, "malformed_json")
        .when(happened(queue_full), "queue_full")
        .when(F.col("shape") == OTHER_JSON, "invalid_format")
        .when(F.col("stream").isNull(), "unknown_stream")
        .when(happened(not_connected), "not_connected")
        .when(happened(publish_error), "publish_error")
        .otherwise("published")
    )
    return routed.withColumn("disposition", disposition)


def rejected(classified: DataFrame, disposition: str) -> DataFrame:
    """Frames that ended in one given way."""
    return classified.filter(F.col("disposition") == disposition)


def published(classified: DataFrame) -> DataFrame:
    return rejected(classified, "published")


def disposition_counts(classified: DataFrame) -> DataFrame:
    """Frames per disposition, all seven always listed so that totals reconcile."""
    outcomes = F.explode(F.array(*[F.lit(d) for d in DISPOSITIONS])).alias("disposition")
    every = classified.sparkSession.range(1).select(outcomes, F.lit(0).cast("bigint").alias("n"))
    seen = classified.groupBy("disposition").agg(F.count("*").alias("n"))
    return every.unionByName(seen).groupBy("disposition").agg(F.sum("n").alias("frames"))


def within_size(frames: DataFrame, max_bytes: int = defaults.MAX_MESSAGE_BYTES, raw: str = "raw") -> DataFrame:
    return frames.filter(F.octet_length(raw) <= max_bytes)


def subscribed_only(routed: DataFrame, subscriptions: Sequence[str] | DataFrame, raw: str = "raw") -> DataFrame:
    """Frames of subscribed streams.

    Frames don't say all that a subscription does. The interval of candles is
    in the frame rather than in the stream's name, and books of any depth
    and speed come as one stream; so those match on symbol and interval, and on
    symbol alone.

    A list becomes a literal filter, which reaches a columnar scan. A table of
    subscriptions becomes a semi join; whether it is broadcast is left to
    Spark, which decides on the table's actual size.
    """
    stream = F.col("stream")
    with_interval = F.concat(stream, F.lit("_"), F.get_json_object(raw, "$.k.i"))
    if isinstance(subscriptions, DataFrame):
        wanted = F.regexp_replace("stream", ANY_BOOK, "@" + defaults.BOOK_SUFFIX)
        named = routed.withColumn("_named", F.when(stream.endswith("@kline"), with_interval).otherwise(stream))
        return named.join(subscriptions.select(wanted.alias("_named")), "_named", "left_semi").select(*routed.columns)
    wanted = [re.sub(ANY_BOOK, "@" + defaults.BOOK_SUFFIX, s) for s in subscriptions]
    klines = [s for s in wanted if "@kline_" in s]
    plain = [s for s in wanted if "@kline_" not in s]
    candidates = stream.isin(plain + [s.split("_")[0] for s in klines])
    return routed.filter(candidates & (~stream.endswith("@kline") | with_interval.isin(klines)))


def validate_messages(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``error``, NULL for a valid message: ``stream`` and ``data`` are required.

    A missing field is reported before a badly typed one, and ``stream``
    before ``data``. A timestamp in the input does not matter.
    """
    text = F.col(raw)
    fields = "stream variant, data variant, message_id variant"
    known = messages.select("*", F.inline(F.array(fr.parsed_object(text, fields))))
    stream, data, message_id = F.col("stream"), F.col("data"), F.col("message_id")
    missing = lambda name: F.lit(f"Missing required field: '{name}'")
    invalid = lambda why: F.lit(f"Invalid message format: {why}")
    error = (
        F.when(~fr.is_object(text, F.col(fr.TAIL_KEY)), invalid("not an object"))
        .when(stream.isNull(), missing("stream"))
        .when(data.isNull(), missing("data"))
        .when(fr.json_type(stream) != "STRING", invalid("stream is not a string"))
        .when(~F.startswith(fr.json_type(data), F.lit("OBJECT")), invalid("data is not an object"))
        .when(~fr.json_type(message_id).isin("STRING", "VOID"), invalid("message_id is not a string"))
    )
    return known.withColumn("error", error).drop("stream", "data", "message_id", fr.TAIL_KEY)


def missing_fields(
    messages: DataFrame, required: Sequence[str] = defaults.REQUIRED_FIELDS, raw: str = "raw"
) -> DataFrame:
    """Add ``missing``: required keys a message does not have, in order."""
    text = F.col(raw)
    fields = ", ".join(f"`{name}` variant" for name in required)
    parsed = F.col("_parsed")
    absent = [F.when(parsed[name].isNull(), F.lit(name)) for name in required]
    held = messages.select("*", F.explode(F.array(fr.parsed_object(text, fields))).alias("_parsed"))
    return held.withColumn("missing", F.array_compact(F.array(*absent))).drop("_parsed")


def attach_envelope(
    routed: DataFrame,
    ts: str = "recv_ts",
    raw: str = "raw",
    message_id: Column | None = None,
    trace: Column | None = None,
) -> DataFrame:
    """Add ``envelope`` to published frames; the id defaults to a random one."""
    identity = env.random_message_id() if message_id is None else message_id
    return routed.withColumn(
        "envelope", env.envelope(F.col("stream"), F.col(raw), F.col(ts), identity, trace)
    )
