"""The published envelope and its timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.frames import one_line

TRACE_FIELD = "_otel_trace_context"


# Date, one separator, time down to at least minutes, optional UTC offset.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([+-]\d{2}:\d{2})?)?$"
)


def parse_envelope_ts(value: Column) -> Column:
    """ISO-8601 text, with or without one trailing ``Z``, as a UTC timestamp."""
    text = F.regexp_replace(value, "Z$", "")
    return F.when(F.regexp_like(text, F.lit(ISO_PATTERN)), F.try_to_timestamp(text))


def format_envelope_ts(ts: Column) -> Column:
    """ISO-8601 with ``Z``; microseconds are left out when they are zero."""
    whole = F.unix_micros(ts) % 1000000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )


def random_message_id() -> Column:
    """A fresh id per evaluation, for live publishing."""
    return F.uuid()


def stable_message_id(*parts: Column) -> Column:
    """An id that replaying the same frame gives again."""
    return F.sha2(F.concat_ws("~", *[p.cast("string") for p in parts]), 256)


def envelope(
    stream: Column, raw: Column, ts: Column, message_id: Column, trace: Column | None = None
) -> Column:
    """Envelope struct; ``data`` stays the raw JSON text of the frame."""
    trace = F.lit(None) if trace is None else trace
    return F.struct(
        stream.alias("stream"),
        raw.alias("data"),
        ts.alias("timestamp"),
        message_id.alias("message_id"),
        F.lit(defaults.ENVELOPE_SOURCE).alias("source"),
        F.lit(defaults.ENVELOPE_VERSION).alias("version"),
        trace.cast("map<string,string>").alias(TRACE_FIELD),
    )


def _quoted(text: Column) -> Column:
    """A string as JSON, escaped by the JSON writer: ``["x"]`` without brackets."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNull(), F.lit("null")).otherwise(
        F.substring(listed, F.lit(2), F.length(listed) - 2)
    )


def envelope_json(env: Column) -> Column:
    """Envelope as one line of JSON, with the frame spliced in as it was received.

    ``to_json`` on a parsed frame would turn nested arrays into strings and
    renumber floats, so the raw text goes in, but for line breaks and numbers
    that are not finite. The trace map is left out when there is none.
    """
    trace = env[TRACE_FIELD]
    return F.concat(
        F.lit('{"stream":'),
        _quoted(env["stream"]),
        F.lit(',"data":'),
        one_line(env["data"]),
        F.lit(',"timestamp":"'),
        format_envelope_ts(env["timestamp"]),
        F.lit('","message_id":'),
        _quoted(env["message_id"]),
        F.lit(',"source":'),
        _quoted(env["source"]),
        F.lit(',"version":'),
        _quoted(env["version"]),
        F.when(trace.isNull(), F.lit("")).otherwise(
            F.concat(F.lit(f',"{TRACE_FIELD}":'), F.to_json(trace))
        ),
        F.lit("}"),
    )
