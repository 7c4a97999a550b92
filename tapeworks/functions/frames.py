"""Reading one raw JSON frame, as column expressions.

A frame is parsed once, into the handful of fields routing needs. They are
read as VARIANT because routing depends on JSON types and on whether a key is
present at all: SQL NULL means "no such key", a VARIANT null means
``"key": null``, and ``1`` stays distinct from ``"1"``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_WHITESPACE = " \t\n\r"
JSON_OPTIONS = {"allowSingleQuotes": "false"}

# Last key of the parsed object, see ``parsed_object``.
TAIL_KEY = "~tail"

ROUTING_FIELDS = "e variant, s variant, lastUpdateId variant, bids variant, asks variant"


def _body(raw: Column) -> Column:
    """The frame without surrounding JSON whitespace; most frames have none."""
    tight = F.startswith(raw, F.lit("{")) & F.endswith(raw, F.lit("}"))
    return F.when(tight, raw).otherwise(F.btrim(raw, F.lit(JSON_WHITESPACE)))


def looks_like_object(raw: Column) -> Column:
    return F.substring(_body(raw), 1, 1) == "{"


def object_probe(raw: Column) -> Column:
    """An object frame with one more field, ``~tail``, holding a hash of the frame.

    Spark's JSON reader stops at the end of the first value, so text after it
    goes unnoticed. The extra field takes the place of the closing brace: the
    reader only gets to see it if everything before the last brace was one
    well-formed object. NULL for a frame that does not begin like an object.
    """
    body = _body(raw)
    extended = F.concat(
        F.substring(body, F.lit(1), F.length(body) - 1),
        F.lit(f',"{TAIL_KEY}":'),
        F.xxhash64(raw).cast("string"),
        F.lit("}"),
    )
    return F.when(looks_like_object(raw), extended)


def parsed_probe(probe: Column, fields: str = ROUTING_FIELDS) -> Column:
    """Chosen fields of a probe, ``~tail`` set only if all of it could be read."""
    return F.from_json(probe, f"{fields}, `{TAIL_KEY}` bigint", JSON_OPTIONS)


def parsed_object(raw: Column, fields: str = ROUTING_FIELDS) -> Column:
    return parsed_probe(object_probe(raw), fields)


def is_object(raw: Column, tail: Column) -> Column:
    """Whether the frame is exactly one JSON object."""
    empty = F.regexp_like(_body(raw), F.lit(r"^\{[ \t\n\r]*\}$"))
    return F.coalesce(tail == F.xxhash64(raw), F.lit(False)) | F.coalesce(empty, F.lit(False))


def is_other_json(raw: Column) -> Column:
    """Whether a frame that is no object is still one valid JSON value.

    The frame is put into an array in front of a hash of itself. Only if the
    frame is one complete value does the array have that hash as second item.
    """
    wrapped = F.concat(F.lit("["), raw, F.lit(',"'), F.xxhash64(raw).cast("string"), F.lit('"]'))
    items = F.from_json(
        F.when(~looks_like_object(raw), wrapped), "array<string>", JSON_OPTIONS
    )
    second = F.try_element_at(items, F.lit(2))
    return F.coalesce((F.size(items) == 2) & (second == F.xxhash64(raw).cast("string")), F.lit(False))


def is_json(raw: Column) -> Column:
    """Whether a text is exactly one JSON value."""
    return is_object(raw, parsed_object(raw)[TAIL_KEY]) | is_other_json(raw)


# Up to and with a number that is not finite: strings, closed or not, are passed as
# a whole. Every part is possessive, so a text is gone through once, whatever its length.
NOT_FINITE = "[+-]?(?:NaN|Infinity|INF)"
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"?+'
UP_TO_NOT_FINITE = rf'(?s)\G((?:[^"\\NI+-]++|{STRING}|\\["\\]?+|(?!{NOT_FINITE})[NI+-])*+){NOT_FINITE}'


def one_line(raw: Column) -> Column:
    """A well-formed frame as one line of strict JSON, otherwise unchanged.

    Line breaks are mere space in JSON, as inside strings they are escaped.
    Numbers that are not finite, which JSON has no form for, become null; they
    are looked for between strings only.
    """
    line = F.replace(F.replace(raw, F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    named = [F.contains(line, F.lit(word)) for word in ("NaN", "Infinity", "INF")]
    return F.when(named[0] | named[1] | named[2], F.regexp_replace(line, UP_TO_NOT_FINITE, "$1null")).otherwise(line)


def json_type(value: Column) -> Column:
    """Spark type name of a VARIANT: ``STRING``, ``VOID`` for null, SQL NULL if absent."""
    return F.schema_of_variant(value)


def string_value(value: Column) -> Column:
    """The text of a JSON string, NULL for a value of any other type."""
    return F.when(json_type(value) == "STRING", value.cast("string"))


def is_truthy(kind: Column, text: Column) -> Column:
    """Python truth of a JSON value: null, "", 0, false, [] and {} are false."""
    return (
        F.when(kind == "STRING", text != "")
        .when(kind.isNull() | (kind == "VOID"), False)
        .when(kind == "BOOLEAN", text == "true")
        .when(F.startswith(kind, F.lit("ARRAY")), text != "[]")
        .when(F.startswith(kind, F.lit("OBJECT")), text != "{}")
        .otherwise(F.coalesce(text.try_cast("double") != 0, F.lit(True)))
    )


def display_text(kind: Column, text: Column) -> Column:
    """A JSON value inside a stream name: strings verbatim, true as ``True``."""
    return F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)


def frame_facts(frame: Column, raw: Column) -> Column:
    """What is needed of a parsed frame: whether it is an object, types and texts
    of ``e`` and ``s``, and whether the keys of a book are there."""
    e, s = frame["e"], frame["s"]
    book = [frame[name].isNotNull() for name in ("lastUpdateId", "bids", "asks")]
    return F.struct(
        is_object(raw, frame[TAIL_KEY]).alias("is_object"),
        json_type(e).alias("e_type"),
        e.cast("string").alias("e_text"),
        json_type(s).alias("s_type"),
        s.cast("string").alias("s_text"),
        (book[0] & book[1] & book[2]).alias("is_book"),
    )
