"""Validation of configuration requests, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import frames as fr
from tapeworks.functions.routing import stream_format_ok

ERROR = "struct<field:string,message:string,code:string,suggested_value:string>"

# Type -> (field, lowest, highest, unit in the message, suggestion).
INTEGER_RULES = {
    "reconnection": (
        ("reconnect_delay", 1, 300, " seconds", 5),
        ("max_reconnect_attempts", 1, 100, "", 10),
    ),
    "circuit_breaker": (
        ("failure_threshold", 1, 50, "", 5),
        ("recovery_timeout", 10, 600, " seconds", 60),
    ),
}

# Type -> (risk, scope, message).
IMPACTS = {
    "reconnection": (
        "low", "reconnection behavior", "Changing reconnection config affects connection reliability",
    ),
    "circuit_breaker": (
        "medium", "circuit breaker behavior", "Changing circuit breaker config affects error handling",
    ),
}
STREAMS_IMPACT = ("low", "Changing streams will affect WebSocket subscriptions")

# Request field -> (lowest, highest).
REQUEST_RANGES = {
    "reconnect_delay": (1, 300),
    "max_reconnect_attempts": (1, 100),
    "backoff_multiplier": (1.0, 10.0),
    "failure_threshold": (1, 50),
    "recovery_timeout": (10, 600),
    "half_open_max_calls": (1, 10),
}

PARAMETER_FIELDS = (
    "streams", "reconnect_delay", "max_reconnect_attempts", "failure_threshold", "recovery_timeout",
)


def _error(field: str, message: Column | str, code: str, suggested: Column | str | None) -> Column:
    as_text = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        F.lit(field).alias("field"),
        as_text(message).alias("message"),
        F.lit(code).alias("code"),
        as_text(suggested).cast("string").alias("suggested_value"),
    )


def _is_vast(value: Column) -> Column:
    """Whether a JSON value is an integer beyond 64 bits."""
    return F.coalesce(fr.json_type(value).rlike(r"^DECIMAL\((19|2\d|3\d),0\)$"), F.lit(False))


def _as_integer(value: Column) -> Column:
    """Value of a JSON integer; true and false count as 1 and 0; else NULL."""
    kind, text = fr.json_type(value), value.cast("string")
    return F.when(kind == "BIGINT", text.try_cast("bigint")).when(
        kind == "BOOLEAN", (text == "true").cast("bigint")
    )


def _integer_error(value: Column, field: str, low: int, high: int, unit: str, default: int) -> Column:
    number = _as_integer(value)
    absent = value.isNull() | (fr.json_type(value) == "VOID")
    wrong_type = _error(field, "Must be an integer", "INVALID_TYPE", str(default))
    out_of_range = _error(field, f"Must be between {low} and {high}{unit}", "OUT_OF_RANGE", str(default))
    return F.when(absent, F.lit(None)).when(_is_vast(value), out_of_range).when(number.isNull(), wrong_type).when(
        ~number.between(low, high), out_of_range
    )


def _python_type(value: Column) -> Column:
    kind = fr.json_type(value)
    return (
        F.when(kind == "VOID", "NoneType")
        .when(kind == "BOOLEAN", "bool")
        .when((kind == "BIGINT") | _is_vast(value), "int")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "dict")
        .otherwise("float")
    )


def _stream_error(value: Column) -> Column:
    text = fr.string_value(value)
    shown = F.when(fr.json_type(value) == "VOID", "None").otherwise(fr.display_text(fr.json_type(value), value.cast("string")))
    not_text = _error(
        "streams",
        F.concat(F.lit("Stream must be a string, got "), _python_type(value)),
        "INVALID_TYPE",
        shown,
    )
    bad_format = _error(
        "streams",
        F.concat(F.lit("Invalid stream format: "), text),
        "INVALID_FORMAT",
        F.nullif(F.lower(text), F.lit("")),
    )
    return F.when(text.isNull(), not_text).when(~stream_format_ok(text), bad_format)


def _present(errors: Column) -> Column:
    return F.filter(errors, lambda e: e.isNotNull())


def suggested_fixes(errors: Column) -> Column:
    """``Set field to value`` for every error that suggests a value."""
    return F.transform(
        F.filter(errors, lambda e: e["suggested_value"].isNotNull()),
        lambda e: F.concat(F.lit("Set "), e["field"], F.lit(" to "), e["suggested_value"]),
    )


def validate_config(requests: DataFrame, config_type: str = "config_type", parameters: str = "parameters") -> DataFrame:
    """Add the validation result of each request, given its JSON parameters.

    Columns: ``validation_passed, errors, warnings, suggested_fixes,
    risk_level, affected_scope, impact, conflicts``. Where ``streams`` is a
    number, a boolean or null the service itself fails internally; those rows
    have ``validation_passed`` and ``errors`` NULL.
    """
    fields = ", ".join(f"{name} variant" for name in PARAMETER_FIELDS)
    known = requests.select("*", F.inline(F.array(fr.parsed_object(F.col(parameters), fields)))).drop(
        fr.TAIL_KEY
    )
    kind, streams = F.col(config_type), F.col("streams")
    stream_kind = fr.json_type(streams)
    is_list = F.coalesce(stream_kind.startswith("ARRAY"), F.lit(False))
    items = F.when(is_list, streams.try_cast("array<variant>"))
    none = F.array().cast(f"array<{ERROR}>")
    no_list = F.array(_error("streams", "Streams must be a list", "INVALID_TYPE", "[]"))
    stream_errors = (
        F.when(streams.isNull(), none)
        .when(is_list, _present(F.transform(items, _stream_error)))
        .otherwise(no_list)
    )
    unknown = F.array(
        _error(
            "config_type", F.concat(F.lit("Unknown config type: "), kind), "INVALID_VALUE", "streams"
        )
    )
    errors = F.when(kind == "streams", stream_errors)
    for name, rules in INTEGER_RULES.items():
        checks = [_integer_error(F.col(rule[0]), *rule) for rule in rules]
        errors = errors.when(kind == name, _present(F.array(*checks)))
    length = (
        F.when(streams.isNull(), F.lit(0))
        .when(is_list, F.size(items))
        .when(stream_kind == "STRING", F.length(streams.cast("string")))
        .when(
            stream_kind.startswith("OBJECT"), F.size(streams.try_cast("map<string,variant>"))
        )
    )
    broken = (kind == "streams") & length.isNull()
    checked = known.withColumn("errors", F.when(~broken, errors.otherwise(unknown)))
    impacts = lambda i, first: reduce(
        lambda c, n: c.when(kind == n, F.lit(IMPACTS[n][i])), IMPACTS, F.when(kind == "streams", first)
    )
    return (
        checked.withColumn("validation_passed", F.size("errors") == 0)
        .withColumn("validation_passed", F.when(F.col("errors").isNotNull(), F.col("validation_passed")))
        .withColumn("warnings", F.array().cast("array<string>"))
        .withColumn("suggested_fixes", suggested_fixes(F.col("errors")))
        .withColumn("risk_level", impacts(0, F.lit(STREAMS_IMPACT[0])))
        .withColumn("affected_scope", impacts(1, F.concat(length.cast("string"), F.lit(" streams"))))
        .withColumn("impact", impacts(2, F.lit(STREAMS_IMPACT[1])))
        .withColumn("conflicts", F.array().cast("array<string>"))
        .drop(*PARAMETER_FIELDS)
    )


def request_ranges(requests: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Add ``out_of_range`` and ``missing`` (field names) and ``error_count``.

    ``required`` fields are missing where NULL, or everywhere without such a column.
    """
    absent = [F.when(F.col(f).isNull(), F.lit(f)) if f in requests.columns else F.lit(f) for f in required]
    outside = [
        F.when(~F.col(field).between(low, high), F.lit(field))
        for field, (low, high) in REQUEST_RANGES.items()
        if field in requests.columns
    ]
    named = lambda names: F.array_compact(F.array(*names)).cast("array<string>")
    return requests.withColumns({"out_of_range": named(outside), "missing": named(absent)}).withColumn(
        "error_count", F.size("out_of_range") + F.size("missing")
    )


def update_outcome(
    requests: DataFrame,
    config_type: str = "config_type",
    streams: str = "streams",
    validate_only: str = "validate_only",
    in_range: Column | None = None,
) -> DataFrame:
    """Add ``outcome`` (applied, validated, rejected), ``success`` and ``message``.

    A stream list is rejected for its first badly formed stream. Requests of
    the other types are rejected where ``in_range`` does not hold.
    """
    bad = F.get(F.filter(F.col(streams), lambda s: ~stream_format_ok(s)), 0)
    dry = F.coalesce(F.col(validate_only), F.lit(False))
    kind = F.col(config_type)
    is_streams = kind == "streams"
    bad_stream = is_streams & bad.isNotNull()
    bad_range = ~is_streams & ~(F.lit(True) if in_range is None else in_range)
    label = F.when(is_streams, "Streams").when(kind == "reconnection", "Reconnection config").otherwise(
        "Circuit breaker config"
    )
    verb = F.when(is_streams, " are").otherwise(" is")
    suffix = F.when(dry, " (validate_only=true)").otherwise("")
    return requests.select(
        "*",
        F.when(bad_stream | bad_range, "rejected").when(dry, "validated").otherwise("applied").alias("outcome"),
        (~bad_range & (~bad_stream | dry)).alias("success"),
        F.when(bad_stream, F.concat(F.lit("Invalid stream format: "), bad, suffix))
        .when(bad_range, F.lit("Field out of range"))
        .when(dry, F.concat(label, verb, F.lit(" valid but not saved (validate_only=true)")))
        .otherwise(F.concat(label, F.lit(" updated")))
        .alias("message"),
    )
