"""Stream ids: naming the stream of a frame, taking ids apart, checking them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.frames import display_text, is_truthy


def routing_keys(e_type: Column, e_text: Column, s_type: Column, s_text: Column) -> dict[str, Column]:
    """``event`` and ``symbol``, NULL where the key is missing or its value false.

    ``odd_symbol`` marks a symbol that is there but no string.
    """
    return {
        "event": F.when(is_truthy(e_type, e_text), display_text(e_type, e_text)),
        "symbol": F.when((s_type == "STRING") & (s_text != ""), F.lower(s_text)),
        "odd_symbol": (s_type != "STRING") & is_truthy(s_type, s_text),
    }


def route_stream(
    event: Column,
    symbol: Column,
    odd_symbol: Column,
    is_book: Column,
    subscriptions: Sequence[str] = defaults.DEFAULT_STREAMS,
) -> Column:
    """Logical stream of a frame, NULL where none can be determined.

    Three lossy results are part of the contract: a partial book without a
    symbol takes the symbol of the *first* subscription, ``kline`` frames lose
    their interval, and a combined-stream wrapper has no stream.
    """
    nothing = F.lit(None).cast("string")
    book_suffix = F.lit("@" + defaults.BOOK_SUFFIX)
    first = subscriptions[0] if subscriptions else ""
    routed = F.when(odd_symbol, nothing).when(
        is_book & symbol.isNotNull(), F.concat(symbol, book_suffix)
    )
    if "@" in first:
        routed = routed.when(is_book, F.concat(F.lit(first.split("@")[0]), book_suffix))
    for event_type, suffix in defaults.EVENT_SUFFIXES.items():
        routed = routed.when(event == event_type, F.concat(symbol, F.lit("@" + suffix)))
    return routed.otherwise(F.concat(symbol, F.lit("@"), event))


def message_kind(stream: Column) -> Column:
    """trade, ticker, depth or generic: first marker found in the stream id."""
    kind = F.lit(defaults.GENERIC_KIND)
    for marker, name in reversed(defaults.KIND_MARKERS):
        kind = F.when(F.contains(stream, F.lit(marker)), F.lit(name)).otherwise(kind)
    return F.when(stream.isNotNull(), kind)


def stream_symbol(stream: Column) -> Column:
    return F.substring_index(stream, "@", 1)


def stream_type(stream: Column) -> Column:
    return F.try_element_at(F.split(stream, "@"), F.lit(2))


def landed_type(stream: Column) -> Column:
    """The stream type if it is a known one, else ``other``."""
    kind = stream_type(stream)
    return F.when(kind.isin(list(defaults.LANDED_TYPES)), kind).otherwise("other")


def stream_qualifier(stream: Column) -> Column:
    """Whatever follows the stream type (a speed or interval), else NULL."""
    parts = F.split(stream, "@")
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 3, 2147483647), "@"))


def stream_format_ok(stream: Column) -> Column:
    """At least one ``@`` and a symbol with a cased letter, none upper-case."""
    symbol = stream_symbol(stream)
    return F.coalesce(
        F.contains(stream, F.lit("@"))
        & (symbol == F.lower(symbol))
        & (symbol != F.upper(symbol)),
        F.lit(False),
    )
