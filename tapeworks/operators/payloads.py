"""Typed columns out of the payload of trade, ticker, depth and book frames.

Payload keys differ only by case (``e``/``E``, ``p``/``P``). They are read by
exact name into a struct that a positional cast then renames, so no column
name is ever ambiguous, whatever the session's case sensitivity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.frames import JSON_OPTIONS
from tapeworks.functions.numbers import from_epoch_ms, to_price

# Payload key -> column, with how its text is read.
TRADE_KEYS = (
    ("E", "event_time", "time"), ("s", "symbol", "text"), ("t", "trade_id", "id"),
    ("p", "price", "number"), ("q", "quantity", "number"), ("b", "buyer_order_id", "id"),
    ("a", "seller_order_id", "id"), ("T", "trade_time", "time"),
    ("m", "is_buyer_maker", "flag"), ("M", "ignore_flag", "flag"),
)
TICKER_KEYS = (
    ("E", "event_time", "time"), ("s", "symbol", "text"), ("p", "price_change", "number"),
    ("P", "price_change_pct", "number"), ("w", "weighted_avg", "number"),
    ("x", "prev_close", "number"), ("c", "last_price", "number"), ("Q", "last_qty", "number"),
    ("b", "bid", "number"), ("B", "bid_qty", "number"), ("a", "ask", "number"),
    ("A", "ask_qty", "number"), ("o", "open", "number"), ("h", "high", "number"),
    ("l", "low", "number"), ("v", "base_volume", "number"), ("q", "quote_volume", "number"),
    ("O", "open_time", "time"), ("C", "close_time", "time"), ("F", "first_id", "id"),
    ("L", "last_id", "id"), ("n", "trade_count", "id"),
)
DEPTH_KEYS = (
    ("E", "event_time", "time"), ("s", "symbol", "text"), ("U", "first_update_id", "id"),
    ("u", "last_update_id", "id"), ("b", "bids", "levels"), ("a", "asks", "levels"),
)
BOOK_KEYS = (
    ("lastUpdateId", "last_update_id", "id"), ("bids", "bids", "levels"), ("asks", "asks", "levels"),
)

# A candle is an object of its own within the frame, under ``k``.
KLINE_KEYS = (
    ("s", "symbol", "text"), ("i", "interval", "text"), ("t", "open_time", "time"), ("T", "close_time", "time"),
    ("f", "first_trade_id", "id"), ("L", "last_trade_id", "id"), ("o", "open", "number"), ("c", "close", "number"),
    ("h", "high", "number"), ("l", "low", "number"), ("v", "volume", "number"), ("n", "trade_count", "id"),
    ("x", "is_closed", "flag"), ("q", "quote_volume", "number"), ("V", "taker_buy_volume", "number"),
    ("Q", "taker_buy_quote_volume", "number"),
)
MARK_PRICE_KEYS = (
    ("E", "event_time", "time"), ("s", "symbol", "text"), ("p", "mark_price", "number"), ("i", "index_price", "number"),
    ("P", "settle_price", "number"), ("r", "funding_rate", "number"), ("T", "next_funding_time", "time"),
)
FUNDING_KEYS = (
    ("E", "event_time", "time"), ("s", "symbol", "text"), ("r", "funding_rate", "number"), ("T", "funding_time", "time"),
)

READ_AS = {
    "text": lambda c: c,
    "number": to_price,
    "id": lambda c: c.try_cast("bigint"),
    "flag": lambda c: c.try_cast("boolean"),
    "time": lambda c: from_epoch_ms(c.try_cast("bigint")),
    "levels": lambda c: F.from_json(c, "array<array<string>>", JSON_OPTIONS),
}


def _typed(routed: DataFrame, keys: tuple, raw: str, keep: tuple[str, ...]) -> DataFrame:
    by_key = ", ".join(f"`{key}` string" for key, _, _ in keys)
    by_name = ", ".join(f"{name}: string" for _, name, _ in keys)
    payload = F.from_json(raw, by_key, JSON_OPTIONS).cast(f"struct<{by_name}>")
    texts = routed.select(*keep, F.inline(F.array(payload)))
    return texts.select(*keep, *[READ_AS[how](F.col(name)).alias(name) for _, name, how in keys])


def _on(suffix: str) -> Column:
    """Frames whose stream is exactly ``<symbol>@<suffix>``."""
    stream = F.col("stream")
    return F.substring(stream, F.instr(stream, "@"), F.length(stream)) == "@" + suffix


def trades(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    chosen = routed.filter(_on(defaults.EVENT_SUFFIXES["trade"]))
    return _typed(chosen, TRADE_KEYS, raw, keep)


def tickers(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    chosen = routed.filter(_on(defaults.EVENT_SUFFIXES["24hrTicker"]))
    return _typed(chosen, TICKER_KEYS, raw, keep)


def klines(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Candles as the exchange sends them, open ones included; see ``is_closed``."""
    chosen = routed.filter(_on("kline")).withColumn("_candle", F.get_json_object(raw, "$.k"))
    return _typed(chosen, KLINE_KEYS, "_candle", keep)


def mark_prices(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    chosen = routed.filter(_on(defaults.EVENT_SUFFIXES["markPriceUpdate"]))
    return _typed(chosen, MARK_PRICE_KEYS, raw, keep)


def funding_rates(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    chosen = routed.filter(_on(defaults.EVENT_SUFFIXES["fundingRate"]))
    return _typed(chosen, FUNDING_KEYS, raw, keep)


def depth_updates(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Depth diffs. They share a stream with partial books and differ by event type."""
    chosen = routed.filter(_on(defaults.BOOK_SUFFIX) & (F.col("event") == "depthUpdate"))
    return _typed(chosen, DEPTH_KEYS, raw, keep)


def books(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Partial books; their symbol is that of the stream they were routed to."""
    chosen = routed.filter(
        _on(defaults.BOOK_SUFFIX)
        & F.coalesce(F.col("event") != "depthUpdate", F.lit(True))
    )
    return _typed(chosen, BOOK_KEYS, raw, ("stream", *keep))


def _sides(keep: tuple[str, ...], rows: DataFrame) -> DataFrame:
    side = lambda name: F.transform(
        F.coalesce(F.col(name), F.array().cast("array<array<string>>")),
        lambda pair, pos: F.struct(
            F.lit(name.rstrip("s")).alias("side"),
            pos.alias("level"),
            to_price(F.get(pair, 0)).alias("price"),
            to_price(F.get(pair, 1)).alias("quantity"),
        ),
    )
    return rows.select(*keep, F.inline(F.concat(side("bids"), side("asks"))))


def levels_of(typed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``side, level, price, quantity``; level 0 is the first listed."""
    return _sides(keep, typed)


def book_levels(routed: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Levels of depth diffs and partial books alike, in one pass over the frames."""
    chosen = routed.filter(_on(defaults.BOOK_SUFFIX))
    keys = [(key, f"{name}_{i}", how) for i, table in enumerate((DEPTH_KEYS, BOOK_KEYS))
            for key, name, how in table if how == "levels"]
    is_diff = F.coalesce(F.col("event") == "depthUpdate", F.lit(False))
    typed = _typed(chosen.withColumn("_is_diff", is_diff), tuple(keys), raw, (*keep, "_is_diff"))
    pick = lambda name: F.when(F.col("_is_diff"), F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))
    return _sides(keep, typed.select(*keep, pick("bids").alias("bids"), pick("asks").alias("asks")))
