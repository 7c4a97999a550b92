"""Numbers, times and small text builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks import defaults

PRICE = "decimal(38,18)"


def to_price(text: Column) -> Column:
    """Decimal text as an exact number, NULL where it is none."""
    return text.try_cast(PRICE)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def per_second(count: Column, elapsed_ms: Column) -> Column:
    """``count`` per second to two places, half up; 0 when no time has passed.

    Worked out in whole hundredths, so it does not depend on how a binary
    fraction happens to round.
    """
    hundredths = F.expr("0L") + (count * 200000 + elapsed_ms)
    whole = F.call_function("div", hundredths, elapsed_ms * 2)
    return F.when(elapsed_ms > 0, whole / F.lit(100.0)).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent to two places, half up; 0 of nothing."""
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return F.when(whole > 0, hundredths / F.lit(100.0)).otherwise(F.lit(0.0))


def backoff_schedule(
    delay: Column | int = defaults.RECONNECT_DELAY_SECONDS,
    max_attempts: Column | int = defaults.MAX_RECONNECT_ATTEMPTS,
) -> Column:
    """Seconds to wait before each attempt: ``delay * 2**attempt``, as an array."""
    delay, attempts = (c if isinstance(c, Column) else F.lit(c) for c in (delay, max_attempts))
    steps = F.when(attempts > 0, F.sequence(F.lit(0), attempts.cast("int") - 1))
    waits = F.transform(steps, lambda i: (delay * F.pow(F.lit(2.0), i)).cast("double"))
    return F.coalesce(waits, F.array().cast("array<double>"))


def subject(
    prefix: str, extraction_type: Column, symbol: Column | None, period: Column
) -> Column:
    """``prefix.type.symbol.period``, or ``prefix.type.batch.period`` for a batch."""
    middle = F.lit("batch") if symbol is None else symbol
    return F.concat_ws(".", F.lit(prefix), extraction_type, middle, period)
