"""Order-dependent rules on a stream, with their state in the state store.

Rows of a key arrive in no particular order. They are kept by time slot until the
watermark has passed the slot, when no earlier row can come any more. Each slot has
a timer; only slots that are due are read, and folded in (time, seq) order. So a
trigger's work follows the rows that come and those that become ready, not those that
wait. The results are those of the batch operators over the rows
that arrive within the watermark delay. Later rows are dropped and counted, see
``observe.RunningTotals``. Rows without a key share a history of their own; rows
without a time are part of none and come back at once. These queries need the
RocksDB state store, see ``state_store_conf``.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tapeworks import defaults
from tapeworks.operators import breaker, bucket, folds

WAITING = "us array<bigint>, seq array<bigint>, flag array<boolean>, counted array<boolean>"
SLOT_MS = 1000


def state_store_conf() -> dict[str, str]:
    return {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    }


class OrderedFold(StatefulProcessor):
    """Folds a key's rows in time order as the watermark passes them.

    ``step(state, us, seq, flag, counted)`` returns the next state and either
    a row of ``columns`` or None.
    """

    def __init__(self, initial: tuple, state_schema: str, columns: list[str]):
        self.initial, self.state_schema, self.columns = initial, state_schema, columns

    def step(self, state: tuple, us: int, seq: int, flag: bool, counted: bool) -> tuple:
        raise NotImplementedError

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema)
        self.waiting = handle.getMapState("waiting", "slot bigint", WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for slot, part in batch.groupby(batch["us"] // (SLOT_MS * 1000), sort=False):
                name, lists = (int(slot),), [part[c].tolist() for c in ("us", "seq", "flag", "counted")]
                if self.waiting.containsKey(name):
                    lists = [list(old) + new for old, new in zip(self.waiting.getValue(name), lists)]
                else:
                    self.handle.registerTimer((int(slot) + 1) * SLOT_MS)
                self.waiting.updateValue(name, tuple(lists))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot = (expiredTimerInfo.getExpiryTimeInMs() // SLOT_MS - 1,)
        ready = sorted(zip(*self.waiting.getValue(slot)))
        self.waiting.removeKey(slot)
        state = tuple(self.state.get()) if self.state.exists() else self.initial
        out = []
        for us, seq, flag, counted in ready:
            state, result = self.step(state, us, seq, flag, counted)
            if result is not None:
                out.append((key[0], us, seq, *result))
        self.state.update(state)
        if out:
            # Numbers that may be missing stay whole numbers.
            yield pd.DataFrame(out, columns=["key", "us", "seq", *self.columns]).convert_dtypes()

    def close(self) -> None:
        pass


class _Breaker(OrderedFold):
    def __init__(self, threshold: int, recovery_seconds: int):
        super().__init__(
            (breaker.CLOSED, 0, 0),
            "state string, failed_at bigint, failures bigint",
            ["state_before", "state_after", "result", "failure_count"],
        )
        self.threshold, self.recovery = threshold, recovery_seconds * 1_000_000

    def step(self, state, us, seq, flag, counted):
        after, result = breaker.step(state, us, flag, counted, self.threshold, self.recovery)
        return after, (state[0], after[0], result, after[2])


class _Bucket(OrderedFold):
    def __init__(self, capacity: int, rate_per_second: int | str | Fraction):
        super().__init__((0, 0), "backlog bigint, us bigint", ["dropped", "backlog_units"])
        self.unit, self.drain = bucket.units(rate_per_second)
        self.room = (capacity - 1) * self.unit

    def step(self, state, us, seq, flag, counted):
        backlog = max(0, state[0] - self.drain * (us - state[1]))
        dropped = backlog > self.room
        backlog += 0 if dropped else self.unit
        return (backlog, us), (dropped, backlog)


class _Outage(OrderedFold):
    def __init__(self, delay: int, max_attempts: int):
        super().__init__(
            (0, 0), "episode bigint, failures bigint", ["episode", "attempt", "expected_delay", "outcome"]
        )
        self.delay, self.most = delay, max_attempts

    def step(self, state, us, seq, flag, counted):
        episode, attempt = state
        wait = self.delay * 2**attempt if attempt < self.most else None
        if flag:
            outcome = "steady" if attempt == 0 else "recovered" if attempt < self.most else "restarted"
            return (episode + 1, 0), (episode, attempt, wait, outcome)
        outcome = "failed" if attempt + 1 < self.most else "gave_up" if attempt + 1 == self.most else "stopped"
        return (episode, attempt + 1), (episode, attempt, wait, outcome)


class _Throttle(OrderedFold):
    def __init__(self, start_ms: int, gap_seconds: int):
        super().__init__(
            (start_ms * 1000, 0, 0),
            "since bigint, processed bigint, dropped bigint",
            ["processed", "dropped"],
        )
        self.gap = gap_seconds * 1_000_000

    def step(self, state, us, seq, flag, counted):
        since, processed, dropped = state
        if not flag:
            return (since, processed, dropped + 1), None
        if us - since >= self.gap:
            return (us, processed + 1, dropped), (processed + 1, dropped)
        return (since, processed + 1, dropped), None


def _fold(
    rows: DataFrame, processor: OrderedFold, key: str, ts: str, seq: str, delay: str,
    flag: Column, counted: Column, columns: str, no_time: dict[str, Column] | None = None,
) -> DataFrame:
    """``no_time``: what rows without a time come back with; they are left out if it is not given."""
    narrow = rows.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        folds.encoded(F.col(key)).alias("key"),
        F.col(ts),
        F.unix_micros(ts).alias("us"),
        F.col(seq).cast("bigint").alias("seq"),
        flag.alias("flag"),
        counted.alias("counted"),
    )
    folded = narrow.groupBy("key").transformWithStateInPandas(
        processor,
        outputStructType=f"key string, us bigint, seq bigint, {columns}",
        outputMode="append",
        timeMode="eventTime",
    )
    timed = folds.decoded(folded, rows, key)
    if no_time is None:
        return timed
    untimed = rows.filter(F.col(ts).isNull()).withColumns({"_seq": F.col(seq).cast("bigint"), "_key": F.col(key)})
    kinds = dict(timed.dtypes)
    nothing = [F.coalesce(no_time.get(c, F.lit(None)), F.lit(None)).cast(kinds[c]).alias(c) for c in timed.columns[3:]]
    untimed = untimed.select(F.col("_key").alias(key), F.lit(None).cast("bigint").alias("us"), F.col("_seq").alias("seq"), *nothing)
    return timed.unionByName(untimed)


def breaker_stream(
    log: DataFrame, threshold: int, recovery_seconds: int, name: str = "name", ts: str = "ts",
    seq: str = "seq", ok: str = "ok", counted: str | None = None, delay: str = "1 minute",
) -> DataFrame:
    """``name, us, seq, state_before, state_after, result, failure_count``; ``no_time`` rows have only a result."""
    counts = F.lit(True) if counted is None else F.coalesce(F.col(counted), F.lit(True))
    return _fold(
        log, _Breaker(threshold, recovery_seconds), name, ts, seq, delay,
        F.coalesce(F.col(ok), F.lit(False)), counts,
        "state_before string, state_after string, result string, failure_count bigint",
        {"result": F.lit(breaker.NO_TIME)},
    )


def leaky_bucket_stream(
    frames: DataFrame, key: str, rate_per_second: int | str | Fraction,
    capacity: int = defaults.QUEUE_CAPACITY, ts: str = "recv_ts", seq: str = "frame_id",
    delay: str = "1 minute",
) -> DataFrame:
    """``key, us, seq, dropped, backlog_units``; the last two are NULL without a time."""
    return _fold(
        frames, _Bucket(capacity, rate_per_second), key, ts, seq, delay, F.lit(True), F.lit(True),
        "dropped boolean, backlog_units bigint", {},
    )


def outage_stream(
    log: DataFrame, name: str = "name", ts: str = "ts", seq: str = "seq", ok: str = "ok",
    delay: int = defaults.RECONNECT_DELAY_SECONDS, max_attempts: int = defaults.MAX_RECONNECT_ATTEMPTS,
    watermark: str = "1 minute",
) -> DataFrame:
    """``name, us, seq, episode, attempt, expected_delay, outcome`` of ``outage_episodes``.

    Rows without a time have no place in an episode; all but name and seq is NULL.
    """
    return _fold(
        log, _Outage(delay, max_attempts), name, ts, seq, watermark, F.coalesce(F.col(ok), F.lit(False)), F.lit(True),
        "episode bigint, attempt bigint, expected_delay bigint, outcome string", {},
    )


def throttled_stats_stream(
    frames: DataFrame, key: str, processed: Column, dropped: Column, start_ms: int,
    gap_seconds: int = defaults.STATS_INTERVAL_SECONDS, ts: str = "recv_ts", seq: str = "frame_id",
    delay: str = "1 minute",
) -> DataFrame:
    """``key, us, seq, processed, dropped`` for each emission."""
    counted = frames.filter((processed | dropped) & (F.unix_millis(ts) >= start_ms))
    return _fold(
        counted, _Throttle(start_ms, gap_seconds), key, ts, seq, delay,
        F.coalesce(processed, F.lit(False)), F.lit(True), "processed bigint, dropped bigint",
    )
