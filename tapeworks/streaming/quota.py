"""Bounded intake of a stream: the first frames of every interval get in, however they arrive.

An interval's state holds the earliest ``quota`` frames met so far, and no more.
A frame that comes later but was received earlier takes the place of the last
one, which is shed then. What is left when the watermark closes the interval got in.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tapeworks import defaults
from tapeworks.operators import folds

# Frames that are shed for sure pass through so many keys beside an interval's own.
PASSING = 64
# Frames that a task remembers to tell which others are shed.
REMEMBERED = 500_000
JUDGED = "key string, interval bigint, us bigint, seq bigint, shed boolean"


def _candidates(quota: int):
    """Marks the frames of a task that cannot get in, by ``lane``: 0 for those that may."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The latest of the first ``quota`` frames of each interval that the task has met.
        held: dict[tuple, list] = {}
        for batch in batches:
            # Forgetting only lets more frames pass as possible ones.
            if sum(map(len, held.values())) > REMEMBERED:
                held.clear()
            lanes = np.zeros(batch.num_rows, np.int32)
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "interval", "us", "seq")))
            for n, (key, interval, us, seq) in enumerate(rows):
                heap = held.setdefault((key, interval), [])
                place = (-us, -seq)
                if len(heap) < quota:
                    heapq.heappush(heap, place)
                elif place < heap[0]:
                    lanes[n] = 1 + n % PASSING
                else:
                    heapq.heapreplace(heap, place)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lanes)], names=[*batch.schema.names, "lane"])

    return mark


class _Quota(StatefulProcessor):
    def __init__(self, quota: int, width_ms: int):
        self.quota, self.width = quota, width_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getListState("first", "us bigint, seq bigint")

    def _rows(self, key, places: list, shed: bool) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], *p, shed) for p in places], columns=["key", "interval", "us", "seq", "shed"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[2]:
            for batch in rows:
                yield self._rows(key, list(batch[["us", "seq"]].itertuples(index=False, name=None)), True)
            return
        known = self.first.exists()
        first = [tuple(map(int, r)) for r in self.first.get()] if known else []
        for batch in rows:
            first = sorted(first + list(batch[["us", "seq"]].itertuples(index=False, name=None)))
            over, first = first[self.quota :], first[: self.quota]
            if over:
                yield self._rows(key, over, True)
        self.first.put(first)
        if not known:
            self.handle.registerTimer((int(key[1]) + 1) * self.width)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._rows(key, [tuple(map(int, r)) for r in self.first.get()], False)
        self.first.clear()

    def close(self) -> None:
        pass


def quota_stream(
    frames: DataFrame,
    seconds: int,
    quota: int = defaults.QUEUE_CAPACITY,
    key: str | None = None,
    ts: str = "recv_ts",
    order: str = "frame_id",
    delay: str = "1 minute",
) -> DataFrame:
    """``key, interval, us, seq, shed`` of every frame, once; the frames of ``quota_shed``.

    Frames count in (ts, order) order within an interval of each ``key``, of all
    frames if none is given; a missing key is one of its own. A frame that is
    shed comes as soon as that is certain, one that gets in when its interval is closed. Tasks pass
    on at most ``quota`` frames of an interval as possible ones, so that a busy
    interval is no more than that to its state. Frames without a time are left out.
    """
    if quota < 1:
        raise ValueError("a quota lets in one frame at least")
    width = seconds * 1000
    narrow = frames.filter(F.col(ts).isNotNull()).select(
        (F.lit("") if key is None else folds.encoded(F.col(key))).alias("key"),
        F.call_function("div", F.unix_millis(ts), F.lit(width)).alias("interval"),
        F.unix_micros(ts).alias("us"),
        F.col(order).cast("bigint").alias("seq"),
        F.col(ts).alias("at"),
    )
    marked = narrow.mapInArrow(_candidates(quota), "key string, interval bigint, us bigint, seq bigint, at timestamp, lane int")
    judged = marked.withWatermark("at", delay).groupBy("key", "interval", "lane").transformWithStateInPandas(
        _Quota(quota, width), outputStructType=JUDGED, outputMode="append", timeMode="eventTime"
    )
    return judged.drop("key") if key is None else folds.decoded(judged, frames, key)
