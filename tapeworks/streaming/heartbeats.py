"""Heartbeats of a running stream, intervals without a frame included.

Each task counts its frames per interval first, so that what meets in the
state of the stream is a row per task and interval, whatever the traffic. A timer
at the end of every interval tells its heartbeat, data or no data.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tapeworks import defaults
from tapeworks.operators.intake import MALFORMED
from tapeworks.operators.metrics import as_ticks, is_dropped, is_processed

COUNTS = "slot bigint, processed bigint, dropped bigint, received bigint, last timestamp"
TICK = "slot bigint, first bigint, processed_since_last bigint, dropped_since_last bigint, total_processed bigint, total_dropped bigint, last_received_ms bigint"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``COUNTS`` of a task's ``slot, processed, dropped, received, last``."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("slot")
        found = table.aggregate([("processed", "sum"), ("dropped", "sum"), ("received", "max"), ("last", "max")])
        found = found.select(["slot", "processed_sum", "dropped_sum", "received_max", "last_max"])
        yield from found.rename_columns([c.split()[0] for c in COUNTS.split(", ")]).combine_chunks().to_batches()


class _Heartbeat(StatefulProcessor):
    """Adds counts up by interval and tells each interval once its end and the delay have passed."""

    def __init__(self, width: int, delay: int, wall_clock: bool):
        self.width, self.delay, self.wall_clock = width, delay, wall_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.told = handle.getValueState("told", "slot bigint, first bigint, processed bigint, dropped bigint, last bigint")
        self.open = handle.getMapState("open", "slot bigint", "processed bigint, dropped bigint, received bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        next_slot = self.told.get()[0] if self.told.exists() else None
        slots = []
        for batch in rows:
            for slot, done, lost, received in batch[["slot", "processed", "dropped", "received"]].astype(object).itertuples(index=False, name=None):
                # What comes after its heartbeat was told counts in the next one.
                slot = int(slot) if next_slot is None else max(int(slot), next_slot)
                before = self.open.getValue((slot,)) if self.open.containsKey((slot,)) else (0, 0, -1)
                received = -1 if pd.isna(received) else int(received)
                self.open.updateValue((slot,), (int(before[0]) + int(done), int(before[1]) + int(lost), max(int(before[2]), received)))
                slots.append(slot)
        if next_slot is None and slots:
            self._wait(min(slots))
        return iter(())

    def _wait(self, slot: int) -> None:
        """A heartbeat is due when the clock has passed the interval; the watermark is behind by its delay already."""
        self.handle.registerTimer((slot + 1) * self.width + (self.delay if self.wall_clock else 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentProcessingTimeInMs() - self.delay if self.wall_clock else timerValues.getCurrentWatermarkInMs()
        if self.told.exists():
            slot, first, processed, dropped, last = map(int, self.told.get())
        else:
            slot = first = min(int(k[0]) for k in self.open.keys())
            processed = dropped = 0
            last = -1
        if (slot + 1) * self.width > clock and self.told.exists():
            return
        out = []
        while (slot + 1) * self.width <= clock:
            done, lost, received = map(int, self.open.getValue((slot,))) if self.open.containsKey((slot,)) else (0, 0, -1)
            self.open.removeKey((slot,))
            processed, dropped, last = processed + done, dropped + lost, max(last, received)
            out.append((slot, first, done, lost, processed, dropped, None if last < 0 else last))
            slot += 1
            if len(out) == 10_000:
                yield self._rows(out)
                out = []
        self.told.update((slot, first, processed, dropped, last))
        self._wait(slot)
        if out:
            yield self._rows(out)

    @staticmethod
    def _rows(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[c.split()[0] for c in TICK.split(", ")]).astype("Int64")

    def close(self) -> None:
        pass


def heartbeat_stream(
    classified: DataFrame, seconds: int = defaults.HEARTBEAT_SECONDS, delay_seconds: int = 60, wall_clock: bool = False, ts: str = "recv_ts"
) -> DataFrame:
    """The rows of ``heartbeat_report`` as they fall due, from the first frame's interval on.

    By event time, an interval is told once the watermark, ``delay_seconds``
    behind the latest frame, has passed it: rows equal the batch report up to there,
    empty intervals included. With ``wall_clock`` the clock decides, so that
    heartbeats go on in a silent stream; frames that come after theirs was told
    count in the next. Frames without a receive time are left out.
    """
    width = seconds * 1000
    slot = F.call_function("div", F.unix_millis(ts), F.lit(width))
    narrow = classified.filter(F.col(ts).isNotNull()).select(
        slot.alias("slot"),
        F.when(is_processed(), 1).otherwise(0).cast("bigint").alias("processed"),
        F.when(is_dropped(), 1).otherwise(0).cast("bigint").alias("dropped"),
        F.when(F.col("shape") != MALFORMED, F.unix_millis(ts)).alias("received"),
        F.col(ts).alias("last"),
    )
    counts = narrow.mapInArrow(_counted, COUNTS)
    if not wall_clock:
        counts = counts.withWatermark("last", f"{delay_seconds} seconds")
    told = counts.withColumn("feed", F.lit("all")).groupBy("feed").transformWithStateInPandas(
        _Heartbeat(width, delay_seconds * 1000, wall_clock),
        outputStructType=TICK,
        outputMode="append",
        timeMode="processingTime" if wall_clock else "eventTime",
    )
    return as_ticks(told, width)
