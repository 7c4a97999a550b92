"""Counters of a running query, without a second pass over its data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tapeworks.operators.metrics import is_dropped, is_processed

COUNTERS = "frame_counters"


def counters() -> list:
    """What is counted of a run; also plain aggregates of classified frames."""
    return [
        F.count("*").alias("offered"),
        F.count(F.when(is_processed(), True)).alias("processed"),
        F.count(F.when(is_dropped(), True)).alias("dropped"),
    ]


def observed(classified: DataFrame) -> tuple[DataFrame, Observation]:
    """Batch: counters are in ``observation.get`` once an action has run."""
    observation = Observation(COUNTERS)
    return classified.observe(observation, *counters()), observation


def observed_stream(classified: DataFrame) -> DataFrame:
    """Streaming: counters arrive with each trigger, see ``RunningTotals``."""
    return classified.observe(COUNTERS, *counters())


class RunningTotals(StreamingQueryListener):
    """Adds up the counters of every trigger.

    ``late`` counts the rows that stateful rules got behind the watermark and
    dropped; what they do get gives the results of the batch operators.
    """

    def __init__(self) -> None:
        self.totals = {"offered": 0, "processed": 0, "dropped": 0, "late": 0}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(COUNTERS)
        if row is not None:
            for name in ("offered", "processed", "dropped"):
                self.totals[name] += row[name]
        self.totals["late"] += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
