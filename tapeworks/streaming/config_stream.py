"""Subscriptions kept up to date by a stream of configuration changes.

A scope's list is held in the state store by order statistics: every entry has a
place that only grows, and every stream the places it has. Adding and removing a
stream touches that stream's places and no other entry's, so a change costs the
same however long the list is; only ``set`` writes a list anew. Where an entry
stands is the number of entries before it, and is worked out where the list is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tapeworks.operators import folds
from tapeworks.operators.config_log import STREAMS

EFFECTIVE = ("set", "add", "remove")
ENTRY = "key string, seq bigint, version bigint, place bigint, stream string, present boolean"


class _Subscriptions(StatefulProcessor):
    """Applies a scope's changes in the order of ``seq`` and tells each entry that comes or goes."""

    def __init__(self, base: list[str]):
        self.base = base

    def init(self, handle) -> None:
        # The last change applied, the place of the next entry, and how often the list was set.
        self.head = handle.getValueState("head", "seq bigint, next bigint, version bigint")
        self.places = handle.getMapState("places", "stream string", "places string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        changes = sorted(
            (row for batch in rows for row in batch[["seq", "op", "streams", "stream"]].astype(object).itertuples(index=False, name=None)),
            key=lambda row: row[0],
        )
        out = []
        if self.head.exists():
            last, place, version = map(int, self.head.get())
        else:
            last, place, version = -1, 0, 0
            for stream in self.base:
                place = self._append(stream, place)
                out.append((key[0], -1, version, place - 1, stream, True))
        for seq, op, streams, stream in changes:
            seq = int(seq)
            if op not in EFFECTIVE or (op != "set" and stream is None):
                continue
            if seq <= last:
                out.append((key[0], seq, -1, -1, None if op == "set" else stream, None))
                continue
            last = seq
            if op == "set":
                self.places.clear()
                version, place = version + 1, 0
                # The list itself may be empty, and readers must learn of that.
                out.append((key[0], seq, version, -1, None, True))
                for entry in () if streams is None else streams:
                    place = self._append(entry, place)
                    out.append((key[0], seq, version, place - 1, entry, True))
                continue
            found = self._of(stream)
            if op == "add" and not found:
                place = self._append(stream, place)
                out.append((key[0], seq, version, place - 1, stream, True))
            elif op == "remove" and found:
                self._keep(stream, found[1:])
                out.append((key[0], seq, version, found[0], stream, False))
        self.head.update((last, place, version))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ENTRY.split(", ")]).astype(
            {"seq": "int64", "version": "int64", "place": "int64", "present": "boolean"}
        )

    @staticmethod
    def _name(stream) -> tuple:
        return (json.dumps(stream),)

    def _of(self, stream) -> list[int]:
        name = self._name(stream)
        return json.loads(self.places.getValue(name)[0]) if self.places.containsKey(name) else []

    def _keep(self, stream, places: list[int]) -> None:
        if places:
            self.places.updateValue(self._name(stream), (json.dumps(places),))
        else:
            self.places.removeKey(self._name(stream))

    def _append(self, stream, place: int) -> int:
        self._keep(stream, [*self._of(stream), place])
        return place + 1

    def close(self) -> None:
        pass


def subscription_changes(log: DataFrame, base: Sequence[str] = (), scope: str = "scope", seq: str = "seq") -> DataFrame:
    """What each change of a streamed log did to its scope's list, by the rules of ``subscriptions_current``.

    Rows ``scope, seq, version, place, stream, present``: an entry came to a place of
    the list's ``version`` or went from it; ``current`` makes lists of them. A change
    without effect has no row. Entries of ``base`` come with ``seq`` -1 when a
    scope is first met; a list that is set begins with a row without a stream. Changes are
    applied in order within a trigger; one that comes after a later one was
    applied, or again, is not applied and comes back with ``present`` NULL and version -1. Scopes
    that are NULL share a list. Changes of other types, and of no stream, have no effect;
    those without a number, which must not be negative, are left out.
    """
    changes = log.where(F.col(seq) >= 0).select(
        folds.encoded(F.col(scope)).alias("key"),
        F.col(seq).cast("bigint").alias("seq"),
        "op",
        F.from_json(F.get_json_object("parameters", "$.streams"), STREAMS).alias("streams"),
        F.get_json_object("parameters", "$.stream").alias("stream"),
    )
    told = changes.groupBy("key").transformWithStateInPandas(
        _Subscriptions(list(base)), outputStructType=ENTRY, outputMode="append", timeMode="none"
    )
    return folds.decoded(told, log, scope)


def current(changes: DataFrame, scope: str = "scope") -> DataFrame:
    """``scope, pos, stream``: the lists, from all rows that ``subscription_changes`` has told so far.

    An entry is there if it came and did not go. Lists that are empty have no row.
    """
    applied = changes.where(F.col("present").isNotNull())
    ends = applied.groupBy(F.col(scope).alias("_scope")).agg(F.max("version").alias("_version"))
    latest = applied.join(ends, F.col(scope).eqNullSafe(F.col("_scope")) & (F.col("version") == F.col("_version"))).where("place >= 0")
    kept = latest.groupBy(scope, "place").agg(F.max("stream").alias("stream"), F.bool_and("present").alias("present"))
    order = Window.partitionBy(scope).orderBy("place")
    return kept.where("present").select(scope, (F.row_number().over(order) - 1).alias("pos"), "stream")
