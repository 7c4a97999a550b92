"""Bounded intake with drain: a leaky bucket per key.

The backlog drains at a fixed rate and each admitted message adds one; a
message that would lift it above capacity is dropped. All arithmetic is in
whole units: one message is ``unit`` units and a microsecond drains ``drain``
of them. Instead of the backlog the fold carries the *level*: backlog plus
what has drained since the start of the chunk, which only messages change.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.operators import folds

TABLE = "upto bigint, fixed boolean, value bigint"
STATE = "level bigint"
ADMITTED = "t bigint, seq bigint, dropped boolean, backlog_units bigint"


def units(rate_per_second: int | str | Fraction) -> tuple[int, int]:
    """Units per message, and units drained per microsecond.

    Rates are whole numbers or fractions such as ``"1/7200"``; a binary float
    would rarely be the rate that is meant, and its units too many to count.
    """
    if isinstance(rate_per_second, float):
        raise TypeError("give the rate as an integer, a text such as '0.5' or '1/7200', or a Fraction")
    per_us = Fraction(rate_per_second) / 1_000_000
    if per_us <= 0:
        raise ValueError("the rate must be positive")
    return per_us.denominator, per_us.numerator


def _admit(drained: list[int], level: int, capacity: int, unit: int):
    """Levels after each arrival, and whether it was dropped."""
    room, levels, dropped = (capacity - 1) * unit, [], []
    for now in drained:
        if level < now:
            level = now
        full = level > now + room
        if not full:
            level += unit
        levels.append(level)
        dropped.append(full)
    return levels, dropped


class _Pieces:
    """What became of every possible start level, as pieces of starts.

    Piece ``i`` holds the starts up to ``upto[i]``. If it is ``fixed``, they
    all stand at level ``value[i]`` by now, otherwise each at itself plus
    ``value[i]``.
    """

    def __init__(self, first: int, top: int, capacity: int, unit: int):
        self.first, self.unit, self.room = first, unit, (capacity - 1) * unit
        self.upto = np.array([first, top])
        self.fixed = np.array([True, False])
        self.value = np.array([first, 0])

    def range(self) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest level of each piece."""
        starts = np.append(self.first, self.upto[:-1] + 1)
        return (
            np.where(self.fixed, self.value, starts + self.value),
            np.where(self.fixed, self.value, self.upto + self.value),
        )

    def _cut(self, levels: list[int]) -> None:
        """Split pieces so that none reaches across one of the levels."""
        for level in levels:
            low, high = self.range()
            split = np.flatnonzero((low <= level) & (level < high))
            if len(split):
                self.upto = np.insert(self.upto, split, level - self.value[split])
                self.fixed = np.insert(self.fixed, split, False)
                self.value = np.insert(self.value, split, self.value[split])

    def _merge(self) -> None:
        same = (self.fixed[1:] == self.fixed[:-1]) & (self.value[1:] == self.value[:-1])
        if same.any():
            keep = np.append(~same, True)
            self.upto, self.fixed, self.value = self.upto[keep], self.fixed[keep], self.value[keep]

    def arrive(self, now: int) -> None:
        """One message."""
        self._cut([now, now + self.room])
        low, high = self.range()
        empty = high <= now
        self.value = np.where(empty, now, self.value)
        self.fixed = self.fixed | empty
        low = np.where(empty, now, low)
        self.value = self.value + np.where(low <= now + self.room, self.unit, 0)
        self._merge()

    def busy_rows(self, drained: np.ndarray) -> int:
        """How many of the next messages surely find no bucket empty.

        Followed for the lowest level there is: other starts never fall a
        whole message behind it. From the first message it can take, at
        ``first``, it has taken ``min(k, k + min over the k so far of room_k - k)``
        after ``k`` more, where ``room_k`` is what fits by then.
        """
        low = int(self.range()[0].min())
        if low - self.unit <= int(drained[0]):
            return 0
        limits = drained + self.room
        first = int(limits.searchsorted(low))
        numbers = np.arange(1, len(limits) - first + 1)
        fits = (limits[first:] - low) // self.unit + 1
        admitted = numbers + np.minimum(0, np.minimum.accumulate(fits - numbers))
        before = np.concatenate([np.zeros(first + 1, dtype=np.int64), admitted])[: len(limits)]
        emptied = low + (before - 1) * self.unit <= drained
        return int(np.argmax(emptied)) if emptied.any() else len(drained)

    def arrive_busy(self, drained: np.ndarray) -> None:
        """All of some messages at once, none of which finds a bucket empty."""
        n, unit, limits = len(drained), self.unit, drained + self.room
        top = int(self.range()[1].max())
        # Starts that are too full at first wait for the limit to reach them.
        self._cut(np.unique(limits[limits < top]).tolist())
        least = np.minimum.accumulate((limits - np.arange(1, n + 1) * unit)[::-1])[::-1]
        low, high = self.range()
        first = limits.searchsorted(low)
        # Beyond ``least`` every further unit of level means one message less.
        pieces = []
        for i, (lowest, highest, row) in enumerate(zip(low.tolist(), high.tolist(), first.tolist())):
            upto, fixed, value = int(self.upto[i]), bool(self.fixed[i]), int(self.value[i])
            if row == n:
                pieces.append((upto, fixed, value))
                continue
            slack = int(least[row])
            cut = slack + max(0, -((slack - lowest) // unit)) * unit
            while cut < highest:
                more = min(n - row, n + (slack - lowest) // unit + 1)
                pieces.append((cut - value, False, value + more * unit))
                lowest, cut = cut + 1, cut + unit
            more = min(n - row, n + (slack - lowest) // unit + 1)
            pieces.append((upto, fixed, value + more * unit))
        columns = list(zip(*pieces))
        self.upto, self.fixed, self.value = (np.array(column) for column in columns)
        self._merge()


def _summarise(pdf: pd.DataFrame, capacity: int, unit: int, drain: int) -> pd.DataFrame:
    """Lines ``start level up to -> end level`` or, unless fixed, ``-> start + value``."""
    drained = pdf["t"].to_numpy() * drain
    n, first = len(drained), int(drained[0])
    top = first + capacity * unit
    # Even a bucket full at the start, dropping nothing, is empty by this row:
    # from there on the start no longer matters.
    empty = np.flatnonzero(drained - unit * np.arange(n) >= top)
    if len(empty):
        rest = drained[empty[0]:]
        levels, _ = _admit(rest.tolist(), int(rest[0]), capacity, unit)
        return pd.DataFrame({"upto": [top], "fixed": [True], "value": [levels[-1]]})
    # Otherwise carry every start along, in one go while the bucket is busy.
    pieces, row, wait = _Pieces(first, top, capacity, unit), 0, 0
    while row < n:
        if len(pieces.upto) == 1 and pieces.fixed[0]:
            levels, _ = _admit(drained[row:].tolist(), int(pieces.value[0]), capacity, unit)
            pieces.value = np.array([levels[-1]])
            break
        busy = pieces.busy_rows(drained[row:]) if wait == 0 else 0
        if busy > 1:
            pieces.arrive_busy(drained[row:row + busy])
            row += busy
        else:
            # Looking ahead costs more than a row; do it every so often.
            wait = 32 if wait == 0 else wait - 1
            pieces.arrive(int(drained[row]))
            row += 1
    return pd.DataFrame({"upto": pieces.upto, "fixed": pieces.fixed, "value": pieces.value})


def _compose(drain: int):
    """Tables of two neighbouring stretches as one, with levels as the first counts them."""

    def compose(chunk: int, table: pd.DataFrame, after: int, later: pd.DataFrame) -> pd.DataFrame:
        shift = (after - chunk) * drain
        later = later.sort_values("upto")
        bounds, fixed, value = later["upto"].to_numpy(), later["fixed"].to_numpy(dtype=bool), later["value"].to_numpy()

        def line(level: int) -> int:
            return min(int(bounds.searchsorted(max(level, -1))), len(bounds) - 1)

        out, low = [], -1
        for upto, is_fixed, add in table.sort_values("upto")[["upto", "fixed", "value"]].itertuples(index=False, name=None):
            if is_fixed:
                level = max(int(add) - shift, -1)
                at = line(level)
                out.append((upto, True, int(value[at]) + shift if fixed[at] else level + int(value[at]) + shift))
            else:
                start = low
                while start <= upto:
                    level = start + int(add) - shift
                    at = line(level)
                    # This line of the later table holds for starts up to here; an empty bucket is one case.
                    end = -1 if level < -1 else int(bounds[at]) if at < len(bounds) - 1 else None
                    stop = upto if end is None else min(upto, end - int(add) + shift)
                    if level < -1:
                        out.append((stop, True, (int(value[at]) if fixed[at] else int(value[at]) - 1) + shift))
                    elif fixed[at]:
                        out.append((stop, True, int(value[at]) + shift))
                    else:
                        out.append((stop, False, int(add) + int(value[at])))
                    start = stop + 1
            low = upto + 1
        whole = pd.DataFrame(out, columns=["upto", "fixed", "value"])
        alike = (whole[["fixed", "value"]] == whole[["fixed", "value"]].shift(-1)).all(axis=1)
        return whole[~alike.to_numpy(dtype=bool)]

    return compose


def leaky_bucket(
    df: DataFrame,
    key: str,
    rate_per_second: int | str | Fraction,
    capacity: int = defaults.QUEUE_CAPACITY,
    ts: str = "recv_ts",
    order: str = "frame_id",
    keep: tuple[str, ...] = (),
    chunk_rows: int = folds.CHUNK_ROWS,
) -> DataFrame:
    """``key, ts, seq, dropped, backlog`` per message; backlog counts it if admitted.

    Rows are taken in (ts, order) order per key, starting from an empty bucket.
    Rows without a key share one bucket; rows without a time meet none and come
    back with ``dropped`` and ``backlog`` NULL. ``keep`` names further columns
    to carry along, so that ``dropped`` can go straight into ``classify``.
    """
    unit, drain = units(rate_per_second)
    if unit * capacity >= 2**53:
        raise ValueError("rate and capacity need more units than can be counted")
    rows = folds.chunked(df, key, ts, order, chunk_rows, **{c: F.col(c) for c in keep})

    def advance(state, chunk, table):
        last_chunk, level = state
        # Levels count from the start of a chunk; below 0 the bucket is just empty.
        level = max(level - (chunk - last_chunk) * drain, -1)
        lines = table.sort_values("upto")
        at = int(lines["upto"].to_numpy().searchsorted(level))
        line = lines.iloc[min(at, len(lines) - 1)]
        end = int(line["value"]) + (0 if line["fixed"] else level)
        return (chunk, level), (chunk, end)

    def run(pdf: pd.DataFrame, start: pd.Series) -> pd.DataFrame:
        drained = (pdf["t"].to_numpy() * drain).tolist()
        levels, dropped = _admit(drained, int(start["level"]), capacity, unit)
        backlog = np.array(levels) - np.array(drained)
        columns = {c: pdf[c].to_numpy() for c in ("t", "seq", *keep)}
        return pd.DataFrame({**columns, "dropped": dropped, "backlog_units": backlog})

    tables = folds.transfer_tables(rows, lambda pdf: _summarise(pdf, capacity, unit, drain), TABLE)
    starts = folds.chain(
        tables, lambda _: (0, -1), advance, _compose(drain), lambda s: (s[1],), lambda chunk, row: (chunk, int(row["level"])), STATE
    )
    kept = "".join(f", {c} {dict(df.dtypes)[c]}" for c in keep)
    carried = ADMITTED.replace(", dropped", f"{kept}, dropped")
    admitted = folds.decoded(folds.absolute_time(folds.replay(rows, starts, run, carried)), df, key)
    unknown = {"dropped": F.lit(None).cast("boolean"), "backlog_units": F.lit(None).cast("bigint")}
    unknown = folds.untimed(df, key, ts, order).withColumns(unknown).select(*admitted.columns)
    return admitted.unionByName(unknown).select(
        key,
        "ts",
        "seq",
        *keep,
        "dropped",
        "backlog_units",
        (F.col("backlog_units") / F.lit(float(unit))).alias("backlog"),
    )
