"""Statistics emitted at most once per interval, in the order of messages.

After each processed message: if at least ``gap`` seconds have passed since
the last emission (at first: since the start), emit the totals so far. Each
emission moves the reference point, so this is not one per calendar minute.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.numbers import per_second
from tapeworks.operators import folds

TABLE = "upto bigint, emitted bigint, processed bigint, dropped bigint"
STATE = "since bigint, processed_before bigint, dropped_before bigint"
EMITTED = "t bigint, seq bigint, processed bigint, dropped bigint"


def throttled_stats(
    df: DataFrame,
    key: str,
    processed: Column,
    dropped: Column,
    start_ms: int,
    gap_seconds: int = defaults.STATS_INTERVAL_SECONDS,
    ts: str = "recv_ts",
    order: str = "frame_id",
    chunk_rows: int = folds.CHUNK_ROWS,
) -> DataFrame:
    """``key, ts, seq, processed, dropped, per_second`` for each emission.

    Totals run from ``start_ms`` on; rows before it, or without a time, are not
    part of the run. Rows without a key have totals of their own.
    """
    gap, start_us = gap_seconds * 1_000_000, start_ms * 1000
    counted = df.filter((processed | dropped) & (F.unix_millis(ts) >= start_ms))
    rows = folds.chunked(counted, key, ts, order, chunk_rows, done=F.coalesce(processed, F.lit(False)))

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        times = pdf["t"].to_numpy()[pdf["done"].to_numpy()]
        n = len(times)
        totals = {"processed": n, "dropped": len(pdf) - n}
        if n == 0:
            return pd.DataFrame([{"upto": None, "emitted": None, **totals}]).astype("Int64")
        # The emission after one at each row; the last of a chunk leads to itself.
        # Squaring the map until it stands still follows every sequence to its end.
        after = np.maximum(times.searchsorted(times + gap), np.arange(1, n + 1))
        last = np.where(after < n, after, np.arange(n))
        while not (last[last] == last).all():
            last = last[last]
        # Only rows before the first possible second emission can come first.
        heads = np.arange(min(n, times.searchsorted(times[0] + gap) + 1))
        heads = heads[np.append(True, times[heads][1:] != times[heads][:-1])]
        ends = times[last[heads]]
        keep = np.append(ends[1:] != ends[:-1], True)
        table = pd.DataFrame({"upto": times[heads][keep], "emitted": ends[keep]})
        return table.assign(**totals)

    def restore(chunk, row):
        return chunk + int(row["since"]), int(row["processed_before"]), int(row["dropped_before"])

    def advance(state, chunk, table):
        since, done, lost = state
        local = since - chunk
        later = (local, done, lost)
        done, lost = done + int(table["processed"].iloc[0]), lost + int(table["dropped"].iloc[0])
        if table["upto"].notna().any():
            lines = table.sort_values("upto")
            line = int(lines["upto"].to_numpy().searchsorted(local + gap))
            if line < len(lines):
                since = int(lines["emitted"].iloc[line]) + chunk
        return later, (since, done, lost)

    def compose(chunk: int, table: pd.DataFrame, after: int, later: pd.DataFrame) -> pd.DataFrame:
        shift = after - chunk
        totals = {c: int(table[c].iloc[0]) + int(later[c].iloc[0]) for c in ("processed", "dropped")}
        lines, next_lines = (t[t["upto"].notna()].astype("int64").sort_values("upto") for t in (table, later))
        times, ends = next_lines["upto"].to_numpy() + shift, next_lines["emitted"].to_numpy() + shift
        emitted = lines["emitted"].to_numpy()
        at = times.searchsorted(emitted + gap)
        emitted = np.where(at < len(times), np.append(ends, 0)[np.minimum(at, len(times))], emitted)
        # Starts that the first stretch has no emission for meet the later one's own lines.
        beyond = times > (lines["upto"].iloc[-1] if len(lines) else -1)
        upto, emitted = np.append(lines["upto"].to_numpy(), times[beyond]), np.append(emitted, ends[beyond])
        if not len(upto):
            return pd.DataFrame([{"upto": None, "emitted": None, **totals}]).astype("Int64")
        keep = np.append(emitted[1:] != emitted[:-1], True)
        return pd.DataFrame({"upto": upto[keep], "emitted": emitted[keep], **totals}).astype("Int64")

    def emit(pdf: pd.DataFrame, state) -> pd.DataFrame:
        done = pdf["done"].to_numpy()
        times, at = pdf["t"].to_numpy()[done], np.flatnonzero(done)
        processed_so_far, dropped_so_far = done.cumsum(), (~done).cumsum()
        chosen, row = [], int(times.searchsorted(state["since"] + gap))
        while row < len(times):
            chosen.append(at[row])
            row = max(int(times.searchsorted(times[row] + gap)), row + 1)
        picked = pdf.iloc[chosen]
        return pd.DataFrame(
            {
                "t": picked["t"].to_numpy(),
                "seq": picked["seq"].to_numpy(),
                "processed": processed_so_far[chosen] + state["processed_before"],
                "dropped": dropped_so_far[chosen] + state["dropped_before"],
            }
        )

    tables = folds.transfer_tables(rows, summarise, TABLE)
    starts = folds.chain(
        tables, lambda _: (start_us, 0, 0), advance, compose, lambda s: s, restore, STATE
    )
    emitted = folds.decoded(folds.absolute_time(folds.replay(rows, starts, emit, EMITTED)), df, key)
    rate = per_second(F.col("processed"), F.unix_millis("ts") - start_ms)
    return emitted.select(key, "ts", "seq", "processed", "dropped", rate.alias("per_second"))
