"""Circuit breaker replayed over a log of call outcomes, per name.

Closed: calls pass; ``threshold`` failures in a row open it. Open: calls are
rejected until ``recovery`` seconds after the last failure; the next call then
passes half-open, closes the breaker if it succeeds and opens it again at once
if it fails. Failures that do not count change nothing but do pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.operators import folds

CLOSED, HALF_OPEN, OPEN = "closed", "half_open", "open"
STATES = (CLOSED, HALF_OPEN, OPEN)
NO_TIME = "no_time"

TABLE = "in_state int, in_value bigint, out_state int, last bigint, fresh boolean, failures bigint"
STATE = "state int, failed_at bigint, failures_before bigint"
OUTCOME = (
    "t bigint, seq bigint, ok boolean, state_before string, state_after string, "
    "result string, failure_count bigint"
)


class _Ends:
    """Where a chunk leads, from any way the breaker can stand at some row.

    An end is ``(state, last failure, fresh, failures)``. The last failure is
    None if none was let through. ``fresh`` says that the failure count is
    known outright; otherwise it comes on top of the count one starts with.
    """

    def __init__(self, pdf: pd.DataFrame, threshold: int, recovery: int):
        self.t = pdf["t"].to_numpy()
        ok = pdf["ok"].to_numpy(dtype=bool)
        self.failed = ~ok & pdf["counted"].to_numpy(dtype=bool)
        self.n, self.threshold, self.recovery = len(pdf), threshold, recovery
        rows, total = np.arange(self.n), np.cumsum(self.failed)
        last_ok = np.maximum.accumulate(np.where(ok, rows, -1))
        self.failures, self.last_ok = np.flatnonzero(self.failed), int(last_ok[-1])
        self.first_ok = int(np.argmax(ok)) if ok.any() else self.n
        # Failures in a row up to each row, counted from the last success on.
        self.streak = total - np.where(last_ok >= 0, total[last_ok], 0)
        self.trips = np.flatnonzero(
            self.failed & (self.streak == threshold) & (rows > self.first_ok)
        )
        decided = np.where(ok | self.failed, rows, self.n)
        self.next_decided = np.append(np.minimum.accumulate(decided[::-1])[::-1], self.n)
        self.of_opening: dict[int, tuple] = {}

    def closed_to_the_end(self, since_row: int) -> tuple:
        """Closed from ``since_row`` on (-1: from before the chunk)."""
        has_failures = len(self.failures) and self.failures[-1] > since_row
        last = int(self.t[self.failures[-1]]) if has_failures else None
        fresh = self.last_ok >= 0
        return 0, last, fresh, int(self.streak[-1])

    def from_closed(self, failures: int) -> tuple:
        """Start of the chunk, closed, after some failures in a row."""
        at = self.threshold - failures - 1
        if at < len(self.failures) and self.failures[at] < self.first_ok:
            return self._counted_from(self.threshold, self.from_opening(int(self.failures[at])))
        return self._from_trip(0, -1)

    def from_half_open(self, row: int) -> tuple:
        """The call at ``row`` passes half-open."""
        decided = int(self.next_decided[row])
        if decided == self.n:
            return 1, None, False, 0
        if self.failed[decided]:
            state, last, fresh, failures = self.from_opening(decided)
            return state, last, fresh, failures if fresh else failures + 1
        at = int(self.trips.searchsorted(decided, side="right"))
        return self._from_trip(at, decided)

    def _from_trip(self, at: int, closed_at: int) -> tuple:
        if at == len(self.trips):
            return self.closed_to_the_end(closed_at)
        return self._counted_from(self.threshold, self.from_opening(int(self.trips[at])))

    @staticmethod
    def _counted_from(count: int, end: tuple) -> tuple:
        state, last, fresh, failures = end
        return state, last, True, failures if fresh else count + failures

    def from_opening(self, row: int) -> tuple:
        """The breaker opens at ``row``; openings lead to openings, so follow them."""
        path = []
        while row not in self.of_opening:
            opened = int(self.t[row])
            allowed = max(int(self.t.searchsorted(opened + self.recovery)), row + 1)
            decided = int(self.next_decided[allowed]) if allowed < self.n else self.n
            if allowed >= self.n:
                self.of_opening[row] = (2, opened, False, 0)
            elif decided == self.n:
                self.of_opening[row] = (1, opened, False, 0)
            elif self.failed[decided]:
                path.append((row, 1, False))
                row = decided
            else:
                at = int(self.trips.searchsorted(decided, side="right"))
                if at < len(self.trips):
                    path.append((row, self.threshold, True))
                    row = int(self.trips[at])
                else:
                    state, last, fresh, failures = self.closed_to_the_end(decided)
                    self.of_opening[row] = (state, opened if last is None else last, fresh, failures)
        end = self.of_opening[row]
        for earlier, count, closed_between in reversed(path):
            state, last, fresh, failures = end
            end = (state, last, fresh or closed_between, failures if fresh else failures + count)
            self.of_opening[earlier] = end
        return end


def _summarise(pdf: pd.DataFrame, threshold: int, recovery: int) -> pd.DataFrame:
    ends = _Ends(pdf, threshold, recovery)
    lines = [(0, failures, *ends.from_closed(failures)) for failures in range(threshold)]
    lines.append((1, 0, *ends.from_half_open(0)))
    # Open at the start: which row is let through first depends on the last failure.
    heads = min(ends.n, int(ends.t.searchsorted(ends.t[0] + recovery)) + 1)
    previous, decided_before = None, None
    for row in range(heads):
        if row and ends.t[row] == ends.t[row - 1]:
            continue  # an earlier row of the same time is let through
        decided = int(ends.next_decided[row])
        end = previous if decided == decided_before else ends.from_half_open(row)
        if end == previous:
            lines.pop()
        lines.append((2, int(ends.t[row]), *end))
        previous, decided_before = end, decided
    frame = pd.DataFrame(lines, columns=[c.split()[0] for c in TABLE.split(", ")])
    frame["last"] = frame["last"].astype("Int64")
    return frame


def _compose(recovery: int):
    """Tables of two neighbouring stretches as one; times count from their own starts."""

    def compose(chunk: int, table: pd.DataFrame, after: int, later: pd.DataFrame) -> pd.DataFrame:
        shift = after - chunk
        later = later.assign(last=later["last"] + shift)
        later.loc[later["in_state"] == 2, "in_value"] += shift
        by_state = {k: part.sort_values("in_value").reset_index(drop=True) for k, part in later.groupby("in_state")}
        opened = by_state.get(2, later.iloc[:0])
        # Which line of the later table each line's end meets; none if it stays open throughout.
        table = table.sort_values(["in_state", "in_value"]).reset_index(drop=True)
        state = table["out_state"].to_numpy()
        count = table["failures"].to_numpy() + np.where(table["fresh"], 0, table["in_value"])
        wanted = table["last"].fillna(0).to_numpy(dtype=np.int64) + recovery
        found = np.where(state == 2, opened["in_value"].to_numpy().searchsorted(wanted), 0)
        found = np.where(state == 0, count, found).astype(np.int64)
        ends = table.copy()
        for kind in (0, 1, 2):
            lines = by_state.get(kind, later.iloc[:0])
            at = np.flatnonzero((state == kind) & (found < len(lines)))
            if not len(at):
                continue
            met = lines.iloc[found[at]].reset_index(drop=True)
            own = table.iloc[at].reset_index(drop=True)
            fresh = met["fresh"].to_numpy(dtype=bool)
            merged = own.assign(
                out_state=met["out_state"],
                last=met["last"].fillna(own["last"]),
                fresh=fresh | own["fresh"].to_numpy(dtype=bool),
                failures=np.where(fresh, met["failures"], met["failures"] + own["failures"]),
            )
            ends = pd.concat([ends.drop(index=at), merged.set_index(pd.Index(at))])
        ends = ends.sort_index()
        # Failures so late that nothing is let through before the later stretch meet its own lines.
        horizon = int(table.loc[table["in_state"] == 2, "in_value"].max())
        whole = pd.concat([ends, opened[opened["in_value"] > horizon]])[table.columns]
        return _pruned(whole)

    return compose


def _pruned(table: pd.DataFrame) -> pd.DataFrame:
    """Of open lines in a row that end alike only the last."""
    table = table.sort_values(["in_state", "in_value"]).reset_index(drop=True)
    ends = table[["in_state", "out_state", "last", "fresh", "failures"]].fillna({"last": -(2**62)})
    alike = (ends == ends.shift(-1)).all(axis=1) & (table["in_state"] == 2)
    return table[~alike.fillna(False).to_numpy(dtype=bool)]


def _chain(tables: DataFrame, recovery: int) -> DataFrame:
    """A state is ``(state, last failure in absolute time, failures)``."""

    def restore(chunk, row):
        failed_at = None if pd.isna(row["failed_at"]) else int(row["failed_at"])
        return int(row["state"]), failed_at, int(row["failures_before"])

    def advance(state, chunk, table):
        kind, failed_at, failures = state
        lines = table[table["in_state"] == kind].sort_values("in_value")
        wanted = failures if kind == 0 else 0 if kind == 1 else failed_at - chunk + recovery
        at = int(lines["in_value"].to_numpy().searchsorted(wanted))
        if at == len(lines):
            return state, state
        line = lines.iloc[at]
        count = int(line["failures"]) + (0 if line["fresh"] else failures)
        if not pd.isna(line["last"]):
            failed_at = int(line["last"]) + chunk
        return state, (int(line["out_state"]), failed_at, count)

    return folds.chain(
        tables, lambda _: (0, None, 0), advance, _compose(recovery), lambda s: s, restore, STATE
    )


def step(standing: tuple, t: int, ok: bool, counted: bool, threshold: int, recovery: int) -> tuple:
    """One call: ``(state, last failure, failures)`` to the next, and its result."""
    state, failed_at, failures = standing
    if state == OPEN and t - failed_at < recovery:
        return standing, "rejected"
    if ok:
        return (CLOSED, failed_at, 0), "ok"
    passed = HALF_OPEN if state == OPEN else state
    if not counted:
        return (passed, failed_at, failures), "uncounted"
    return (OPEN if failures + 1 >= threshold else passed, t, failures + 1), "failed"


def _run(pdf: pd.DataFrame, start: pd.Series, threshold: int, recovery: int) -> pd.DataFrame:
    """One pass over a chunk from a known state."""
    failed_at = 0 if pd.isna(start["failed_at"]) else int(start["failed_at"]) - int(start["chunk"])
    standing = STATES[int(start["state"])], failed_at, int(start["failures_before"])
    out = []
    for t, ok, counted in zip(pdf["t"].tolist(), pdf["ok"].tolist(), pdf["counted"].tolist()):
        before = standing[0]
        standing, result = step(standing, t, ok, counted, threshold, recovery)
        out.append((before, standing[0], result, standing[2]))
    frame = pd.DataFrame(out, columns=["state_before", "state_after", "result", "failure_count"])
    for name in ("ok", "seq", "t"):
        frame.insert(0, name, pdf[name].to_numpy())
    return frame


def _prepared(
    log: DataFrame, name: str, ts: str, seq: str, ok: str, counted: str | None, chunk_rows: int
) -> DataFrame:
    counts = F.lit(True) if counted is None else F.coalesce(F.col(counted), F.lit(True))
    return folds.chunked(
        log, name, ts, seq, chunk_rows, ok=F.coalesce(F.col(ok), F.lit(False)), counted=counts
    )


def breaker_replay(
    log: DataFrame,
    threshold: int,
    recovery_seconds: int,
    name: str = "name",
    ts: str = "ts",
    seq: str = "seq",
    ok: str = "ok",
    counted: str | None = None,
    chunk_rows: int = folds.CHUNK_ROWS,
) -> DataFrame:
    """``name, ts, seq, ok, state_before, state_after, result, failure_count``.

    Rows are taken in (ts, seq) order per name; ``seq`` must tell equal times
    apart. Rows without a name are one history; rows without a time are part
    of none and come back with the result ``no_time``.
    """
    recovery = recovery_seconds * 1_000_000
    rows = _prepared(log, name, ts, seq, ok, counted, chunk_rows)
    tables = folds.transfer_tables(rows, lambda pdf: _summarise(pdf, threshold, recovery), TABLE)
    outcome = folds.replay(
        rows,
        _chain(tables, recovery),
        lambda pdf, start: _run(pdf, start, threshold, recovery),
        OUTCOME,
    )
    timed = folds.decoded(folds.absolute_time(outcome), log, name)
    nothing = {c: F.lit(None).cast("string") for c in ("state_before", "state_after")}
    unknown = folds.untimed(log, name, ts, seq).withColumn("ok", F.coalesce(F.col(ok), F.lit(False)))
    unknown = unknown.withColumns({**nothing, "result": F.lit(NO_TIME), "failure_count": F.lit(None).cast("bigint")})
    return timed.unionByName(unknown.select(*timed.columns))


def breaker_metrics(
    log: DataFrame,
    threshold: int,
    recovery_seconds: int,
    report_ms: Column | int,
    name: str = "name",
    ts: str = "ts",
    seq: str = "seq",
    ok: str = "ok",
    counted: str | None = None,
    chunk_rows: int = folds.CHUNK_ROWS,
) -> DataFrame:
    """Where each breaker stands after its whole log. Needs no replay, only the chain.

    Without a failure so far there is no last failure, and no time since one.
    Rows without a time tell nothing of where a breaker stands.
    """
    recovery = recovery_seconds * 1_000_000
    rows = _prepared(log, name, ts, seq, ok, counted, chunk_rows)
    tables = folds.transfer_tables(rows, lambda pdf: _summarise(pdf, threshold, recovery), TABLE)
    final = folds.decoded(_chain(tables, recovery).filter(F.col("chunk").isNull()), log, name)
    report = report_ms if isinstance(report_ms, Column) else F.lit(report_ms)
    last_ms = F.call_function("div", F.col("failed_at"), F.lit(1000))
    return final.select(
        name,
        F.get(F.array(*[F.lit(s) for s in STATES]), F.col("state")).alias("state"),
        F.col("failures_before").alias("failure_count"),
        F.lit(threshold).alias("failure_threshold"),
        F.lit(recovery_seconds).alias("recovery_timeout"),
        last_ms.alias("last_failure_ms"),
        (report - last_ms).alias("ms_since_last_failure"),
    )


def transitions(
    replayed: DataFrame, report_ms: Column | int, within_seconds: int = 3600
) -> DataFrame:
    """Rows of a replay at which the state changed lately, newest first."""
    report = report_ms if isinstance(report_ms, Column) else F.lit(report_ms)
    return replayed.filter(
        (F.col("state_before") != F.col("state_after"))
        & (F.unix_millis("ts") >= report - within_seconds * 1000)
    ).orderBy(F.desc("ts"), F.desc("seq"))
