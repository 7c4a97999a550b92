"""Order-dependent rules over one key's history, run in parallel within the key.

A breaker, a throttle or a bucket looks sequential: what a row does depends on
all rows before it. Sending a key's whole history to one task would not
survive a key with a third of the data, so histories are cut into chunks and
folded in three steps:

1. each chunk is summarised on its own as a *transfer table*: for every state
   the rule could be in at the start of the chunk, the state it ends in;
2. tables of neighbouring chunks are composed into one, ``FAN`` at a time and
   in ``LEVELS`` levels (one: 10,000 chunks leave 40 tables). A composed table answers for the states at its own
   start only, so it is no larger than the table of its first chunk might be.
   The few tables left of a key are chained in time order; going down again,
   every group gets its starting state and passes it along its members;
3. each chunk is replayed from its starting state.

Steps 1 and 3 work on the same narrow rows, partitioned by (key, chunk), so one
shuffle serves both. Results equal a single pass over the whole history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows a chunk has at least, once its key has so many, and the steps in which
# chunks are cut. Rows of one step are never separated.
CHUNK_ROWS = 200_000
STEP_US = 10_000_000
# Tables that are composed into one, and how often.
FAN = 256
LEVELS = 1


def encoded(key: Column) -> Column:
    """A key as text that is never NULL and keeps NULL apart from ``''``."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def decoded(df: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """``key`` back as the column ``name`` of ``source``, of the same type."""
    key = F.when(F.col("key") != "", F.expr("substring(key, 2)")).cast(source.schema[name].dataType)
    return df.withColumn("key", key).withColumnRenamed("key", name)


def chunked(
    df: DataFrame, key: str, ts: str, order: str, chunk_rows: int = CHUNK_ROWS, **extra: Column
) -> DataFrame:
    """Narrow rows ``key, part, chunk, t, seq`` plus extras, partitioned by (key, chunk).

    Times are microseconds; ``chunk`` is the time at which a chunk begins,
    ``part`` its number, and ``t`` counts from there. Rows without a time have no place in a history.

    Chunks are cut by rows counted per step of time: a quiet key is one chunk,
    a busy one has many. Counting and cutting read one exchange by (key, step).
    """
    us = F.unix_micros(F.col(ts))
    rows = (
        df.filter(F.col(ts).isNotNull())
        .select(
            encoded(F.col(key)).alias("key"),
            F.coalesce(F.call_function("div", us - F.pmod(us, F.lit(STEP_US)), F.lit(STEP_US)), F.lit(0)).alias("step"),
            us.alias("us"),
            F.col(order).cast("bigint").alias("seq"),
            *[c.alias(n) for n, c in extra.items()],
        )
        .repartition("key", "step")
    )
    upto = Window.partitionBy("key").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = rows.groupBy("key", "step").agg(F.count("*").alias("rows"))
    steps = steps.withColumn("part", F.call_function("div", F.coalesce(F.sum("rows").over(upto), F.lit(0)), F.lit(chunk_rows)))
    begin = F.min("step").over(Window.partitionBy("key", "part")) * STEP_US
    placed = rows.join(steps.select("key", "step", "part", begin.alias("chunk")), ["key", "step"])
    return placed.withColumn("t", F.col("us") - F.col("chunk")).drop("us", "step").repartition("key", "chunk")


def untimed(df: DataFrame, key: str, ts: str, order: str) -> DataFrame:
    """The rows that have no time, as ``key`` (by its name), ``ts, seq`` and the rest."""
    return df.filter(F.col(ts).isNull()).withColumns({"_ts": F.col(ts), "_seq": F.col(order).cast("bigint")}).select(
        F.col(key), F.col("_ts").alias("ts"), F.col("_seq").alias("seq"), *[F.col(c) for c in df.columns if c not in (key, "ts", "seq")]
    )


def transfer_tables(rows: DataFrame, summarise: Callable, columns: str) -> DataFrame:
    """Step 1. ``summarise(rows of one chunk)`` returns its table as a DataFrame."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        table = summarise(pdf.sort_values(["t", "seq"], kind="stable"))
        for place, name in enumerate(("key", "part", "chunk")):
            table.insert(place, name, pdf[name].iloc[0])
        return table

    return rows.groupBy("key", "chunk").applyInPandas(run, f"key string, part bigint, chunk bigint, {columns}")


def _composed(tables: DataFrame, compose: Callable) -> DataFrame:
    """One table for every ``FAN`` neighbouring parts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [table for _, table in pdf.groupby("chunk", sort=True)]
        first = parts[0]
        key, part, chunk = first["key"].iloc[0], int(first["part"].iloc[0]) // FAN, int(first["chunk"].iloc[0])
        whole, rest = first.drop(columns=["key", "part", "chunk", "group"]), parts[1:]
        for table in rest:
            whole = compose(chunk, whole, int(table["chunk"].iloc[0]), table.drop(columns=["key", "part", "chunk", "group"]))
        whole = whole.reset_index(drop=True)
        for place, (name, value) in enumerate((("key", key), ("part", part), ("chunk", chunk))):
            whole.insert(place, name, value)
        return whole

    group = F.call_function("div", F.col("part"), F.lit(FAN))
    return tables.withColumn("group", group).groupBy("key", "group").applyInPandas(run, tables.schema)


def chain(
    tables: DataFrame,
    initial: Callable[[str], object],
    advance: Callable,
    compose: Callable,
    export: Callable,
    restore: Callable,
    columns: str,
) -> DataFrame:
    """Step 2. State at the start of each chunk, and after the last (``chunk`` NULL).

    ``advance(state, chunk, table)`` returns ``(state as the chunk sees it,
    state after it)``; ``compose(chunk, table, next chunk, next table)`` the
    table of both; ``export(state)`` turns a state into ``columns`` and
    ``restore(chunk, row)`` turns them back.
    """
    names = [c.split()[0] for c in columns.split(", ")]
    schema = f"key string, part bigint, chunk bigint, {columns}"

    def passed_along(key, state, pdf: pd.DataFrame, last: bool) -> pd.DataFrame:
        out = []
        for number, table in pdf.groupby("chunk", sort=True):
            at_start, state = advance(state, int(number), table)
            out.append((key, int(table["part"].iloc[0]), int(number), *export(at_start)))
        if last:
            out.append((key, None, None, *export(state)))
        frame = pd.DataFrame(out, columns=["key", "part", "chunk", *names])
        return frame.astype({"part": "Int64", "chunk": "Int64"})

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf["key"].iloc[0]
        return passed_along(key, initial(key), pdf, True)

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        return passed_along(first["key"], restore(int(first["_chunk"]), first), pdf, False)

    levels = [tables]
    for _ in range(LEVELS):
        levels.append(_composed(levels[-1], compose))
    states = levels.pop().groupBy("key").applyInPandas(top, schema)
    final = states.filter(F.col("chunk").isNull())
    while levels:
        starts = states.filter(F.col("chunk").isNotNull()).withColumnsRenamed({"part": "group", "chunk": "_chunk"})
        members = levels.pop().withColumn("group", F.call_function("div", F.col("part"), F.lit(FAN)))
        states = members.join(starts, ["key", "group"]).groupBy("key", "group").applyInPandas(down, schema)
    return states.unionByName(final).drop("part")


def replay(rows: DataFrame, starts: DataFrame, run_chunk: Callable, columns: str) -> DataFrame:
    """Step 3. ``run_chunk(rows of one chunk, first row's state columns)``.

    The merge hint keeps the rows partitioned by (key, chunk) as step 1 left
    them, so they are shuffled once and not again for the grouping.
    """
    started = rows.join(starts.filter(F.col("chunk").isNotNull()).hint("merge"), ["key", "chunk"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(["t", "seq"], kind="stable")
        result = run_chunk(ordered, ordered.iloc[0])
        result.insert(0, "key", ordered["key"].iloc[0])
        result.insert(1, "chunk", ordered["chunk"].iloc[0])
        return result

    return started.groupBy("key", "chunk").applyInPandas(run, f"key string, chunk bigint, {columns}")


def absolute_time(df: DataFrame) -> DataFrame:
    """``ts`` out of ``chunk`` and ``t``."""
    return df.withColumn("ts", F.timestamp_micros(F.col("chunk") + F.col("t"))).drop("chunk", "t")


def first_at_or_after(times, needs: Iterable[int]):
    """Index of the first time not before each needed one; ``len`` if none."""
    return times.searchsorted(needs, side="left")
