"""Candles, gaps, completeness, completion events and job runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions.numbers import percent, subject
from tapeworks.operators.running import join_back

EXACT_PRICE, EXACT_QUANTITY = "decimal(19,8)", "decimal(18,8)"


def _quote(price: Column, quantity: Column) -> Column:
    """Price times quantity to 16 places.

    One exact product where both have no more than the exchange's 8 places.
    Otherwise the products of their whole parts and fractions, each of which
    is exact, are added up and rounded once. NULL beyond 20 whole digits.
    """
    short_price, short_quantity = price.try_cast(EXACT_PRICE), quantity.try_cast(EXACT_QUANTITY)
    short = (short_price == price) & (short_quantity == quantity)
    whole = lambda c: F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).try_cast("decimal(19,0)")
    (pw, pf), (qw, qf) = ((whole(c), (c - whole(c)).try_cast("decimal(18,18)")) for c in (price, quantity))
    terms = [(pw * qw).try_cast("decimal(38,18)"), pw * qf, pf * qw, (pf * qf).try_cast("decimal(38,18)")]
    total = terms[0]
    for term in terms[1:]:
        total = F.try_add(total, term.try_cast("decimal(38,18)")).try_cast("decimal(38,18)")
    return F.when(short, short_price * short_quantity).otherwise(total.try_cast("decimal(38,16)"))


def _place(ms: Column, trade_id: Column) -> Column:
    """Time, then id, as one number: with a struct to order by, Spark would sort
    all trades before aggregating them instead of hashing."""
    step = F.lit("100000000000000000000").cast("decimal(21,0)")
    earlier = (ms.cast("decimal(15,0)") * step).cast("decimal(38,0)")
    return (earlier + F.coalesce(trade_id, F.lit(-1)).cast("decimal(20,0)")).cast("decimal(38,0)")


SUMS = ("volume", "quote_volume", "trade_count", "taker_buy_volume", "taker_buy_quote_volume")


def period_lengths(periods: Mapping[str, int] | Sequence[str]) -> tuple[dict[str, int], int]:
    """Seconds of each period, and of the shortest, of which all others must be multiples."""
    lengths = dict(periods) if isinstance(periods, Mapping) else {
        p: defaults.CANDLE_PERIODS[p] for p in periods
    }
    base = min(lengths.values())
    if any(seconds % base for seconds in lengths.values()):
        raise ValueError("every period must be a multiple of the shortest")
    return lengths, base


def partial_candles(trades: DataFrame, base: int, ts: str = "trade_time") -> DataFrame:
    """Candles of ``symbol`` and ``slot`` of ``base`` seconds that can be merged.

    ``first`` and ``last`` place the opening and closing trade, so partial candles of
    any division of the trades roll up to the same candles.
    """
    ms, price, quantity = F.unix_millis(ts), F.col("price"), F.col("quantity")
    place = _place(ms, F.col("trade_id"))
    quote = _quote(price, quantity)
    taker = ~F.col("is_buyer_maker")
    return trades.groupBy(
        "symbol", F.call_function("div", ms, F.lit(base * 1000)).alias("slot")
    ).agg(
        F.min(place).alias("first"),
        F.max(place).alias("last"),
        F.min_by(price, place).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, place).alias("close"),
        F.sum(quantity).alias("volume"),
        F.sum(quote).alias("quote_volume"),
        F.count("*").alias("trade_count"),
        F.coalesce(F.sum(F.when(taker, quantity)), F.lit(0)).alias("taker_buy_volume"),
        F.coalesce(F.sum(F.when(taker, quote)), F.lit(0)).alias("taker_buy_quote_volume"),
    )


def _merged() -> list[Column]:
    return [
        F.min_by("open", "first").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last").alias("close"),
        *[F.sum(c).alias(c) for c in SUMS],
    ]


def merge_partials(partials: DataFrame, keys: Sequence[str] = ("symbol", "slot")) -> DataFrame:
    """Partial candles of the same symbol and slot made one, with the columns and types they had."""
    kinds = dict(partials.dtypes)
    ends = [F.min("first").alias("first"), F.max("last").alias("last")]
    merged = partials.groupBy(*keys).agg(*ends, *_merged())
    return merged.select(*[F.col(c).cast(kinds[c]).alias(c) for c in merged.columns])


def roll_up(partials: DataFrame, lengths: Mapping[str, int], base: int) -> DataFrame:
    """Candles of each period from partial candles of ``base`` seconds."""
    listed = F.array(
        *[F.struct(F.lit(p).alias("period"), F.lit(s // base).alias("steps")) for p, s in lengths.items()]
    )
    spread = partials.select("*", F.inline(listed))
    slots = F.call_function("div", F.col("slot"), F.col("steps"))
    rolled = spread.groupBy("symbol", "period", "steps", slots.alias("slot")).agg(*_merged())
    width = F.col("steps") * (base * 1000)
    return rolled.select(
        "symbol",
        "period",
        (F.col("slot") * width).alias("open_ms"),
        ((F.col("slot") + 1) * width - 1).alias("close_ms"),
        "open", "high", "low", "close", *SUMS,
    )


def candles(
    trades: DataFrame,
    periods: Mapping[str, int] | Sequence[str] = tuple(defaults.CANDLE_PERIODS),
    ts: str = "trade_time",
) -> DataFrame:
    """Candles of ``symbol`` for each period, from typed trades.

    Trades are aggregated once, to the shortest period; longer periods that
    are its multiples are rolled up from those few candles. Trades of the same
    millisecond count in the order of their ids.
    """
    lengths, base = period_lengths(periods)
    return roll_up(partial_candles(trades, base, ts), lengths, base)


def candle_gaps(rows: DataFrame, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """Runs of missing candles: ``symbol, period, gap_start_ms, gap_end_ms, missing``.

    ``gap_end_ms`` is the opening of the last missing candle. A gap shows as
    two neighbouring candles too far apart, so no list of all expected slots
    is built or joined. Gaps before the first and after the last candle are
    reported if the range that should be covered is given.
    """
    step = F.col("close_ms") - F.col("open_ms") + 1
    slots = rows.select("symbol", "period", "open_ms", step.alias("step"))
    by_time = Window.partitionBy("symbol", "period").orderBy("open_ms")
    ahead = F.lead("open_ms").over(by_time)
    after = slots.select(
        "symbol",
        "period",
        "step",
        (F.col("open_ms") + F.col("step")).alias("gap_start_ms"),
        (F.coalesce(ahead, F.lit(to_ms).cast("bigint")) - F.col("step")).alias("gap_end_ms"),
    )
    if from_ms is not None:
        leading = slots.groupBy("symbol", "period", "step").agg(F.min("open_ms").alias("first"))
        start = F.call_function("div", F.lit(from_ms) + F.col("step") - 1, F.col("step")) * F.col("step")
        after = after.unionByName(
            leading.select(
                "symbol", "period", "step", start.alias("gap_start_ms"),
                (F.col("first") - F.col("step")).alias("gap_end_ms"),
            )
        )
    end = F.call_function("div", F.col("gap_end_ms"), F.col("step")) * F.col("step")
    return (
        after.withColumn("gap_end_ms", end)
        .filter(F.col("gap_end_ms") >= F.col("gap_start_ms"))
        .withColumn(
            "missing",
            F.call_function("div", F.col("gap_end_ms") - F.col("gap_start_ms"), F.col("step")) + 1,
        )
        .drop("step")
    )


def gap_chunks(gaps: DataFrame, min_missing: int = 1, chunk_ms: int = 7 * 86400 * 1000) -> DataFrame:
    """Gaps of at least ``min_missing`` candles, cut into pieces of a week at most."""
    large = gaps.filter(F.col("missing") >= min_missing)
    starts = F.explode(F.sequence(F.col("gap_start_ms"), F.col("gap_end_ms"), F.lit(chunk_ms).cast("bigint")))
    return large.select(
        "symbol", "period", "gap_start_ms", "gap_end_ms", starts.alias("chunk_start_ms")
    ).withColumn(
        "chunk_end_ms", F.least(F.col("chunk_start_ms") + (chunk_ms - 1), F.col("gap_end_ms"))
    )


def high_water(rows: DataFrame) -> DataFrame:
    """Latest candle per symbol and period: where the next load continues."""
    return rows.groupBy("symbol", "period").agg(F.max("open_ms").alias("last_open_ms"))


def completeness(rows: DataFrame, report_ms: Column | int) -> DataFrame:
    """Present and expected candles, their ratio in percent, and the lag of the newest."""
    report = report_ms if isinstance(report_ms, Column) else F.lit(report_ms)
    step = F.col("close_ms") - F.col("open_ms") + 1
    span = rows.groupBy("symbol", "period", step.alias("step")).agg(
        F.count("*").alias("present"),
        F.min("open_ms").alias("first"),
        F.max("open_ms").alias("last"),
    )
    expected = F.call_function("div", F.col("last") - F.col("first"), F.col("step")) + 1
    return span.select(
        "symbol",
        "period",
        "present",
        expected.alias("expected"),
        percent(F.col("present"), expected).alias("completeness_percent"),
        (report - F.col("last")).alias("lag_ms"),
    )


METRICS = ("records_fetched", "records_written", "duration_seconds", "gaps_found", "gaps_filled")


def _iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def completion_events(completions: DataFrame, prefix: str = defaults.EXTRACTION_PREFIX) -> DataFrame:
    """``subject, value``: one completion event per extraction."""
    event = F.struct(
        F.lit("extraction_completed").alias("event_type"),
        "extraction_type",
        "symbol",
        "period",
        _iso_millis(F.col("timestamp")).alias("timestamp"),
        "success",
        F.struct(*METRICS).alias("metrics"),
        "errors",
    )
    return completions.select(
        subject(prefix, F.col("extraction_type"), F.col("symbol"), F.col("period")).alias("subject"),
        F.to_json(event).alias("value"),
    )


def batch_errors(completions: DataFrame, batch: Sequence[str] = ("extraction_type", "period")) -> DataFrame:
    """``error, n`` of each batch, one row per error text: texts may all be different."""
    every = completions.select(*batch, F.explode("errors").alias("error"))
    return every.groupBy(*batch, "error").agg(F.count("*").alias("n"))


def batch_completion(
    completions: DataFrame, batch: Sequence[str] = ("extraction_type", "period")
) -> DataFrame:
    """One row per batch: totals, symbols, number of errors, whether all succeeded.

    ``batch_errors`` has the error texts.
    """
    keys = list(batch)
    totals = completions.groupBy(*keys).agg(
        F.count("*").alias("extractions"),
        F.every(F.coalesce("success", F.lit(False))).alias("success"),
        F.sum("records_fetched").alias("total_records_fetched"),
        F.sum("records_written").alias("total_records_written"),
        F.sum("duration_seconds").alias("duration_seconds"),
        F.sum("gaps_found").alias("total_gaps_found"),
        F.sum("gaps_filled").alias("total_gaps_filled"),
        F.array_sort(F.collect_set("symbol")).alias("symbols"),
        F.sum(F.coalesce(F.size("errors"), F.lit(0))).alias("total_errors"),
    )
    return totals.withColumn("symbols_processed", F.size("symbols"))


def failed_extractions(completions: DataFrame) -> DataFrame:
    """Unsuccessful extractions, with their number of errors."""
    failed = completions.filter(~F.coalesce("success", F.lit(False)))
    return failed.withColumn("error_count", F.size("errors"))


def job_rollup(results: DataFrame, jobs: Sequence[str] = defaults.JOB_ORDER, attempt: str = "attempt") -> DataFrame:
    """One row per run: its jobs in order, total duration, whether all succeeded.

    Every run should have all of ``jobs``; one that is absent, or has no
    result, failed. Of a job that was tried again the last attempt decides,
    while all attempts count for its duration.
    """
    tried = results.groupBy("run_id", "job").agg(
        F.max_by(F.coalesce("success", F.lit(False)), attempt).alias("success"),
        F.sum("duration_seconds").alias("duration_seconds"),
    )
    expected = F.posexplode(F.array(*[F.lit(j) for j in jobs])).alias("ord", "job")
    due = results.groupBy("run_id").agg(F.count("*").alias("_n")).select("run_id", expected)
    per_job = due.join(tried, ["run_id", "job"], "left").withColumn("success", F.coalesce("success", F.lit(False)))
    listed = F.array_sort(F.collect_list(F.struct("ord", "job", "success", "duration_seconds")))
    return (
        per_job.groupBy("run_id")
        .agg(
            F.every("success").alias("success"),
            F.sum("duration_seconds").alias("total_duration"),
            listed.alias("_jobs"),
        )
        .select(
            "run_id",
            "success",
            "total_duration",
            F.transform("_jobs", lambda j: j["job"]).alias("jobs"),
            F.transform("_jobs", lambda j: j["success"]).alias("job_success"),
            F.transform("_jobs", lambda j: j["duration_seconds"]).alias("job_durations"),
        )
    )
