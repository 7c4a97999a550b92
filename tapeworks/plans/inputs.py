"""Inputs of the registered queries, derived row by row from ``events``.

Each event becomes one raw frame (trade, ticker, depth, other or one of eight
kinds of bad frame), and likewise one call outcome, one configuration change,
one job result and one extraction completion, so that every query's work
grows with the table it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.defaults import JOB_ORDER
from tapeworks.session import prepare

SYMBOLS = ("BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "ADAUSDT")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the helper columns the recipes below use."""
    prepare(spark)
    symbols = F.array(*[F.lit(s) for s in SYMBOLS])
    ts = F.col("ts").cast("timestamp")
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.select(
        "event_id",
        "user_id",
        "event_type",
        ts.alias("ts"),
        F.unix_millis(ts).alias("ms"),
        F.get(symbols, (F.col("user_id") % 5).cast("int")).alias("sym"),
        F.col("value").cast("decimal(18,2)").alias("p"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def frames(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``frame_id, recv_ts, raw``: one raw JSON frame per event."""
    ev = events(spark, sf_dir)
    i, ms, sym, p, user = (F.col(c) for c in ("event_id", "ms", "sym", "p", "user_id"))
    q = F.col("k") + 1
    head = lambda event: _text('{"e":"', event, '","E":', ms, ',"s":"', sym, '"')
    is_even = F.when(i % 2 == 0, F.lit("true")).otherwise(F.lit("false"))
    one_up, two_up = ((p + F.lit(n).cast("decimal(3,2)")).cast("decimal(18,2)") for n in (1, 2))
    trade = _text(
        head("trade"), ',"t":', i, ',"p":"', p, '","q":"', q, '","b":', user, ',"a":', i % 97,
        ',"T":', ms, ',"m":', is_even, ',"M":true}',
    )
    ticker = _text(head("24hrTicker"), ',"c":"', p, '","o":"', one_up, '","v":"', q, '","n":', q, "}")
    depth = _text(
        head("depthUpdate"), ',"U":', i, ',"u":', i + 1, ',"b":[["', p, '","', q, '"]],"a":[["',
        one_up, '","', q, '"],["', two_up, '","', q + 1, '"]]}',
    )
    other = F.get(
        F.array(*[F.lit(e) for e in ("kline", "markPriceUpdate", "fundingRate", "aggTrade")]),
        (i % 4).cast("int"),
    )
    kline = _text(
        head(other), ',"k":{"t":', ms - ms % 60000, ',"T":', ms - ms % 60000 + 59999, ',"s":"', sym, '","i":"',
        F.when(i % 8 == 0, "1h").otherwise("5m"), '","o":"', p, '","c":"', one_up, '","h":"', two_up, '","l":"', p,
        '","v":"', q, '","n":', q, ',"x":', is_even, "}}",
    )
    book = _text('{"lastUpdateId":', i, ',"bids":[["', p, '","', q, '"]],"asks":null')
    bad = (
        F.when(i % 8 == 0, F.lit('{"e":"trade","s":'))
        .when(i % 8 == 1, F.lit("[1,2]"))
        .when(i % 8 == 2, F.lit("null"))
        .when(i % 8 == 3, _text('{"s":"', sym, '"}'))
        .when(i % 8 == 4, F.lit('{"e":"trade","s":null}'))
        .when(i % 8 == 5, _text(book, "}"))
        .when(i % 8 == 6, _text(book, ',"s":"', sym, '"}'))
        .otherwise(F.lit('{"stream":"btcusdt@trade","data":{"e":"trade","s":"BTCUSDT"}}'))
    )
    kind = F.col("event_type")
    raw = (
        F.when(kind == "purchase", trade)
        .when(kind == "view", ticker)
        .when(kind == "click", depth)
        .when((kind == "signup") & (i % 4 == 0), kline)
        .when((kind == "signup") & (i % 4 == 1), _text(head(other), ',"p":"', one_up, '","i":"', p, '","r":"0.0001","T":', ms, "}"))
        .when((kind == "signup") & (i % 4 == 2), _text(head(other), ',"r":"-0.0003","T":', ms, "}"))
        .when(kind == "signup", _text(head(other), "}"))
        .otherwise(bad)
    )
    return ev.select(i.alias("frame_id"), F.col("ts").alias("recv_ts"), raw.alias("raw"), *keep)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, raw``: envelopes, seven in eight of them faulty in some way."""
    i, sym = F.col("event_id"), F.lower(F.col("sym"))
    stream = _text('"stream":"', sym, '@trade"')
    data, stamp = F.lit('"data":{"e":"trade"}'), F.lit('"timestamp":"2024-01-01T00:00:00Z"')
    raw = (
        F.when(i % 8 == 0, _text("{", stream, ",", data, ",", stamp, "}"))
        .when(i % 8 == 1, _text("{", data, ",", stamp, "}"))
        .when(i % 8 == 2, _text("{", stream, "}"))
        .when(i % 8 == 3, F.lit("{}"))
        .when(i % 8 == 4, F.lit('"just text"'))
        .when(i % 8 == 5, _text("{", stream, ',"data":[1]}'))
        .when(i % 8 == 6, _text('{"stream":5,', data, ',"timestamp":null}'))
        .otherwise(_text("{", stream, ",", data, ',"message_id":7}'))
    )
    return events(spark, sf_dir).select("event_id", raw.alias("raw"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call outcomes per name; every error is a failed call."""
    return events(spark, sf_dir).select(
        F.col("sym").alias("name"),
        "ts",
        F.col("event_id").alias("seq"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("k").alias("duration_ms"),
    )


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of which some have no name and some no time."""
    i = F.col("seq")
    return outcomes(spark, sf_dir).withColumns(
        {"name": F.when(i % 50 != 0, F.col("name")), "ts": F.when(i % 51 != 0, F.col("ts"))}
    )


def config_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration changes, one scope per user."""
    i, k, sym = F.col("event_id"), F.col("k"), F.lower(F.col("sym"))
    types = F.array(F.lit("trade"), F.lit("ticker"), F.lit("kline_1h"))
    stream = lambda n: F.concat(sym, F.lit("@"), F.get(types, (n % 3).cast("int")))
    is_streams = k % 4 >= 2
    change = (
        F.when(F.col("event_type") == "signup", "set")
        .when(F.col("event_type").isin("purchase", "view"), "add")
        .otherwise("remove")
    )
    listed = F.when(
        i % 2 == 0, _text('{"streams":["', stream(i), '","', stream(i + 1), '","', stream(i), '"]}')
    ).otherwise(_text('{"streams":["', stream(i), '"]}'))
    parameters = (
        F.when(k % 4 == 0, _text('{"reconnect_delay":', k + 1, "}"))
        .when(k % 4 == 1, _text('{"failure_threshold":', k % 50 + 1, "}"))
        .when(change == "set", listed)
        .otherwise(_text('{"stream":"', stream(i), '"}'))
    )
    kinds = F.when(is_streams, "streams").when(k % 4 == 0, "reconnection").otherwise("circuit_breaker")
    return events(spark, sf_dir).select(
        _text("user-", F.col("user_id")).alias("scope"),
        i.alias("seq"),
        kinds.alias("config_type"),
        F.when(is_streams, change).otherwise("update").alias("op"),
        parameters.alias("parameters"),
        F.col("event_type").alias("changed_by"),
        _text("ticket ", k).alias("reason"),
    )


CONFIG_TYPES = ("streams", "reconnection", "circuit_breaker", "other")


def config_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation requests with good and bad parameters of every type."""
    i, k, sym = F.col("event_id"), F.col("k"), F.col("sym")
    pick = lambda *options: F.get(F.array(*options), (k % 6).cast("int"))
    text = lambda *parts: _text(*parts)
    streams = pick(
        text('{"streams":["', F.lower(sym), '@trade"]}'),
        text('{"streams":["', sym, '@trade","bad"]}'),
        text('{"streams":"abc"}'),
        text('{"streams":[5,true,null]}'),
        text("{}"),
        text('{"streams":[""]}'),
    )
    reconnection = pick(
        text('{"reconnect_delay":', k, ',"max_reconnect_attempts":', k + 40, "}"),
        text('{"reconnect_delay":92233720368547758', k + 400, ',"max_reconnect_attempts":0}'),
        text('{"reconnect_delay":"5"}'),
        text('{"reconnect_delay":5.5,"max_reconnect_attempts":null}'),
        text('{"reconnect_delay":true,"max_reconnect_attempts":false}'),
        text("{}"),
    )
    breaker = pick(
        text('{"failure_threshold":', k, ',"recovery_timeout":', k * 10, "}"),
        text('{"failure_threshold":[1],"recovery_timeout":{}}'),
        text('{"failure_threshold":51}'),
        text('{"recovery_timeout":9}'),
        text('{"failure_threshold":', k, "}"),
        text('{"recovery_timeout":', k * 8, "}"),
    )
    parameters = F.get(F.array(streams, reconnection, breaker, F.lit("{}")), (i % 4).cast("int"))
    kinds = F.get(F.array(*[F.lit(t) for t in CONFIG_TYPES]), (i % 4).cast("int"))
    return events(spark, sf_dir).select("event_id", kinds.alias("config_type"), parameters.alias("parameters"))


PERIODS = ("15m", "1h", "1d")
ERRORS = ("API rate limit exceeded", "Connection timeout")


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction completions; every error is a failed one."""
    k, failed = F.col("k"), F.col("event_type") == "error"
    texts = F.array(*[F.lit(e) for e in ERRORS])
    return events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") == "view", "klines_gap_filling").otherwise("klines").alias("extraction_type"),
        F.col("sym").alias("symbol"),
        F.get(F.array(*[F.lit(p) for p in PERIODS]), (k % 3).cast("int")).alias("period"),
        F.col("ts").alias("timestamp"),
        (~failed).alias("success"),
        (k * 10).alias("records_fetched"),
        F.when(failed, 0).otherwise(k * 10).cast("bigint").alias("records_written"),
        F.col("p").alias("duration_seconds"),
        (k % 4).alias("gaps_found"),
        F.when(failed, 0).otherwise(k % 4).cast("bigint").alias("gaps_filled"),
        F.when(failed, F.slice(texts, F.lit(1), (F.col("event_id") % 2 + 1).cast("int")))
        .otherwise(F.array().cast("array<string>"))
        .alias("errors"),
    )


def job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four jobs per run; some absent, some without a result, some tried twice."""
    i, jobs = F.col("event_id"), F.array(*[F.lit(j) for j in JOB_ORDER])
    done = F.when(F.col("k") % 10 != 0, F.col("event_type") != "error")
    tries = F.when(i % 16 == 3, F.array().cast("array<int>")).when(i % 6 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    return events(spark, sf_dir).select(
        F.call_function("div", i, F.lit(4)).alias("run_id"),
        F.get(jobs, (i % 4).cast("int")).alias("job"),
        done.alias("_done"),
        F.col("p").alias("duration_seconds"),
        F.explode(tries).alias("attempt"),
    ).withColumn("success", (F.col("attempt") == 2) & F.col("_done")).drop("_done")
