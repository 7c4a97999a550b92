"""Parsing and routing single frames, checked against a plain restatement."""

import json
import random
import re

from pyspark.sql import functions as F

from tapeworks import defaults
from tapeworks.functions import envelope as env
from tapeworks.functions import frames as fr
from tapeworks.functions import routing
from tapeworks.operators import intake, payloads
from tapeworks.sources import readers, writers

FRAMES = [
    '{"e":"trade","E":1704067201250,"s":"LTCUSDT","t":770031,"p":"71.25","q":"3","b":9001,"a":9002,"T":1704067201248,"m":false,"M":true}',
    '{"e":"24hrTicker","s":"ETHUSDT","c":"1"}',
    '{"e":"depthUpdate","s":"BNBUSDT","U":1,"u":2,"b":[["0.0024","10"]],"a":[]}',
    '{"lastUpdateId":1,"bids":[],"asks":[]}',
    '{"lastUpdateId":1,"bids":[],"asks":null,"s":"SolUsdt"}',
    '{"lastUpdateId":1,"bids":[],"s":"X","e":"y"}',
    '{"lastUpdateId":1,"bids":[],"asks":[],"s":""}',
    '{"lastUpdateId":1,"bids":[],"asks":[],"s":7}',
    '{"e":"kline","s":"BTCUSDT","k":{"i":"1h"}}',
    '{"e":"markPriceUpdate","s":"BTCUSDT"}',
    '{"e":"fundingRate","s":"BTCUSDT"}',
    '{"e":5,"s":"BTC"}',
    '{"e":true,"s":"BTC"}',
    '{"e":0,"s":"BTC"}',
    '{"e":false,"s":"BTC"}',
    '{"e":"0","s":"BTC"}',
    '{"e":"","s":"BTC"}',
    '{"e":[],"s":"BTC"}',
    '{"e":{},"s":"BTC"}',
    '{"e":"trade","s":null}',
    '{"e":"trade","s":0}',
    '{"e":"trade","s":[1]}',
    '{"e":"trade","s":5}',
    '{"e":"trade"}',
    '{"s":"BTC"}',
    '{"E":"trade","S":"BTC"}',
    '{"stream":"btcusdt@trade","data":{"e":"trade","s":"BTCUSDT"}}',
    '{"e":"a","e":"b","s":"X"}',
    '{"e":"tr\\u0061de","s":"B\\"T"}',
    '{"e":"trade","s":"BTC","p":NaN}',
    '{"e":"trade","s":"BTC"} ',
    ' \n\t{"e":"trade","s":"BTC"}\r\n',
    "{}",
    " { } ",
    "[]",
    "[1,2]",
    "null",
    "5",
    '"text"',
    "true",
    "NaN",
    "",
    "   ",
    '{"incomplete": ',
    '{"e":"trade","s":',
    '{"e":"trade","s":"BTC"',
    '{"e":"trade","s":"BTC"} junk',
    '{"e":"trade","s":"BTC"} junk}',
    '{"e":"trade","s":"BTC"}{"e":"x"}',
    '{"e":"trade","s":"BTC",}',
    "{'e':'trade','s':'BTC'}",
    "[1,2] x",
    "[1],[2]",
    "1,2",
    "1] x",
    "nul",
    "not json",
]


def expected(raw):
    """Shape and stream of a frame, as the frame contract has them."""
    try:
        data = json.loads(raw)
    except ValueError:
        return "malformed", None
    if not isinstance(data, dict):
        return "other_json", None
    event, symbol, first = data.get("e", ""), data.get("s", ""), defaults.DEFAULT_STREAMS[0]
    is_book = {"lastUpdateId", "bids", "asks"} <= data.keys()
    if symbol and not isinstance(symbol, str):
        return "object", None
    if is_book:
        return "object", f"{symbol.lower() if symbol else first.split('@')[0]}@depth20@100ms"
    if not event or not symbol:
        return "object", None
    suffix = defaults.EVENT_SUFFIXES.get(event, event) if isinstance(event, str) else event
    return "object", f"{symbol.lower()}@{suffix}"


def frame_table(spark, raws):
    return spark.createDataFrame(list(enumerate(raws)), "frame_id bigint, raw string")


def test_shape_and_stream_of_every_frame(spark):
    got = {r.raw: (r.shape, r.stream) for r in intake.classify(frame_table(spark, FRAMES)).collect()}
    assert got == {raw: expected(raw) for raw in FRAMES}


def test_malformed_frames_do_not_stop_the_rest(spark):
    good = '{"e":"trade","s":"BTC"}'
    classified = intake.classify(frame_table(spark, ["{bad", good, "[]", good]))
    assert intake.published(classified).count() == 2


def test_book_without_symbol_needs_a_named_first_subscription(spark):
    book = frame_table(spark, ['{"lastUpdateId":1,"bids":[],"asks":[]}'])
    stream = lambda subs: intake.classify(book, subs).first().stream
    assert stream(["BtcUsdt@x", "eth@y"]) == "BtcUsdt@depth20@100ms"
    assert stream(["nothing"]) is None
    assert stream([]) is None


def test_dispositions_in_order_of_priority(spark):
    raws = ["{", "[]", "{}", '{"e":"trade","s":"BTC"}']
    happened = {name: F.lit(True) for name in ("queue_full", "not_connected", "publish_error")}
    seen = lambda **k: [r.disposition for r in intake.classify(frame_table(spark, raws), **k).orderBy("frame_id").collect()]
    assert seen() == ["malformed_json", "invalid_format", "unknown_stream", "published"]
    assert seen(**happened) == ["malformed_json", "queue_full", "queue_full", "queue_full"]
    del happened["queue_full"]
    assert seen(**happened)[-1] == "not_connected"
    assert seen(publish_error=F.lit(True))[-1] == "publish_error"
    counts = intake.disposition_counts(intake.classify(frame_table(spark, raws)))
    assert {r.disposition: r.frames for r in counts.collect()} == {
        d: int(d in ("malformed_json", "invalid_format", "unknown_stream", "published"))
        for d in intake.DISPOSITIONS
    }


def test_published_filter_reads_json_once(spark):
    plan = intake.published(intake.classify(frame_table(spark, FRAMES))).select("stream")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(StructField(e,VariantType,true)") == 1


def test_kinds(spark):
    streams = ["btcusdt@trade", "btcusdt@ticker", "btcusdt@depth20@100ms", "a@kline", "a@x@depth@trade", None]
    table = spark.createDataFrame([(s,) for s in streams], "stream string")
    kinds = [r.kind for r in table.select(routing.message_kind(F.col("stream")).alias("kind")).collect()]
    assert kinds == ["trade", "ticker", "depth", "generic", "trade", None]


def test_stream_format(spark):
    cases = {
        "btcusdt@trade": True, "1inchusdt@trade": True, "btc@": True, "123@trade": False,
        "@trade": False, "btcusdt": False, "BTC@trade": False, "Btc@x": False, "": False, None: False,
    }
    table = spark.createDataFrame([(s,) for s in cases], "s string")
    assert {r.s: r.ok for r in table.withColumn("ok", routing.stream_format_ok(F.col("s"))).collect()} == cases


def test_timestamps_both_ways(spark):
    texts = {
        "2024-01-01T12:00:00Z": "2024-01-01T12:00:00Z",
        "2024-01-01T12:00:00": "2024-01-01T12:00:00Z",
        "2024-01-01T12:00:00.123456Z": "2024-01-01T12:00:00.123456Z",
        "2024-01-01T12:00:00.5": "2024-01-01T12:00:00.500000Z",
        "2024-01-01 00:00:00": "2024-01-01T00:00:00Z",
        "2024-01-01": "2024-01-01T00:00:00Z",
        "2024-01-01T12:00:00ZZ": None,
        "2024": None,
        "soon": None,
        None: None,
    }
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    shown = table.withColumn("out", env.format_envelope_ts(env.parse_envelope_ts(F.col("t"))))
    assert {r.t: r.out for r in shown.collect()} == texts


def test_envelope_keeps_the_payload_as_it_was(spark):
    raw = '{"e":"trade","s":"B\\"TC","p":1.50,"P":[["1","2"]],"E":1}'
    frames = frame_table(spark, [raw]).withColumn("recv_ts", F.timestamp_millis(F.lit(1704067200000)))
    traced = F.create_map(F.lit("traceparent"), F.lit("00-1"))
    for trace, extra in ((None, {}), (traced, {"_otel_trace_context": {"traceparent": "00-1"}})):
        enveloped = intake.attach_envelope(
            intake.published(intake.classify(frames)), message_id=F.lit("id-1"), trace=trace
        )
        text = enveloped.select(env.envelope_json(F.col("envelope"))).first()[0]
        assert json.loads(text) == {
            "stream": 'b"tc@trade', "data": json.loads(raw), "timestamp": "2024-01-01T00:00:00Z",
            "message_id": "id-1", "source": "binance-websocket", "version": "1.0", **extra,
        }
        assert '"p":1.50' in text


def test_random_ids_differ(spark):
    ids = [r[0] for r in spark.range(100).select(env.random_message_id()).collect()]
    assert len(set(ids)) == 100


def test_trade_example(spark):
    row = payloads.trades(intake.published(intake.classify(frame_table(spark, FRAMES[:1])))).first()
    assert (row.symbol, row.trade_id, float(row.price), int(row.quantity)) == ("LTCUSDT", 770031, 71.25, 3)
    assert (row.buyer_order_id, row.seller_order_id, row.is_buyer_maker) == (9001, 9002, False)
    assert row.event_time.timestamp() != row.trade_time.timestamp()


def test_ticker_keys_differ_only_by_case(spark):
    raw = (
        '{"e":"24hrTicker","E":1704067200000,"s":"LTCUSDT","p":"-1.5","P":"-2.06","w":"72.4","x":"72.75",'
        '"c":"71.25","Q":"6","b":"71.2","B":"55","a":"71.3","A":"8.5","o":"72.75","h":"73.9",'
        '"l":"70.1","v":"3300","q":"238920","O":1703980800000,"C":1704067200000,"F":41,"L":990,"n":950}'
    )
    row = payloads.tickers(intake.published(intake.classify(frame_table(spark, [raw])))).first()
    assert [float(v) for v in (row.price_change, row.price_change_pct, row.bid, row.bid_qty)] == [-1.5, -2.06, 71.2, 55]
    assert [float(v) for v in (row.last_qty, row.quote_volume, row.open, row.low)] == [6, 238920, 72.75, 70.1]
    assert (row.first_id, row.last_id, row.trade_count) == (41, 990, 950)
    assert (row.close_time - row.open_time).days == 1


def test_levels(spark):
    raw = '{"e":"depthUpdate","s":"B","U":1,"u":2,"b":[["1","10"],["bad","5"]],"a":[["2","3"]]}'
    depth = payloads.depth_updates(intake.published(intake.classify(frame_table(spark, [raw]))))
    one_pass = payloads.book_levels(intake.published(intake.classify(frame_table(spark, [raw]))))
    for levels in (payloads.levels_of(depth), one_pass):
        got = [(r.side, r.level, r.price and float(r.price), float(r.quantity)) for r in levels.collect()]
        assert got == [("bid", 0, 1.0, 10.0), ("bid", 1, None, 5.0), ("ask", 0, 2.0, 3.0)]


def test_subscriptions_and_subjects(spark):
    spec = spark.createDataFrame([(" a@x ,b@y,",), ("",), (None,)], "s string")
    got = [r[0] for r in spec.select(readers.subscription_list(F.col("s"))).collect()]
    assert got == [["a@x", "b@y", ""], list(defaults.DEFAULT_STREAMS), list(defaults.DEFAULT_STREAMS)]
    subjects = ["a.b", "a.b.c", "a", "axb", "a.b.c.d"]
    table = spark.createDataFrame([(s,) for s in subjects], "s string")
    match = lambda p: [r.s for r in table.filter(readers.subject_matches(F.col("s"), p)).collect()]
    assert match("a.*") == ["a.b"]
    assert match("a.>") == ["a.b", "a.b.c", "a.b.c.d"]
    assert match("*.b.*") == ["a.b.c"]
    assert match("a.b") == ["a.b"]
    assert match(">") == subjects


def test_subscribed_only_by_list_and_by_table(spark):
    routed = intake.classify(frame_table(spark, FRAMES))
    streams = ["ltcusdt@trade", "ethusdt@ticker", "ltcusdt@trade"]
    by_list = intake.subscribed_only(routed, streams)
    by_table = intake.subscribed_only(routed, readers.subscriptions(spark, streams))
    assert by_list.count() == by_table.count() == 2


def test_messages_are_validated(spark):
    cases = {
        '{"stream":"a@trade","data":{}}': None,
        '{"stream":"a@trade","data":{},"message_id":null,"timestamp":5}': None,
        '{"data":{}}': "Missing required field: 'stream'",
        '{"stream":"a"}': "Missing required field: 'data'",
        "{}": "Missing required field: 'stream'",
        '"text"': "Invalid message format: not an object",
        '{"stream":null,"data":{}}': "Invalid message format: stream is not a string",
        '{"stream":"a","data":[1]}': "Invalid message format: data is not an object",
        '{"stream":"a","data":null}': "Invalid message format: data is not an object",
        '{"stream":"a","data":{},"message_id":3}': "Invalid message format: message_id is not a string",
    }
    checked = intake.validate_messages(spark.createDataFrame([(c,) for c in cases], "raw string"))
    assert {r.raw: r.error for r in checked.collect()} == cases


def test_landed_frames_are_pruned_by_date_and_type(spark, tmp_path):
    folder = str(tmp_path / "routed")
    frames = frame_table(spark, FRAMES).withColumn(
        "recv_ts", F.timestamp_millis(F.lit(1704067200000) + F.col("frame_id") * 43200000)
    )
    routed = intake.published(intake.classify(frames))
    writers.land_routed(routed, folder)
    landed = readers.read_routed(spark, folder, ["ltcusdt@trade"], "2024-01-01", "2024-01-02")
    assert [r.frame_id for r in landed.collect()] == [0]
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "stream_type" in plan.split("PartitionFilters")[1]
    assert "PushedFilters: [" in plan and "EqualTo(stream,ltcusdt@trade)" in plan
    assert readers.read_routed(spark, folder).count() == routed.count()


def test_odd_frames_survive_a_text_sink(spark, tmp_path):
    raws = ['{"e":"trade",\n"s":"BTC"}', '{"e":"trade","s":"BTC",\r\n"x":[NaN,-Infinity,"NaN \\" Infinity"]}', '{"e":"trade","s":"BTC","y":"\\\\","x":NaN}']
    frames = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "frame_id int, raw string").withColumn("recv_ts", F.lit("2024-01-01").cast("timestamp"))
    messages = writers.to_messages(intake.attach_envelope(intake.published(intake.classify(frames))))
    writers.write_messages(messages, str(tmp_path / "out"))
    back = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]

    def refuse(name):
        raise ValueError(name)

    expected = [json.loads(r, strict=False, parse_constant=lambda name: None) for r in raws]
    key = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(map(key, (m["data"] for m in back))) == sorted(map(key, expected))
    assert all(json.loads(json.dumps(m), parse_constant=refuse) for m in back)


def test_event_types_are_read_once_and_alike(spark):
    """Of repeated keys the last counts, for routing and for typing."""
    raw = '{"e":"x","e":"depthUpdate","s":"B","U":1,"u":2,"b":[],"a":[]}'
    routed = intake.published(intake.classify(frame_table(spark, [raw])))
    assert (payloads.depth_updates(routed).count(), payloads.books(routed).count()) == (1, 0)


def test_candle_and_book_subscriptions(spark):
    raws = [
        '{"e":"kline","s":"BTC","k":{"i":"1h"}}', '{"e":"kline","s":"BTC","k":{"i":"5m"}}', '{"e":"kline","s":"BTC"}',
        '{"lastUpdateId":1,"bids":[],"asks":[],"s":"BTC"}', '{"e":"trade","s":"BTC"}',
    ]
    routed = intake.published(intake.classify(frame_table(spark, raws)))
    wanted = ["btc@kline_1h", "btc@depth5", "eth@trade"]
    by_table = intake.subscribed_only(routed, spark.createDataFrame([(s,) for s in wanted], "stream string"))
    for kept in (intake.subscribed_only(routed, wanted), by_table):
        assert sorted(r.raw for r in kept.collect()) == sorted([raws[0], raws[3]])


def test_unknown_types_share_a_folder(spark, tmp_path):
    raws = [f'{{"e":"made up {i}","s":"B"}}' for i in range(5)] + ['{"e":"trade","s":"B"}']
    frames = frame_table(spark, raws).withColumn("recv_ts", F.lit("2024-01-01").cast("timestamp"))
    writers.land_routed(intake.published(intake.classify(frames)), str(tmp_path / "land"))
    assert sorted(p.name for p in (tmp_path / "land").glob("date=*/*") if p.is_dir()) == ["stream_type=other", "stream_type=trade"]
    back = readers.read_routed(spark, str(tmp_path / "land"), ["b@made up 3"])
    assert [r.raw for r in back.collect()] == [raws[3]]


def plain_one_line(raw):
    """String by string, character by character."""
    out, inside, i = [], False, 0
    text = raw.replace("\r", " ").replace("\n", " ")
    while i < len(text):
        number = None if inside else re.match(r"[+-]?(NaN|Infinity|INF)", text[i:])
        if number:
            out.append("null")
            i += number.end()
        elif inside and text[i] == "\\":
            out.append(text[i : i + 2])
            i += 2
        else:
            inside ^= text[i] == '"'
            out.append(text[i])
            i += 1
    return "".join(out)


def test_one_line_of_many_forms(spark):
    """Escapes of any length before a quote; words of numbers inside and between strings."""
    chance = random.Random(5)
    word = lambda: chance.choice(["NaN", "-Infinity", "+INF", "IN", "N", "+-NaN", "a", " ", "é", " ", "😀"])
    texts = ["", "{}", "[NaN,-Infinity]", '{"a":"' + "\\" * 63 + '" NaN","b":NaN}', '{"a":"' + "\\" * 64 + '","b":NaN}']
    for _ in range(300):
        inner = lambda: "".join(chance.choice([word(), r"\"", r"\\", r"\n"]) for _ in range(chance.randint(0, 8)))
        texts.append("{" + ",\r\n".join(f'"{inner()}":{word()}' for _ in range(chance.randint(0, 5))) + "}")
    texts.append('{"long":"' + r"x\" NaN " * 50_000 + '",' + '"n":NaN,' * 50_000 + '"e":1}')
    rows = spark.createDataFrame([(t,) for t in texts], "raw string").select("raw", fr.one_line(F.col("raw")).alias("line")).collect()
    assert all(r.line == plain_one_line(r.raw) for r in rows)
