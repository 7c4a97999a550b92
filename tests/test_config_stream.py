"""Lists kept by a stream of changes equal the batch replay after every trigger."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tapeworks.operators import config_log
from tapeworks.plans import inputs
from tapeworks.streaming import config_stream

SF = "/root/testdata/sf0.001"
BASE = ("btcusdt@trade", "y", "y")


def told(spark, tmp_path, parts, base):
    """What was told per trigger, each reading one of ``parts``."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
    changes = config_stream.subscription_changes(stream, base)
    save = lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/batch={n}")
    query = changes.writeStream.foreachBatch(save).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return spark.read.schema(StructType([*changes.schema, StructField("batch", IntegerType())])).parquet(out)


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select("scope", "pos", "stream").collect())


def test_equals_the_batch_after_every_trigger(spark, tmp_path):
    log = inputs.config_log(spark, SF).withColumn("scope", F.when(F.col("seq") % 50 > 0, F.concat(F.lit("u"), F.col("seq") % 5)))
    cuts = [0, 300, 301, 700, 10**9]
    parts = [log.where((F.col("seq") >= a) & (F.col("seq") < b)).orderBy(F.desc("seq")) for a, b in zip(cuts, cuts[1:])]
    found = told(spark, tmp_path, parts, BASE)
    for n, end in enumerate(cuts[1:]):
        so_far = config_stream.current(found.where(F.col("batch") <= n))
        assert rows(so_far) == rows(config_log.subscriptions_current(log.where(F.col("seq") < end), BASE)), n
    assert found.where("scope is null").count() > 1


def test_odd_changes_against_a_plain_list(spark, tmp_path):
    rng = random.Random(3)
    names = ["a", "b", "c", "", 'q"', None]
    lists, sequence, batches = {}, 0, []
    for _ in range(3):
        batch = []
        for _ in range(120):
            scope, op, sequence = rng.choice(["s", "", None]), rng.choice(["set", "add", "add", "remove", "remove", "update"]), sequence + 1
            entries = lists.setdefault(scope, ["b", "b"])
            if op == "set":
                streams = rng.choice([None, [], [rng.choice(names) for _ in range(4)]])
                lists[scope] = list(streams or [])
                parameters = {"streams": streams}
            else:
                stream = rng.choice(names)
                parameters = {"stream": stream}
                if op == "add" and stream is not None and stream not in entries:
                    entries.append(stream)
                if op == "remove" and stream is not None and stream in entries:
                    entries.remove(stream)
            batch.append((scope, sequence, op, json.dumps(parameters)))
        batches.append(batch)
    frames = [spark.createDataFrame(b, "scope string, seq bigint, op string, parameters string") for b in batches]
    expected = sorted((str(s), str(i), str(x)) for s, entries in lists.items() for i, x in enumerate(entries))
    got = config_stream.current(told(spark, tmp_path, frames, ["b", "b"]))
    assert rows(got) == expected
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert rows(config_log.subscriptions_current(whole, ["b", "b"])) == expected


def test_late_and_repeated_changes_come_back(spark, tmp_path):
    schema = "scope string, seq bigint, op string, parameters string"
    change = lambda seq, op, stream: ("s", seq, op, json.dumps({"stream": stream, "streams": [stream]}))
    first = spark.createDataFrame([change(5, "set", "a"), change(7, "add", "b"), ("s", None, "add", '{"stream":"z"}')], schema)
    late = spark.createDataFrame([change(6, "set", "c"), change(7, "add", "b"), change(8, "remove", "a")], schema)
    found = told(spark, tmp_path, [first, late], [])
    back = found.where("present is null").select("seq", "stream", "batch").collect()
    assert sorted(tuple(map(str, r)) for r in back) == [("6", "None", "1"), ("7", "b", "1")]
    assert rows(config_stream.current(found)) == [("s", "0", "b")]
