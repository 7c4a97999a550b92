"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.session import prepare, shared_dir

# Fixed value: the white space that separates words, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder that driver and executors share.

    Cuts the lineage, so that a lost executor costs at most a re-read. What was
    shuffled for the table is removed once it is there, rather than when the
    driver happens to collect its garbage.
    """
    path = f"{shared_dir(spark)}/tapeworks-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.parquet(path)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over ``edges`` (columns ``a, b``).

    Alternates large and small stars until nothing changes, a logarithmic
    number of rounds. Every round aggregates map-side and leaves a table in the
    shared folder; only two numbers per round reach the driver.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = written(spark, edges.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(spark, large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = written(spark, small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


BITMAP_BITS = 2**23


def maybe_among(spark: SparkSession, ids: DataFrame, column: Column, bits: int = BITMAP_BITS) -> Column:
    """Whether ``column`` may be in the only column of ``ids``: false at most for others.

    A bitmap of hashes, ``bits`` long whatever the input, goes to the executors
    as the value of a scalar subquery (1 MB). Rows that it rules out need not
    take part in an exact join. The fuller it is the fewer it rules out.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = ids.select(place(F.col(ids.columns[0])).alias("place")).groupBy(F.expr("shiftright(place, 6)").alias("id"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("word"))
    dense = spark.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    row = dense.agg(F.sort_array(F.collect_list(F.struct("id", "word"))).alias("all")).select(F.col("all.word").alias("words"))
    word = F.get(written(spark, row, "bitmap").scalar(), F.call_function("shiftright", place(column), F.lit(6)).cast("int"))
    return F.call_function("getbit", word, (place(column) % 64).cast("int")) == 1
