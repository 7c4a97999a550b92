"""URL filters by a cascade of Bloom filters, exact over the corpus's keys.

Level 1 encodes the listed keys. The keys of the corpus that it wrongly accepts
are encoded by level 2, the listed keys that level 2 wrongly accepts by level 3,
and so on until a level accepts nothing wrongly. For every key of the universe
the first level that rejects it tells exactly whether it is listed, so pages are
judged by a few bit tests, without a join and without the list itself.

The lists are tables of any size: rules by host and path, and hosts. A cascade
needs some bits per listed key that the corpus has, whatever the number of pages.
Keys are dealt by hash to the shards of a level, bit arrays of ``max_bits`` at most
that are put together one by one. A level's shards travel to the executors as the
value of a scalar subquery, and a key looks into one of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import prepare, written

MAX_BITS = 2**23


@dataclass(frozen=True)
class Level:
    words: DataFrame | None  # one row: per shard its bits as an array of longs
    shards: int
    bits: int  # of a shard
    hashes: int
    number: int

    def accepts(self, key: Column) -> Column:
        bits = F.get(self.words.scalar(), self.shard(key).cast("int"))
        tests = [
            F.call_function("getbit", F.get(bits, F.call_function("shiftright", place, F.lit(6)).cast("int")), (place % 64).cast("int")) == 1
            for place in (self.place(key, j) for j in range(self.hashes))
        ]
        return reduce(lambda a, b: a & b, tests)

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(-1)), F.lit(self.shards)) if self.shards > 1 else F.lit(0)

    def place(self, key: Column, j: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.bits))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether ``key``, one of the universe, is listed; false for null."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.accepts(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return key.isNotNull() & answer


def _level(spark: SparkSession, keys: DataFrame, n: int, rate: float, number: int, max_bits: int) -> Level:
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    needed = max(1, math.ceil(n * hashes / math.log(2) / 64))  # longs
    shards = math.ceil(needed / max(1, max_bits // 64))
    longs = math.ceil(needed / shards)
    level = Level(None, shards, 64 * longs, hashes, number)
    place = F.explode(F.array(*[level.place(F.col("key"), j) for j in range(hashes)])).alias("place")
    at = F.expr("shiftright(place, 6)") + F.col("shard") * longs
    words = keys.select(level.shard(F.col("key")).alias("shard"), place).groupBy(at.alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("word")
    )
    dense = spark.range(shards * longs).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    rows = dense.groupBy(F.call_function("div", F.col("id"), F.lit(longs)).alias("shard"))
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("id", "word"))).alias("all")).select("shard", F.col("all.word").alias("words"))
    row = rows.agg(F.sort_array(F.collect_list(F.struct("shard", "words"))).alias("all")).select(F.col("all.words").alias("words"))
    return replace(level, words=written(spark, row, "cascade-level"))


def cascade(spark: SparkSession, universe: DataFrame, listed: str, max_bits: int = MAX_BITS) -> Cascade:
    """The cascade of ``universe`` (``key`` once each, and a boolean column ``listed``).

    ``max_bits`` bounds a shard of a level, not the list.
    """
    counts = universe.groupBy(listed).count().collect()
    n = sum(r["count"] for r in counts if r[0])
    others = sum(r["count"] for r in counts if not r[0])
    if n == 0:
        return Cascade((_level(spark, universe.where(listed), 0, 0.5, 1, max_bits),))
    rate = min(0.5, max(2.0**-30, n / max(1, others)))
    inside, outside = universe.where(F.col(listed)), universe.where(~F.col(listed))
    levels: list[Level] = []
    while n:
        levels.append(_level(spark, inside, n, rate, len(levels) + 1, max_bits))
        inside, outside = outside.where(levels[-1].accepts(F.col("key"))), inside
        n, rate = inside.count(), 0.5
    return Cascade(tuple(levels))


# Rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Words that put a host on the block list when a label of its name, cut at hyphens, is one of them.
LISTED_WORDS = ("adult", "bet", "bets", "casino", "poker", "porn", "pills", "viagra", "xxx")


def lower(text: Column) -> Column:
    """``text`` lower-cased in A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """``verdict, host, path`` rows of ``rules``, a table or tuples; hosts lower-cased in A-Z.

    Rows with a null or another verdict than allow or block fall out, as do
    paths that do not start with a slash: no url's path does so otherwise.
    """
    if not isinstance(rules, DataFrame):
        each = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
        none = F.array().cast("array<struct<verdict:string,host:string,path:string>>")
        rules = spark.range(1).select(F.inline(F.array(*each) if each else none))
    known = F.col("verdict").isin("allow", "block") & F.col("path").startswith("/") & (F.col("host") != "")
    return rules.where(known).select("verdict", lower(F.col("host")).alias("host"), "path")


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The pairs of a host's number of labels and a path's length among ``rules``, few however many rules."""
    pairs = rules.select(F.size(F.split("host", r"\.")).alias("depth"), F.char_length("path").alias("length")).distinct()
    return sorted(tuple(pair) for pair in pairs.collect())


def candidates(host: Column, path: Column, pairs: list[tuple[int, int]]) -> list[Column]:
    """The keys by which a page can meet a rule of each shape; null where it has no such key."""
    labels = F.size(F.split(host, r"\."))
    return [
        F.when(
            (labels >= depth) & (F.char_length(path) >= length) & (host != ""),
            F.concat(F.substring_index(host, ".", -depth), F.substring(path, 1, length)),
        )
        for depth, length in pairs
    ]


def listed_host(host: Column, words=LISTED_WORDS) -> Column:
    return host.rlike(r"(^|[.-])(" + "|".join(words) + r")([.-]|$)")


def judge(
    spark: SparkSession,
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    words=LISTED_WORDS,
    hosts: DataFrame | None = None,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``rules`` is a table ``verdict, host, path`` or tuples of these; the longest
    rule that fits gives the verdict, block where the lists hold it as both.
    Pages that no rule fits are blocked if their host is listed and allowed
    otherwise, also when they have no host. Listed are the hosts of the table
    ``hosts`` (column ``host``; nulls, empty and repeated ones count for
    nothing); without one, those with a label in ``words``. Null urls have
    empty host and path; empty lists fit nothing.

    Lists and pages meet once, in the aggregation that makes the universe of
    keys distinct. The pages themselves are only tested against bits.
    """
    host, path = parts(F.col(url_col))
    named = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rules = rule_table(spark, rules)
    keys = candidates(F.col("host"), F.col("path"), shapes(rules))
    # Hosts have no slash and rules always have one, so both fit one universe.
    marked = lambda key, seen=F.lit(False), allow=F.lit(False), block=F.lit(False): [
        key.alias("key"), seen.alias("seen"), allow.alias("allow"), block.alias("block")
    ]
    known = F.lit(False) if hosts is not None else listed_host(F.col("host"), words)
    met = [named.select(*marked(F.col("host"), seen=F.lit(True), block=known))]
    if keys:
        met.append(named.select(F.explode(F.array_compact(F.array(*keys))).alias("key")).select(*marked(F.col("key"), seen=F.lit(True))))
    verdict = F.col("verdict")
    met.append(rules.select(*marked(F.concat("host", "path"), allow=verdict == "allow", block=verdict == "block")))
    if hosts is not None:
        met.append(hosts.where("host <> ''").select(*marked(lower(F.col("host")), block=F.lit(True))))
    flags = [F.bool_or(flag).alias(flag) for flag in ("seen", "allow", "block")]
    universe = reduce(DataFrame.unionByName, met).groupBy("key").agg(*flags).where("seen").drop("seen")
    universe = written(spark, universe, "url-keys")
    allow, block = (cascade(spark, universe, flag, max_bits) for flag in ("allow", "block"))
    numbers = range(len(keys))
    told = [F.when(block.contains(F.col(f"__key{i}")), "block").when(allow.contains(F.col(f"__key{i}")), "allow") for i in numbers]
    hits = F.greatest(
        *[F.lit(None).cast("struct<n:int,rule:string,verdict:string>")] * 2,
        *[
            F.when(F.col(verdict).isNotNull(), F.struct(F.char_length(c).alias("n"), F.col(c).alias("rule"), F.col(verdict).alias("verdict")))
            for c, verdict in ((f"__key{i}", f"__told{i}") for i in numbers)
        ],
    )
    return (
        named.withColumns({f"__key{i}": key for i, key in enumerate(keys)})
        .withColumns({f"__told{i}": verdict for i, verdict in enumerate(told)})
        .withColumn("hit", hits)
        .select(
            "page_id",
            "host",
            "path",
            F.col("hit.rule").alias("rule"),
            F.coalesce("hit.verdict", F.when(block.contains(F.col("host")), "block").otherwise("allow")).alias("verdict"),
        )
    )


def _sql(rules=RULES, words=LISTED_WORDS) -> str:
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return rf"""
WITH r(verdict, rhost, rpath) AS (VALUES {listed}),
u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
)
SELECT page_id, host, path,
       max_by(rhost || rpath, length(rhost || rpath)) AS rule,
       coalesce(max_by(r.verdict, length(rhost || rpath)),
                CASE WHEN regexp_matches(any_value(host), '(^|[.-])({"|".join(words)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
GROUP BY page_id, host, path
"""


OP3_SQL = _sql()
