"""Secret scans with multipart credential linking.

Three patterns give the base spans. Parts that mean little alone (identifiers,
random-looking values, endpoints) are candidates; they are reported only where
the parts that complete a credential lie within ``SCOPE`` code points in the
same document. Parts apart meet by an interval join on bins of that width. Per
bin only the least and greatest position of each role is kept, which decides
"some part within the scope" exactly, so dense texts make no pairs. Parts that
overlap or contain each other, as a secret in a URL, have no distance; running
bounds of each role find them.

A text is read by regular expressions only. Where the matches lie follows from
the lengths of the pieces between them, summed by a window over the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = ("assign", "access", "hex")
# The same matches for those long enough: a run of hex digits, or one after AKIA, is taken whole.
LONG_ACCESS = r"AKIA[A-Z0-9]{12,}"
LONG_HEX = r"[0-9a-f]{32,}"
# Weak parts.
IDENT = r"(?i:client|account|tenant|user|access)[_-]?(?i:key[_-]?)?(?i:id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{4,}"
# A value may follow an equals sign directly; one after it is padding only where the value ends.
BLOB = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"(?i:https?|wss?|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:@%/?=&-]{4,}"
WEAK = ("ident", "blob", "endpoint")
KINDS = BASE + WEAK
ROLE = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "blob": "secret", "endpoint": "endpoint"}
SCOPE = 300
# What must lie within the scope of each weak part: any of these sets of roles.
NEEDS = {"ident": (("secret",),), "blob": (("ident",), ("endpoint",)), "endpoint": (("ident", "secret"),)}
FOUND = "array<struct<kind:int,i:int,gap:int,m:string>>"


def _matches(text: Column, pattern: str, kind: int, worth: Column) -> Column:
    """Each match with the length of the piece before it."""
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    spots = F.transform(
        every,
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.char_length(F.get(gaps, i)).alias("gap"), m.alias("m")
        ),
    )
    return F.when(worth, spots).otherwise(F.array().cast(FOUND))


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, found`` of every document, as a table: all matches of all kinds."""
    text = F.col("text")
    has = text.rlike
    found = [
        _matches(text, ASSIGN, 0, has(ASSIGN)),
        _matches(text, LONG_ACCESS, 1, text.contains("AKIA")),
        _matches(text, LONG_HEX, 2, has(LONG_HEX)),
        _matches(text, IDENT, 3, has(IDENT)),
        _matches(text, BLOB, 4, has(r"[A-Za-z0-9+/_-]{24}")),
        _matches(text, ENDPOINT, 5, text.contains("://")),
    ]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), whole_text(text_col).alias("text"))
    return written(spark, rows.select("doc_id", "row", F.concat(*found).alias("found")), "secrets")


def parts(scanned: DataFrame) -> DataFrame:
    """``row, kind, start, end`` (code points, end exclusive); base matches too short are dropped."""
    spots = scanned.select("row", F.inline("found"))
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.char_length("m")
    spots = spots.withColumn("end", F.sum(F.col("gap") + length).over(upto)).withColumn("start", F.col("end") - length)
    short = (F.col("kind") == 0) & (F.char_length(F.regexp_extract("m", "^" + ASSIGN, 1)) < 8)
    # A random-looking value has digits and letters of both cases.
    dull = (F.col("kind") == 4) & ~(F.col("m").rlike("[0-9]") & F.col("m").rlike("[a-z]") & F.col("m").rlike("[A-Z]"))
    return spots.where(~short & ~dull).select("row", "kind", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))


def linked(spots: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts of ``spots`` that complementary parts lie near to."""
    roles = [ROLE[k] for k in KINDS]
    role = F.get(F.array(*[F.lit(r) for r in roles]), F.col("kind"))
    weak = F.col("kind") >= len(BASE)
    # A weak part within a base span is that span again, as is the value of an ident (with its padding).
    # An endpoint never lies within one; it may hold some.
    by, place = Window.partitionBy("row"), ("start", "kind", "end")
    earlier = by.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    later = by.orderBy(*[F.desc(c) for c in place]).rowsBetween(Window.unboundedPreceding, -1)
    spots = spots.withColumns(
        {
            "base_end": F.max(F.when(~weak, F.col("end"))).over(earlier),
            "base_start": F.min(F.when(~weak, F.col("start"))).over(later),
            "ident_end": F.max(F.when(F.col("kind") == KINDS.index("ident"), F.col("end"))).over(earlier),
        }
    )
    apart = (F.coalesce("base_end", F.lit(-1)) <= F.col("start")) & (F.coalesce("base_start", F.col("end")) >= F.col("end"))
    value = (F.col("kind") == KINDS.index("blob")) & (F.coalesce("ident_end", F.lit(-1)) >= F.greatest(F.col("start") + 1, F.col("end") - 2))
    whole = F.col("kind") == KINDS.index("endpoint")
    spots = spots.where(~weak | whole | (apart & ~value)).withColumn("role", role)
    # Overlap: a part that starts no later and ends behind this start, or starts later but before this end.
    touches = lambda r: F.when(
        (F.max(F.when(F.col("role") == r, F.col("end"))).over(earlier) > F.col("start"))
        | (F.min(F.when(F.col("role") == r, F.col("start"))).over(later) < F.col("end")),
        F.lit(r),
    )
    spots = spots.withColumn("touching", F.array_compact(F.array(*[touches(r) for r in sorted(set(roles))])))
    bin_of = lambda c: F.call_function("div", c, F.lit(scope))
    sides = F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.col(c).alias("at")) for n, c in enumerate(("end", "start"))]))
    index = spots.select("row", "role", sides.alias("s")).select("row", "role", "s.side", bin_of(F.col("s.at")).alias("bin"), "s.at")
    index = index.groupBy("row", "side", "bin", "role").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    start, end = F.col("start"), F.col("end")
    # Parts to the left by their ends, parts to the right by their starts.
    looks = F.explode(
        F.array(
            *[
                F.struct(F.lit(side).alias("side"), where.alias("bin"), F.lit(n).alias("look"))
                for n, (side, where) in enumerate(
                    ((0, bin_of(start) - 1), (0, bin_of(start)), (1, bin_of(end)), (1, bin_of(end) + 1))
                )
            ]
        )
    )
    part = ["row", "kind", "start", "end", "touching"]
    asked = spots.where(weak).select(*part, looks.alias("l")).select(*part, "l.*")
    near = (
        F.when(F.col("look") == 0, F.col("high") >= start - scope)
        .when(F.col("look") == 1, F.col("low") <= start)
        .when(F.col("look") == 2, F.col("high") >= end)
        .otherwise(F.col("low") <= end + scope)
    )
    met = asked.join(index, ["row", "side", "bin"], "left").groupBy(*part)
    met = met.agg(F.array_union("touching", F.collect_set(F.when(near, F.col("role")))).alias("roles"))
    enough = F.lit(False)
    for n, kind in enumerate(KINDS):
        for need in NEEDS.get(kind, ()):
            every = F.lit(True)
            for other in need:
                every = every & F.array_contains("roles", other)
            enough = enough | ((F.col("kind") == n) & every)
    return met.where(enough).select("row", "kind", "start", "end")


def report(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row the counts of base spans, their digest and all spans as text.

    Null and empty texts have none. Rows that repeat an id are scanned one by one.
    """
    scanned = scan(spark, docs, id_col, text_col)
    spots = parts(scanned)
    every = spots.where(F.col("kind") < len(BASE)).unionByName(linked(spots, scope))
    names = F.array(*[F.lit(k) for k in KINDS])
    by_row = every.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c.getField("kind")), c.getField("start"), c.getField("end"))), ","
    )
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    base = F.filter("spans", lambda c: c.getField("kind") < len(BASE))
    joined = scanned.select("doc_id", "row").join(by_row, "row", "left").withColumn("spans", spans)
    count = lambda kind: F.size(F.filter("spans", lambda c: c.getField("kind") == kind)).cast("bigint")
    counts = [count(n).alias(f"n_{kind}") for n, kind in enumerate(BASE)]
    return joined.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
