"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, lang, source). Capacities are summed from the leaves up;
the token budget then goes down level by level. Among siblings it is divided by
weight, and what a child cannot take goes to its siblings in proportion to
their weights. A parent never gets more than its children can take, so a
shortage reaches the level above only when all siblings are exhausted.

Every leaf repeats whole epochs as far as its budget goes, then takes the
prefix of one more epoch in that epoch's seeded order. The prefix is found from
token sums of 4096 ranges of the order; only the range in which the budget ends
is ordered row by row, so no leaf is sorted as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
# Parameters of the registered query; the pipeline has its own share and epochs, see ``corpus_pipeline``.
SHARE = 0.7  # of the corpus's tokens
EPOCHS = 2
SEED = "mix-1"
WEIGHTS = {
    "domain": {"web": 4.0, "books": 2.0, "forum": 1.0, "news": 1.0},
    "lang": {"en": 5.0, "fr": 2.0, "de": 2.0, "es": 2.0},
}
DOMAINS = ("web", "books", "forum", "news")


def domain_of(source: Column) -> Column:
    """The domain of a source, from the number its name ends in."""
    number = F.try_to_number(F.nullif(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("")), F.lit("999999999"))
    return F.get(F.array(*[F.lit(d) for d in DOMAINS]), F.coalesce(F.pmod(number.cast("int"), F.lit(len(DOMAINS))), F.lit(0)))


def _weight(level: str, weights: dict) -> Column:
    known = weights.get(level, {})
    if any(w < 0 for w in known.values()):
        raise ValueError("weights must not be negative")
    return reduce(lambda c, kv: c.when(F.col(level) == kv[0], F.lit(float(kv[1]))), known.items(), F.when(F.lit(False), F.lit(1.0))).otherwise(
        F.lit(1.0)
    )


def divide(children: DataFrame, parent: list[str]) -> DataFrame:
    """``given`` to each child of a parent with ``budget``, from ``weight`` and ``capacity``.

    Children whose capacity per weight is smallest fill up first: in that order
    a child is full if the rest, divided by weight from it on, would exceed it.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    place = ("ratio", "capacity", "child")
    before = by.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    onward = by.orderBy(*[F.desc(c) for c in place]).rowsBetween(Window.unboundedPreceding, 0)
    ranked = children.withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf"))))
    ranked = ranked.withColumns(
        {"used": F.coalesce(F.sum("capacity").over(before), F.lit(0.0)), "open": F.sum("weight").over(onward)}
    )
    full = (F.col("weight") > 0) & (F.col("capacity") * F.col("open") <= F.col("weight") * (F.col("budget") - F.col("used")))
    ranked = ranked.withColumn("full", full)
    filled = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0.0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(by)
    given = (
        F.when(F.col("full"), F.col("capacity"))
        .when(F.col("weight") > 0, F.col("weight") * F.greatest(F.col("budget") - filled, F.lit(0.0)) / rest)
        .otherwise(F.lit(0.0))
    )
    return ranked.withColumn("given", given)


def budgets(leaves: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: dict = WEIGHTS) -> DataFrame:
    """``domain, lang, source, tokens, budget`` from the token sums of the leaves."""
    weighted = leaves
    for level in LEVELS:
        weighted = weighted.withColumn(f"w_{level}", _weight(level, weights))
    usable = reduce(lambda a, b: a & b, [F.col(f"w_{level}") > 0 for level in LEVELS])
    weighted = weighted.withColumn("room", F.when(usable, F.col("tokens").cast("double") * epochs).otherwise(F.lit(0.0)))
    total = weighted.agg((F.sum("tokens") * F.lit(float(share))).alias("budget"))
    above, parent = total, []
    for i, level in enumerate(LEVELS):
        names = list(LEVELS[: i + 1])
        children = weighted.groupBy(*names, F.col(f"w_{level}").alias("weight")).agg(F.sum("room").alias("capacity"))
        children = children.join(above, parent) if parent else children.withColumn("budget", total.scalar())
        children = children.withColumn("child", F.col(level))
        above = divide(children, parent).select(*names, F.col("given").alias("budget"))
        parent = names
    return leaves.join(above, list(LEVELS)).select(*LEVELS, "tokens", F.floor("budget").cast("bigint").alias("budget"))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    share: float = SHARE,
    epochs: int = EPOCHS,
    weights: dict = WEIGHTS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain: Column | None = None,
) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens, copies`` for every row of ``docs``.

    ``copies`` is how often the document is taken, 0 to ``epochs``. Tokens are
    words; a document without words costs nothing and is taken with the range
    it falls in. Null languages and sources form leaves named ``unknown``.
    Rows that repeat an id and token count are ordered next to each other and
    taken together or not at all. Weights not given are 1; a weight of 0 takes
    nothing. The tokens taken never exceed a leaf's budget.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit("unknown"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (domain if domain is not None else domain_of(source)).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("lang"),
        source.alias("source"),
        F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("bigint").alias("n_tokens"),
    )
    rows = written(spark, rows, "mix-rows")
    leaf = list(LEVELS)
    plan = budgets(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), share, epochs, weights)
    plan = plan.select(
        *leaf,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(epochs)).cast("int").alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0)).alias("left"),
    )
    plan = written(spark, plan, "mix-plan")
    # The order of a leaf's partial epoch: its number is how many whole ones come before.
    def ordered(frame):
        key = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        return frame.withColumn("key", key).withColumn("range", F.substring("key", 1, 3))

    ranked = ordered(rows.join(plan, leaf))
    sums = ranked.groupBy(*leaf, "range").agg(F.sum("n_tokens").alias("sum"), F.first("left").alias("left"))
    before = Window.partitionBy(*leaf).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    ranges = sums.select(
        *leaf,
        "range",
        "start",
        F.when(F.col("start") + F.col("sum") <= F.col("left"), "in").when(F.col("start") > F.col("left"), "out").otherwise("edge").alias("side"),
    )
    placed = written(spark, ranked.join(ranges, [*leaf, "range"]).drop("range"), "mix-placed")
    copies = F.col("whole") + F.col("taken").cast("int")
    answer = ["doc_id", *leaf, "n_tokens"]
    clear = placed.where("side <> 'edge'").withColumn("taken", F.col("side") == "in")
    up_to = Window.partitionBy(*leaf).orderBy("key", "doc_id", "n_tokens").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = placed.where("side = 'edge'").withColumn("taken", F.col("start") + F.sum("n_tokens").over(up_to) <= F.col("left"))
    return clear.unionByName(edge).select(
        *answer, F.when(F.col("whole") >= epochs, F.lit(epochs)).otherwise(copies).cast("int").alias("copies")
    )


def _sql(share=SHARE, epochs=EPOCHS, weights=WEIGHTS, seed=SEED) -> str:
    def weight(level):
        cases = " ".join(f"WHEN {level} = '{k}' THEN {float(v)!r}::double" for k, v in weights.get(level, {}).items())
        return f"(CASE {cases} ELSE 1.0::double END)" if cases else "1.0::double"

    names = ", ".join(f"'{d}'" for d in DOMAINS)
    steps, above, parent = [], None, []
    for i, level in enumerate(LEVELS):
        group = ", ".join(LEVELS[: i + 1])
        join = f"JOIN {above} USING ({', '.join(parent)})" if parent else "CROSS JOIN total"
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        steps.append(f"""c{i} AS (
  SELECT *, sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still
  FROM (SELECT {group}, {weight(level)} AS weight, sum(tokens)::double * {epochs} AS capacity FROM leaves GROUP BY ALL) {join}
  WINDOW w AS ({part} ORDER BY capacity / weight, capacity, {level})
), f{i} AS (
  SELECT *, capacity * still <= weight * (budget - coalesce(used, 0)) AS filled FROM c{i}
), b{i} AS (
  SELECT {group}, CASE WHEN filled THEN capacity ELSE weight * greatest(budget - coalesce(sum(CASE WHEN filled THEN capacity END)
         OVER ({part}), 0), 0) / sum(CASE WHEN NOT filled THEN weight END) OVER ({part}) END AS budget FROM f{i}
)""")
        above, parent = f"b{i}", list(LEVELS[: i + 1])
    return rf"""
WITH d AS (
  SELECT doc_id, list_extract([{names}], (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS bigint), 0) % {len(DOMAINS)} + 1)) AS domain,
         coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS n_tokens
  FROM documents
), leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
total AS (SELECT sum(tokens) * {share!r}::double AS budget FROM leaves),
{", ".join(steps)},
p AS (
  SELECT domain, lang, source, tokens, floor(budget)::bigint AS budget FROM b2 JOIN leaves USING (domain, lang, source)
), k AS (
  SELECT d.*, CASE WHEN tokens > 0 THEN budget // tokens ELSE {epochs} END AS whole,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS remains
  FROM d JOIN p USING (domain, lang, source)
), o AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{seed}:' || whole || ':' || doc_id), doc_id) AS upto FROM k
)
SELECT doc_id, domain, lang, source, n_tokens,
       CASE WHEN whole >= {epochs} THEN {epochs} ELSE whole + (CASE WHEN upto <= remains THEN 1 ELSE 0 END) END::int AS copies
FROM o
"""


OP7_SQL = _sql()
