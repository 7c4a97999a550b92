"""Exact dedup by skew-safe combining, comparing full content at every stage.

1. Within each map task equal texts are combined (the partial aggregation).
2. Groups of equal digest, salt and text are merged.
3. The winners of the salts are combined per digest and text.

Grouping keys hold the normalised text itself, so texts are equal only if their
content is; the digest only says where a text goes. The narrow rows then take
their group's winner by digest and salt, so that a group with a third of all
rows is spread over ``salts`` keys on that join too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import SPACES, maybe_among, whole_text, written

SALTS = 48
# One number orders (code points, smallest id): points * STEP + (TOP - id), 0 for no id.
STEP, TOP = f"{2**65}BD", f"{2**63}BD"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Null texts count as empty and equal each other. Of equal texts the one with
    the most code points, then the smallest id, stays; a null id comes last.
    Rows that repeat id, text and length all count as the row that stays.
    ``digest`` may collide, also on purpose: content decides. Should two
    contents of one digest also share a second hash and their length, the query
    fails rather than merge them.
    """
    if not 1 <= salts <= 62:
        raise ValueError("salts must be 1 to 62")
    norm = F.translate(whole_text(text_col), SPACES, "")
    points = F.char_length(whole_text(text_col))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), norm.alias("norm"), points.alias("points")
    ).select(
        "doc_id",
        "points",
        "norm",
        digest(F.col("norm")).alias("digest"),
        F.xxhash64(F.col("norm"), F.char_length("norm")).alias("mark"),
        F.pmod(F.xxhash64("doc_id", "points"), F.lit(salts)).cast("int").alias("salt"),
    )
    rank = F.expr(f"points * {STEP} + coalesce({TOP} - doc_id, 0BD)")
    salted = rows.groupBy("digest", "mark", "salt", "norm").agg(
        F.max(rank.cast("decimal(38,0)")).alias("best"), F.count("*").alias("n")
    )
    whole = salted.repartition("digest", "mark").groupBy("digest", "mark", "norm").agg(
        F.max("best").alias("best"),
        F.sum("n").alias("n"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"),
    )
    winners = whole.groupBy("digest", "mark").agg(
        F.max("best").alias("best"), F.max("n").alias("group_size"), F.bit_or("salts").alias("salts"),
        F.count("*").alias("contents"),
    )
    by_salt = winners.select(
        "digest",
        "mark",
        F.when(F.col("contents") == 1, F.expr(f"cast(best div {STEP} as int)"))
        .otherwise(F.raise_error(F.lit("different texts share a digest and a second hash")).cast("int"))
        .alias("best_points"),
        F.expr(f"best % {STEP}").alias("low"),
        "group_size",
        F.explode(
            F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.call_function("getbit", F.col("salts"), s) == 1)
        ).alias("salt"),
    )
    keep = F.when(F.col("low") > 0, F.expr(f"cast({TOP} - low as bigint)"))
    narrow = rows.select("doc_id", "points", "digest", "mark", "salt")
    return narrow.join(by_salt, ["digest", "mark", "salt"]).select(
        "doc_id",
        keep.alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(keep) & (F.col("points") == F.col("best_points"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; one row for each text.

    Of repeated rows with one id and text the first by content stays. Only rows
    that may share an id with a row to drop are looked at again.
    """
    verdict = written(spark, groups(docs, id_col, text_col, salts).select("doc_id", "kept", "text_sha256"), "verdict")
    doubtful = verdict.groupBy("doc_id").agg(F.count("*").alias("n"), F.every("kept").alias("kept")).where("n > 1 or not kept")
    doubtful = written(spark, doubtful.select("doc_id"), "doubtful")
    maybe = maybe_among(spark, doubtful, F.col(id_col).cast("bigint"))
    kept = verdict.where("kept").select("doc_id", "text_sha256").distinct()
    kept = kept.withColumnsRenamed({"doc_id": "__keep_id", "text_sha256": "__keep_sha"})
    text = whole_text(text_col)
    sha = F.sha2(F.translate(text, SPACES, ""), 256)
    same = [F.col(id_col).cast("bigint").eqNullSafe(F.col("__keep_id")), sha == F.col("__keep_sha")]
    first = Window.partitionBy("__keep_id", "__keep_sha").orderBy(
        F.char_length(text).desc(), F.xxhash64(*[F.col(c) for c in docs.columns])
    )
    found = docs.where(maybe).join(kept, same[0] & same[1])
    found = found.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").select(*docs.columns)
    return docs.where(~maybe).unionByName(found)


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), w AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""
