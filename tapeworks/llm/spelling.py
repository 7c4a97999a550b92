"""Spelling variants by permuterm rotations.

1. Words are counted over all documents; each worker adds up its own first.
2. A word is marked at its end and turned: a rotation that ends in the edited
   character leaves, before it, a prefix that does not depend on that character. Words
   that differ by a replacement have rotations with the same prefix and another last
   character; a word with one character more has a rotation that goes on, by that
   character, from a whole rotation of the shorter word.
3. All rotations are sorted by prefix. A prefix range holds at most one word for each
   character of the alphabet and the shorter word, whatever the corpus. One scan
   tells every word of a range how many neighbours it has there and the most frequent.
   Of equal characters in a row, only the first one counts as the one deleted,
   so that no neighbour is counted twice.
4. A word's form is its most frequent neighbour, if that is frequent enough. Forms
   are followed to the last by doubling the steps: counts grow by a factor with each,
   so there are few.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written
from tapeworks.llm.hashing import mix, stretches

LENGTH = 6
COUNT = 5
RATIO = 5
# The op11 query deletes a character of the runs whose checksum this number divides.
DELETED = 199
# Distinct words that a worker counts before it hands them on.
HELD = 200_000
# Prefixes up to this many characters are sorted as text; rotations of a long word made at once.
LONG = 64
SLICE = 1 << 16
# Marks the end of a word; no word holds it.
END = "$"


def _counted(least: int, deleted: int | None):
    runs = re.compile("[a-zÀ-ÿ]+").findall

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                found = Counter(runs(text.as_py().encode().lower().decode()))
                if deleted:
                    first = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                    for run, n in found.items():
                        code = zlib.crc32(run.encode(), first)
                        if code % deleted == 0:
                            at = code % len(run)
                            run = run[:at] + run[at + 1 :]
                        if len(run) >= least:
                            counts[run] += n
                else:
                    for run, n in found.items():
                        if len(run) >= least:
                            counts[run] += n
                if len(counts) >= HELD:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)

    return count


def words(docs: DataFrame, length: int = LENGTH, count: int = COUNT, deleted: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: runs of letters up to U+00FF, A-Z lower-cased, that are long and frequent enough.

    Null texts have no words. With ``deleted``, a run whose CRC-32 with the
    document's id before it is a multiple loses the character that the checksum points at;
    a null id counts as an empty one.
    """
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), whole_text(text_col).alias("text"))
    counted = texts.mapInArrow(_counted(length, deleted), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _long_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rotations whose prefixes are longer than ``LONG``, each named by the hashes of its two parts."""
    for batch in batches:
        for word, number, n in zip(*batch.columns):
            codes = np.frombuffer(word.as_py().encode("utf-32-le"), "<u4")
            size, hashes = len(codes), mix(codes.astype(np.uint64) + np.uint64(1))
            for inner in (True, False) if size > LONG else (False,):
                for first in range(0, size + (not inner), SLICE):
                    at = np.arange(first, min(first + SLICE, size + (not inner)))
                    parts = stretches(hashes, at + inner, np.full(len(at), size)), stretches(hashes, np.zeros_like(at), at)
                    letters = [chr(c) for c in codes[at].tolist()] if inner else [None] * len(at)
                    lead = (at == 0) | (codes[at] != codes[at - 1]) if inner else np.zeros(len(at), bool)
                    columns = [pa.array([f"{x:016x}{y:016x}" for x, y in zip(*(p.tolist() for p in parts))]), pa.array(letters, pa.string()), pa.array(lead)]
                    same = [pa.array(np.full(len(at), v.as_py(), np.int64)) for v in (number, n)]
                    yield pa.RecordBatch.from_arrays([*columns, *same], names=["prefix", "letter", "lead", "number", "n"])


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, letter, lead, number, n`` of all rotations of ``word, number, n``.

    A rotation that ends in a character of the word has it as ``letter`` and the
    rest as ``prefix``; ``lead`` says that the character before is another. A whole rotation is
    the prefix of others and has no letter. Prefixes of more than ``LONG``
    characters are named by the 64-bit hashes of the parts before and after the
    end mark, so that a long word costs no more than its length.
    """
    turned = f"concat(substring(word, {{0}}), '{END}', substring(word, 1, {{1}}))"
    size = F.char_length("word")
    place = words.where(size <= LONG).withColumn("size", size)
    place = place.withColumn("at", F.explode(F.expr(f"sequence(0, if(size < {LONG}, 2 * size, size - 1))")))
    inner = F.col("at") < F.col("size")
    prefix = F.when(inner, F.expr(turned.format("at + 2", "at"))).otherwise(F.expr(turned.format("at - size + 1", "at - size")))
    letter = F.when(inner, F.expr("substring(word, at + 1, 1)"))
    lead = inner & ((F.col("at") == 0) | F.expr("substring(word, at + 1, 1) <> substring(word, at, 1)"))
    short = place.select(prefix.alias("prefix"), letter.alias("letter"), lead.alias("lead"), "number", "n")
    long = words.where(size >= LONG).select("word", "number", "n")
    return short.unionByName(long.mapInArrow(_long_rotations, "prefix string, letter string, lead boolean, number long, n long"))


def neighbours(spark: SparkSession, words: DataFrame) -> DataFrame:
    """``number, n_near, near, near_n``: how many words are one edit away, and the number of the most frequent.

    Words are named by ``number``; ties go to the least. Words without neighbours are left out.
    """
    ranges = written(spark, rotations(words), "rotations").repartitionByRange("prefix")
    by_count = Window.partitionBy("prefix").orderBy(F.desc("n"), "number")
    all_rows = by_count.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    this = F.struct((-F.col("n")).alias("less"), "number")
    scanned = ranges.withColumns(
        {
            "rank": F.row_number().over(by_count),
            "first": F.first(this).over(all_rows),
            "second": F.nth_value(this, 2).over(all_rows),
            "letters": F.count("letter").over(all_rows),
            "leads": F.count(F.when(F.col("lead"), 1)).over(all_rows),
            "size": F.count("*").over(all_rows),
        }
    ).where("size > 1")
    longer = F.col("letters") - 1 + F.when(F.col("lead"), F.col("size") - F.col("letters")).otherwise(0)
    met = scanned.select(
        "number",
        F.when(F.col("letter").isNull(), F.col("leads")).otherwise(longer).alias("near"),
        F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("first")).alias("best"),
    )
    found = met.groupBy("number").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return found.select("number", "n_near", F.col("best.number").alias("near"), (-F.col("best.less")).alias("near_n"))


def last_forms(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``word, form`` ends. Forms must not go round in a circle."""
    steps = written(spark, forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = steps.join(onward, "root", "left")
        steps = written(spark, joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "forms")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")


def variants(
    spark: SparkSession,
    docs: DataFrame,
    length: int = LENGTH,
    count: int = COUNT,
    ratio: int = RATIO,
    deleted: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words``.

    A word's form is its most frequent neighbour if that occurs ``ratio`` (at
    least 2) times as often, else null; ``root`` is where forms end, the word itself if it has none.
    """
    counted = words(docs, length, count, deleted, id_col, text_col)
    # Numbers in code-point order stand for the words from here on.
    ordered = counted.repartitionByRange("word").sortWithinPartitions("word")
    known = written(spark, ordered.withColumn("number", F.monotonically_increasing_id()), "words")
    judged = known.join(neighbours(spark, known), "number", "left").withColumn("chosen", F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False)))
    forms = judged.where("chosen").select("number", "near").join(known.select(F.col("number").alias("near"), F.col("word").alias("form")), "near")
    judged = judged.join(forms.select("number", "form"), "number", "left")
    judged = judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", F.when(F.col("chosen"), F.col("near_n")).alias("form_n"))
    judged = written(spark, judged, "variants")
    roots = last_forms(spark, judged.where("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


OP11_SQL = r"""
WITH RECURSIVE byte AS (
  SELECT i, 0 AS step, i::ubigint AS v FROM range(256) r(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::ubigint) ELSE v // 2 END FROM byte WHERE step < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM byte WHERE step = 8),
run AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents
), r AS (SELECT doc_id, run, count(*) AS n FROM run GROUP BY doc_id, run),
h AS (
  SELECT run, n, xor(list_reduce(
    flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::ubigint] ELSE [195::ubigint, (128 + unicode(c) % 64)::ubigint] END)),
    lambda a, b: xor(a // 256, t[(xor(a, b) % 256 + 1)::int]), 4294967295::ubigint), 4294967295::ubigint) AS h FROM r, crc
), w AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word, n FROM h
), word AS MATERIALIZED (SELECT word, sum(n)::bigint AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
place AS (SELECT word, unnest(range(0, length(word))) AS i FROM word),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i::int) || substr(word, i::int + 2) AS d FROM place),
near AS MATERIALIZED (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT cut.word, d FROM cut JOIN word ON word.word = d
  UNION SELECT d, cut.word FROM cut JOIN word ON word.word = d
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(near, (-word.n, near)) AS near, max(word.n) AS near_n
  FROM near JOIN word ON word.word = near.near GROUP BY near.word
), f AS MATERIALIZED (
  SELECT word.word, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * word.n THEN near END AS form,
    CASE WHEN near_n >= 5 * word.n THEN near_n END AS form_n FROM word LEFT JOIN best ON best.word = word.word
), walk AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL
), root AS (SELECT walk.word, walk.at AS root FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN root ON root.word = f.word
"""
