"""Substring dedup by prefix-partitioned suffix trees.

A window is ``window`` consecutive words. Every window holds a sample: the run
of ``run`` words with the least hash in it, the first of equals. Windows of the
same words hold the same sample at the same place, so only suffixes around
samples that occur twice can share a window, and the stretch of text around a
sample holds all windows of it.

Equal stretches are one leaf with a count; most repeats end here. Samples with
several leaves need their words: one occurrence of each leaf is cut from the
texts and dealt to suffix trees by the sample, the prefix its suffixes share.
Where a sample occurs more often than a task should hold, its windows are dealt
by a longer prefix, all of their words, and counted there. A tree's suffixes in
order show its inner nodes; those at least ``window`` words deep are repeats,
and the suffixes below them are removed wherever their leaf occurs.

The texts cross the network once: both the cut and the removal read the same
exchange. Samples, leaves and places are narrow rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written
from tapeworks.llm.hashing import WordHashes, runs, stretches, task_words

WINDOW = 35
RUN = 8
TREE = 4000  # occurrences of a sample in one tree


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").split()


def samples(hashes: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the samples and the first and last window start that each stands for."""
    width = window - run + 1
    starts = len(hashes) - width + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 3
    # Leftmost least of every stretch of ``width`` hashes, by doubling.
    best, place, span = hashes, np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        left, right = slice(0, len(best) - step), slice(step, len(best))
        later = best[right] < best[left]
        best, place = np.where(later, best[right], best[left]), np.where(later, place[right], place[left])
        span += step
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], first, np.append(first[1:], starts) - 1


def _samples(window: int, run: int):
    """Of every sample its hash, its stretch's hash, first window start and number of windows."""

    def samples_of(batch: pa.RecordBatch, hashed: WordHashes) -> pa.RecordBatch | None:
        parts = []
        for k, c, text in zip(*(column.to_pylist() for column in batch.columns)):
            words = words_of(text)
            if len(words) < window:
                continue
            named = hashed.of(words)
            hashes = runs(named, run)
            place, first, last = samples(hashes, window, run)
            leaf = stretches(named, first, last + window)
            parts.append((hashes[place].view(np.int64), leaf.view(np.int64), np.full(len(place), k), np.full(len(place), c), first, last - first + 1))
        if not parts:
            return None
        columns = [np.concatenate(c) for c in zip(*parts)]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds)], names=["key", "leaf", "k", "c", "first", "n"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_words() as hashed:
            for batch in batches:
                if found := samples_of(batch, hashed):
                    yield found

    return find


def _cut(window: int, whole: bool):
    """The wanted stretches of each text; or each window of them, named by its words' digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                words = words_of(text)
                for w in wanted:
                    first, n = w["first"], w["n"]
                    if whole:
                        rows.append((w["key"], w["leaf"], 0, b" ".join(words[first : first + n + window - 1])))
                    else:
                        rows += [
                            (w["key"], w["leaf"], p, hashlib.sha256(b" ".join(words[first + p : first + p + window])).digest())
                            for p in range(n)
                        ]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["key", "leaf", "place", "words"]
            )

    return cut


def repeated_suffixes(suffixes: list[tuple[bytes, int, int]], window: int) -> list[tuple[int, int]]:
    """``(leaf, place)`` of the suffixes below an inner node at least ``window`` words deep.

    ``suffixes`` hold their first ``window`` words, so that depth is reached
    where neighbours in order are equal.
    """
    suffixes.sort()
    found, n = [], len(suffixes)
    for i, (prefix, leaf, place) in enumerate(suffixes):
        if (i and suffixes[i - 1][0] == prefix) or (i + 1 < n and suffixes[i + 1][0] == prefix):
            found.append((leaf, place))
    return found


def windows_of(stretch: bytes, window: int) -> list[bytes]:
    words = stretch.split(b" ")
    return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]


def _trees(window: int):
    """Builds a tree for each run of rows with one key; gives each leaf its repeated places."""

    def grow(key, leaves):
        suffixes = [(w, leaf, p) for leaf, stretch in leaves.items() for p, w in enumerate(windows_of(stretch, window))]
        return [(key, leaf, place) for leaf, place in repeated_suffixes(suffixes, window)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.int32()])], names=["key", "leaf", "place"]
            )

        now, leaves, found = None, {}, []
        for batch in batches:
            for key, leaf, stretch in zip(*(column.to_pylist() for column in batch.columns)):
                if key != now:
                    found += grow(now, leaves)
                    now, leaves = key, {}
                leaves[leaf] = stretch
            if len(found) > 50_000:
                yield batch_of(found)
                found = []
        yield batch_of(found + grow(now, leaves))

    return build


def _remove(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"doc_id": [], "n_words": [], "n_removed": [], "kept_text": []}
            for doc_id, text, spans in zip(*(column.to_pylist() for column in batch.columns)):
                words, kept, free, count = words_of(text), [], 0, 0
                for start, end in sorted((s["place"], s["place"] + s["n"] + window - 1) for s in spans or []):
                    kept += words[free:start]
                    count += max(0, end - max(start, free))
                    free = max(free, end)
                kept += words[free:]
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_removed"].append(count)
                out["kept_text"].append(b" ".join(kept).decode("utf-8"))
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    return remove


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    window: int = WINDOW,
    run: int = RUN,
    tree: int = TREE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row.

    A word goes if a window that covers it starts with the same words anywhere
    else, in the same text or another. Null texts have no words; texts of fewer
    words than a window lose none. Rows that repeat an id, or have none, are
    texts of their own, told apart by 128 bits of id and text.
    ``tree`` changes how repeats are found, not which.
    """
    if not 0 < run <= window:
        raise ValueError("a sample must fit into a window")
    kind = dict(docs.dtypes)[id_col]
    text = whole_text(text_col)
    # A row's name is 128 bits of its id and text; a null id hashes as no id at all.
    name = [F.xxhash64(id_col, text), F.xxhash64(F.lit(5), text, id_col)]
    texts = docs.select(name[0].alias("k"), name[1].alias("c"), F.col(id_col).alias("doc_id"), text.alias("text"))
    row = ["k", "c"]
    found = texts.select(*row, "text").mapInArrow(_samples(window, run), "key long, leaf long, k long, c long, first int, n int")
    found = written(spark, found, "samples")
    # Both are written: so the join is one of two plain tables, whose frequent keys Spark
    # deals to several tasks, and rows meet only by leaf, counted by each task first.
    often = written(spark, found.groupBy("key").agg(F.count("*").alias("times")).where("times > 1"), "often")
    repeated = written(spark, found.join(often, "key"), "repeated")
    leaves = repeated.groupBy("key", "leaf", "times", "n").agg(F.count("*").alias("held"), *[F.first(c).alias(c) for c in (*row, "first")])
    leaves = written(spark, leaves, "leaves")

    # Equal stretches repeat whole; one occurrence of every leaf beside others is cut.
    whole = leaves.where("held > 1").select("key", "leaf", F.lit(0).alias("place"), "n")
    beside = leaves.where("held < times")

    def cut(wanted, entire):
        wanted = wanted.groupBy(*row).agg(F.collect_list(F.struct("key", "leaf", "first", "n")).alias("wanted"))
        at = texts.join(wanted, row).select("doc_id", "text", "wanted")
        return at.mapInArrow(_cut(window, entire), "key long, leaf long, place int, words binary")

    stretched = cut(beside.where(F.col("times") <= tree), True).select("key", "leaf", "words")
    trees = stretched.repartition("key").sortWithinPartitions("key").mapInArrow(_trees(window), "key long, leaf long, place int")
    places = trees
    if not beside.where(F.col("times") > tree).isEmpty():
        spread = written(spark, cut(beside.where(F.col("times") > tree), False), "windows")
        deep = spread.groupBy("words").count().where("count > 1").select("words")
        places = places.unionByName(spread.join(deep, "words").select("key", "leaf", "place"))
    spans = whole.unionByName(places.select("key", "leaf", "place", F.lit(1).alias("n")))
    spans = spans.groupBy("key", "leaf").agg(F.collect_set(F.struct("place", "n")).alias("spans"))
    hit = repeated.select("key", "leaf", *row, "first").join(spans, ["key", "leaf"])
    moved = F.transform("spans", lambda s: F.struct((s.getField("place") + F.col("first")).alias("place"), s.getField("n").alias("n")))
    hit = hit.select(*row, moved.alias("spans")).groupBy(*row).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return texts.join(hit, row, "left").select("doc_id", "text", "spans").mapInArrow(
        _remove(window), f"doc_id {kind}, n_words long, n_removed long, kept_text string"
    )


def report(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``."""
    return remove_repeats(spark, docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT r, s, array_to_string(w[s:s + 34], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)
), rep AS (
  SELECT r, s FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)
), word AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d
), covered AS (
  SELECT word.r, i, x, coalesce(i - max(s) OVER (PARTITION BY word.r ORDER BY i ROWS UNBOUNDED PRECEDING) <= 34, false) AS gone
  FROM word LEFT JOIN rep ON word.r = rep.r AND i = s
), kept AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS t FROM covered GROUP BY r
)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_removed, 0)::bigint AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
