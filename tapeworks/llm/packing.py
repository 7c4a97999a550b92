"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most ``limit`` tokens. Only the number of pieces
of each length (at most ``limit`` numbers) reaches the driver, where best-fit
decreasing runs over counts: equal lengths meet equal gaps many at a time. The
plan says, for each length, which ranks go to which sequences at which offset.
Pieces are ranked within their length (first within a salt of it, then by the
salts' counts, so that no length is ordered in one task) and take their slot
by joining on length and rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written
from tapeworks.llm.tokens import VOCABULARY, Encoder, encoder

LIMIT = 4096
END = 1
SALTS = 64
RANKS_PER_BLOCK = 4096


def _pieces(vocabulary: str, limit: int, end: int):
    last = int(end).to_bytes(4, "little")

    def pieces_of(batch: pa.RecordBatch, encode: Encoder) -> pa.RecordBatch:
        ids, piece, start, length, crc = [], [], [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            coded = memoryview(encode.ids(text) + last)
            for n, at in enumerate(range(0, len(coded), 4 * limit)):
                part = coded[at : at + 4 * limit]
                ids.append(doc_id)
                piece.append(n)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field(0).type), pa.array(piece, pa.int32())]
            + [pa.array(c, pa.int64()) for c in (start, length, crc)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(vocabulary) as encode:
            for batch in batches:
                yield pieces_of(batch, encode)

    return cut


def pieces(docs: DataFrame, limit: int = LIMIT, end: int = END, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: documents cut where longer than ``limit`` tokens.

    Null and empty texts are one piece, the end id alone; rows that repeat a
    document, or have no id, are cut once each.
    """
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(
        _pieces(vocabulary, limit, end),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
    )


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int]]:
    """``length, first rank, count, first sequence, offset``: runs of equal slots.

    Best-fit decreasing over counts. ``gaps`` holds, for each free length, runs
    of sequences with just that much room; the longest lengths go first, each
    into the smallest gap it fits, as many at once as the run has sequences.
    The i-th rank of a run goes to its i-th sequence, all at the same offset.
    """
    slots, gaps, free, opened = [], {}, [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                room = free[at]
                first, count = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room]
                    free.pop(at)
            else:
                room, first, count = limit, opened, max(1, left // (limit // length))
                opened += count
            # As many sequences as this length fills up, or one for what is left.
            used = min(count, max(1, left // (room // length)))
            slots.append((length, rank, used, first, limit - room))
            rank, left = rank + used, left - used
            for rest, begin, n in ((room - length, first, used), (room, first + used, count - used)):
                if n and rest:
                    if rest not in gaps:
                        bisect.insort(free, rest)
                        gaps[rest] = []
                    gaps[rest].append((begin, n))
    return slots


def pack(spark: SparkSession, cut: DataFrame, limit: int = LIMIT, salts: int = SALTS) -> DataFrame:
    """``cut`` (of ``pieces``) with ``sequence_id`` and ``offset``.

    Sequences are filled from offset 0 without gaps. Rows that repeat a document
    are packed once each. An empty input gives an empty result.
    """
    cut = written(spark, cut, "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = spark.createDataFrame(plan(histogram, limit), "length long, first_rank long, n long, first_sequence long, offset long")
    # Runs cut at multiples of a block of ranks: a piece's length and block find its few runs.
    block = F.explode(F.sequence(F.expr(f"first_rank div {RANKS_PER_BLOCK}"), F.expr(f"(first_rank + n - 1) div {RANKS_PER_BLOCK}")))
    slots = slots.withColumn("block", block)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("nth", nth).join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("nth"))
    ranked = ranked.withColumn("block", F.expr(f"rank div {RANKS_PER_BLOCK}"))
    placed = ranked.join(slots, ["length", "block"]).where("rank >= first_rank and rank < first_rank + n")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.expr("first_sequence + rank - first_rank").alias("sequence_id"),
        "offset",
    )
