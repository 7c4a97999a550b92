"""Token ids in files of directly addressable codes.

A file is a Parquet table of segments, each some million ids of whole documents
in ascending order. The ids are split into levels of 8-bit chunks: level 0 has
the lowest chunk of every id, level k the next chunk of those ids that need it.
A level's continuation bitmap marks the ids that go on, and its rank directory
counts the marks before every block of 512 bits, so the id at any place is
found by one look per level, without decoding anything before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text
from tapeworks.llm.tokens import VOCABULARY, encoder
from tapeworks.session import shared_dir

END = 2
SEGMENT_IDS = 1 << 20
RANK_BITS = 512
LOOKS = 1 << 14  # places looked up at once
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
FILE = "part int, segment int, n_ids long, doc_ids array<bigint>, starts binary, levels array<binary>, bitmaps array<binary>, ranks array<binary>"


def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, continuation bitmaps and rank directories of 32-bit ids."""
    levels, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        levels.append((rest & 255).astype(np.uint8).tobytes())
        more = rest > 255
        if not more.any():
            return levels, bitmaps, ranks
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(_ONES[bits].astype(np.uint32), np.arange(0, len(bits), RANK_BITS // 8), dtype=np.uint32)
        bitmaps.append(bits.tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4").tobytes())
        rest = rest[more] >> 8


def at(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], place: int) -> int:
    """The id at ``place``: one byte, bit and rank per level."""
    value, shift = 0, 0
    for k, level in enumerate(levels):
        value |= level[place] << shift
        if k == len(bitmaps) or not bitmaps[k][place >> 3] >> (place & 7) & 1:
            break
        block = place // RANK_BITS
        rank = int.from_bytes(ranks[k][4 * block : 4 * block + 4], "little")
        piece = np.frombuffer(bitmaps[k], np.uint8)[block * (RANK_BITS // 8) : place >> 3]
        rank += int(_ONES[piece].sum()) + bin(bitmaps[k][place >> 3] & ((1 << (place & 7)) - 1)).count("1")
        place, shift = rank, shift + 8
    return value


def decode(levels: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment, from its last level up."""
    above = np.zeros(0, np.uint32)
    for k in reversed(range(len(levels))):
        ids = np.frombuffer(levels[k], np.uint8).astype(np.uint32)
        if k < len(bitmaps):
            more = np.unpackbits(np.frombuffer(bitmaps[k], np.uint8), count=len(ids), bitorder="little").astype(bool)
            ids[more] |= above << 8
        above = ids
    return above


def at_places(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], places: np.ndarray) -> np.ndarray:
    """The ids at all ``places``: ``at`` in slices, so that memory doesn't follow their number."""
    ids = np.zeros(len(places), np.uint32)
    in_block = np.arange(RANK_BITS // 8)
    for begin in range(0, len(places), LOOKS):
        place = np.asarray(places[begin : begin + LOOKS], np.int64)
        left = begin + np.arange(len(place))
        for k, level in enumerate(levels):
            ids[left] |= np.frombuffer(level, np.uint8)[place].astype(np.uint32) << (8 * k)
            if k == len(bitmaps):
                break
            bits = np.frombuffer(bitmaps[k], np.uint8)
            goes_on = (bits[place >> 3] >> (place & 7) & 1).astype(bool)
            left, place = left[goes_on], place[goes_on]
            byte, block = place >> 3, place // RANK_BITS
            members = block[:, None] * len(in_block) + in_block
            before = np.where(members < byte[:, None], _ONES[bits[np.minimum(members, len(bits) - 1)]], 0).sum(1, dtype=np.int64)
            below = _ONES[bits[byte] & ((1 << (place & 7)) - 1)]
            place = np.frombuffer(ranks[k], "<u4")[block].astype(np.int64) + before + below
    return ids


def _segments(vocabulary: str, end: int, target: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = int(end).to_bytes(4, "little")
        docs, starts, parts, size, number, part = [], [], [], 0, 0, 0

        def segment():
            ids = np.frombuffer(b"".join(parts), "<u4")
            levels, bitmaps, ranks = encode(ids)
            row = {
                "part": part, "segment": number, "n_ids": len(ids), "doc_ids": docs,
                "starts": np.array(starts, "<u8").tobytes(), "levels": levels, "bitmaps": bitmaps, "ranks": ranks,
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), *[pa.list_(pa.binary())] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

        with encoder(vocabulary) as coder:
            for batch in batches:
                for doc_id, text, part in zip(*(column.to_pylist() for column in batch.columns)):
                    coded = coder.ids(text) + last
                    docs.append(doc_id)
                    starts.append(size)
                    parts.append(coded)
                    size += len(coded) // 4
                    if size >= target:
                        yield segment()
                        docs, starts, parts, size, number = [], [], [], 0, number + 1
        if docs:
            yield segment()

    return build


def write(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    end: int = END,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of ``docs`` in ascending id to the table ``path``.

    Null ids come first, rows that share an id in the order of their texts; a
    document longer than a segment makes a segment of its own. An empty input
    writes an empty table.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_segments(vocabulary, end, segment_ids), FILE).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, segment, docs, starts, levels, bitmaps in zip(*(column.to_pylist() for column in batch.columns)):
            ids = decode(levels, bitmaps).astype("<u4")
            begin = np.frombuffer(starts, "<u8").astype(np.int64)
            stop = np.append(begin[1:], len(ids))
            columns = {
                "part": pa.array([part] * len(docs), pa.int32()),
                "segment": pa.array([segment] * len(docs), pa.int32()),
                "doc_id": pa.array(docs, pa.int64()),
                "begin": pa.array(begin),
                "n_tokens": pa.array(stop - begin),
                "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin, stop)], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files.

    ``start`` counts the ids of all documents before. Only segment sizes are
    added up: within a part over its segments, then over the parts.
    """
    files = spark.read.parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("part_base"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("part", "segment", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("base"))
    places = places.join(parts, "part").select("part", "segment", (F.col("base") + F.col("part_base")).alias("base"))
    found = files.select("part", "segment", "doc_ids", "starts", "levels", "bitmaps").mapInArrow(
        _documents, "part int, segment int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    start = (F.col("base") + F.col("begin")).alias("start")
    return found.join(places, ["part", "segment"]).select("doc_id", start, "n_tokens", "ids_crc32")


def _directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, segment, n_ids, docs, starts in zip(*(column.to_pylist() for column in batch.columns)):
            begin = np.frombuffer(starts, "<u8").astype(np.int64)
            columns = {
                "part": pa.array([part] * len(docs), pa.int32()),
                "segment": pa.array([segment] * len(docs), pa.int32()),
                "doc_id": pa.array(docs, pa.int64()),
                "begin": pa.array(begin),
                "n_tokens": pa.array(np.append(begin[1:], n_ids) - begin),
            }
            yield pa.RecordBatch.from_pydict(columns)


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for levels, bitmaps, ranks, wanted in zip(*(column.to_pylist() for column in batch.columns)):
            ids = at_places(levels, bitmaps, ranks, np.array([w["place"] for w in wanted], np.int64))
            columns = {
                "doc_id": pa.array([w["doc_id"] for w in wanted], pa.int64()),
                "position": pa.array([w["position"] for w in wanted], pa.int64()),
                "token_id": pa.array(ids.astype(np.int64)),
            }
            yield pa.RecordBatch.from_pydict(columns)


def lookup(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """``doc_id, position, token_id``: the ids at single places of the files' documents.

    ``requests`` has ``doc_id, position``, counted from 0 in the document with
    its end id; other columns are ignored. Repeated requests are answered once.
    Null ids or positions, unknown ids and places outside a document have no
    row; where documents share an id, each that has the place gives one.

    Document starts tell the segment and place. Requests of a segment meet it
    at most ``SEGMENT_IDS`` at a time, however many ask for one document, and
    segments that nobody asks for are dropped before their codes are moved.
    """
    files = spark.read.parquet(path)
    directory = files.select("part", "segment", "n_ids", "doc_ids", "starts").mapInArrow(
        _directory, "part int, segment int, doc_id long, begin long, n_tokens long"
    )
    asked = requests.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("position").cast("bigint").alias("position")).distinct()
    met = asked.join(directory, "doc_id").where("position >= 0 and position < n_tokens")
    place = F.col("begin") + F.col("position")
    group = F.call_function("div", place, F.lit(SEGMENT_IDS)).alias("slice")
    wanted = met.groupBy("part", "segment", group).agg(F.collect_list(F.struct("doc_id", "position", place.alias("place"))).alias("wanted"))
    found = files.select("part", "segment", "levels", "bitmaps", "ranks").join(wanted, ["part", "segment"])
    return found.select("levels", "bitmaps", "ranks", "wanted").mapInArrow(_looked_up, "doc_id long, position long, token_id long")


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """What ``read`` finds in files just written to the shared folder."""
    path = f"{shared_dir(spark)}/tapeworks-codes-{uuid.uuid4().hex}"
    write(spark, docs, path, **options)
    return read(spark, path)
