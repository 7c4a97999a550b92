"""Packing by lexical retrieval: a sharded BM25 index fills every window with neighbours.

1. Documents become token ids. A document's whole windows are sequences as they
   are; what is left of it, shorter than a window, is a passage to be packed.
2. Document frequencies of all token ids are counted over all passages; there are
   at most as many as the vocabulary has entries, whatever the corpus.
3. Passages are sorted by their heaviest terms, so that texts with the same rare
   terms lie side by side, and dealt in that order to shards of bounded size. Many
   copies of a text, or rows of one key, are cut by number like all others.
4. Every shard has an inverted index of BM25 impacts. The first unused passage
   seeds a window; the index returns its unused neighbours, best first, and those
   that fit whole fill the window. Where none fits, the best neighbour is cut to
   the room left and what remains of it seeds the next window.

So every sequence is full, but for the last one of a task: that is cut into
sequences whose lengths are powers of two, which need no padding either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written
from tapeworks.llm.tokens import RankEncoder

WINDOW = 1024
END = 0
VOCABULARY = "byte_bpe_50k"
# A shard ends with the passage that reaches one of these.
SHARD_PASSAGES = 1024
SHARD_IDS = 1 << 20
# BM25: saturation of repeats, weight of the length, and the heaviest terms of a seed that are looked up.
SATURATION = 1.2
LENGTH = 0.75
QUERY_TERMS = 64
# Terms by which passages are sorted.
SORT_TERMS = 3

PASSAGES = "doc_id {kind}, doc_tokens long, n_whole long, whole_crc32 array<long>, whole binary, passage binary"
PIECES = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _tokenised(name: str, window: int, end: int, keep: bool):
    """Rows ``PASSAGES``: ids are little-endian, 16 bits in ``passage``, 32 in ``whole`` and in checksums."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = RankEncoder(name)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end)).astype("<u4")
                whole = len(ids) // window * window
                crcs = [zlib.crc32(ids[at : at + window].tobytes()) for at in range(0, whole, window)]
                rows.append((len(ids), whole // window, crcs, ids[:whole].tobytes() if keep else b"", ids[whole:].astype("<u2").tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            names = ["doc_tokens", "n_whole", "whole_crc32", "whole", "passage"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return encode


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, n``: passages of the task that hold a term; -1 counts passages, -2 their ids."""
    counts, passages, ids = np.zeros(1 << 16, np.int64), 0, 0
    for batch in batches:
        for passage in batch.column(0):
            terms = np.frombuffer(passage.as_py(), "<u2")
            counts[np.unique(terms)] += 1
            passages, ids = passages + (len(terms) > 0), ids + len(terms)
    terms = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(terms, [-1, -2])), pa.array(np.append(counts[terms], [passages, ids]))], names=["term", "n"]
    )


class Weights:
    """BM25 impacts of terms, from the frequencies of the whole corpus."""

    def __init__(self, frequencies: dict[int, int]):
        self.passages, total = max(1, frequencies.get(-1, 0)), frequencies.get(-2, 0)
        self.mean = max(1.0, total / self.passages)
        held = np.zeros(1 << 16, np.float32)
        for term, n in frequencies.items():
            if term >= 0:
                held[term] = n
        self.idf = np.log1p((self.passages - held + 0.5) / (held + 0.5)).astype(np.float32)

    def impacts(self, terms: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of terms that occur ``times`` in passages of ``lengths``."""
        norm = SATURATION * (1 - LENGTH + LENGTH * lengths / self.mean)
        return self.idf[terms] * (times * (SATURATION + 1) / (times + norm)).astype(np.float32)


def _sort_terms(weights: Weights):
    """The passages with their heaviest terms, -1 where there are fewer."""

    def heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full((batch.num_rows, SORT_TERMS), -1, np.int32)
            for row, passage in enumerate(batch.column("passage")):
                terms, times = np.unique(np.frombuffer(passage.as_py(), "<u2"), return_counts=True)
                top = np.argsort(-weights.impacts(terms, times, times.sum()), kind="stable")[:SORT_TERMS]
                found[row, : len(top)] = terms[top]
            columns = [*batch.columns, *[pa.array(found[:, k]) for k in range(SORT_TERMS)]]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *[f"term_{k}" for k in range(SORT_TERMS)]])

    return heaviest


class Index:
    """Inverted index of one shard: for each term the passages that hold it and their impacts."""

    def __init__(self, passages: list[np.ndarray], weights: Weights):
        lengths = np.array([len(p) for p in passages], np.int64)
        owner = np.repeat(np.arange(len(passages), dtype=np.int64), lengths)
        # Passage and term in one number; sorted by term first.
        pairs, times = np.unique(np.concatenate(passages).astype(np.int64) * len(passages) + owner, return_counts=True)
        terms, self.holder = pairs // len(passages), pairs % len(passages)
        self.impact = weights.impacts(terms, times, lengths[self.holder])
        self.size = len(passages)
        self.begin = np.searchsorted(terms, np.arange((1 << 16) + 1))
        # Each passage's query: its terms that others hold too, heaviest first.
        wanted = np.flatnonzero(np.diff(self.begin)[terms] > 1)
        wanted = wanted[np.lexsort((terms[wanted], -self.impact[wanted], self.holder[wanted]))]
        self.query_terms = terms[wanted]
        self.query_begin = np.searchsorted(self.holder[wanted], np.arange(len(passages) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Of all passages, for the heaviest terms of ``seed``."""
        first, last = self.query_begin[seed], self.query_begin[seed + 1]
        terms = self.query_terms[first : min(last, first + QUERY_TERMS)]
        spans = [slice(self.begin[t], self.begin[t + 1]) for t in terms.tolist()]
        if not spans:
            return np.zeros(self.size)
        holders = np.concatenate([self.holder[s] for s in spans])
        return np.bincount(holders, np.concatenate([self.impact[s] for s in spans]), self.size)


def fill(passages: list[np.ndarray], weights: Weights, window: int = WINDOW) -> tuple[list, list]:
    """Full windows of one shard, as lists of ``(passage, from, to)``, and what is left, less than a window."""
    index = Index(passages, weights)
    lengths = np.array([len(p) for p in passages], np.int64)
    unused = np.ones(len(passages), bool)
    windows, rest, first, left = [], None, 0, int(lengths.sum())
    while left >= window:
        if rest is None:
            while not unused[first]:
                first += 1
            rest, unused[first] = (first, 0), False
        seed, at = rest
        rest, now, room = None, [(seed, at, int(lengths[seed]))], window - int(lengths[seed]) + at
        near = np.flatnonzero(unused)
        near = near[np.argsort(-index.scores(seed)[near], kind="stable")]
        sizes = lengths[near]
        taken = np.zeros(len(near), bool)
        at = 0
        while room:
            # The next neighbour that fits; those passed over were too long and stay so.
            fits = np.flatnonzero(sizes[at:] <= room)
            if not len(fits):
                break
            at += int(fits[0])
            now.append((int(near[at]), 0, int(sizes[at])))
            taken[at] = True
            room -= int(sizes[at])
            at += 1
        if room:
            cut = int(np.argmin(taken))
            rest = (int(near[cut]), room)
            now.append((int(near[cut]), 0, room))
            taken[cut] = True
        unused[near[taken]] = False
        windows.append(now)
        left -= window
    over = [] if rest is None else [(rest[0], rest[1], int(lengths[rest[0]]))]
    return windows, over + [(int(p), 0, int(lengths[p])) for p in np.flatnonzero(unused)]


def in_powers(spans: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """``spans`` (what, from, to) end to end, cut into sequences whose lengths are powers of two, longest first."""
    total = sum(to - at for _, at, to in spans)
    spans, found = spans[::-1], []
    for bit in reversed(range(total.bit_length())):
        room, now = total & (1 << bit), []
        while room:
            what, at, to = spans.pop()
            part = min(room, to - at)
            now.append((what, at, at + part))
            room -= part
            if at + part < to:
                spans.append((what, at + part, to))
        if now:
            found.append(now)
    return found


def _pack(weights: Weights, window: int, keep: bool, shard_passages: int):
    """Rows ``PIECES`` (and ``ids``) of the passages in sorted order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        kind, out = None, []

        def add(spans, held):
            """One sequence of ``(passage, from, to)``; ``held`` has each passage's row and place in its document."""
            nonlocal sequence
            offset = 0
            for what, at, to in spans:
                (doc_id, tokens, base), ids = held[what][0], held[what][1][at:to].astype("<u4").tobytes()
                out.append((doc_id, base + at, to - at, zlib.crc32(ids), tokens, sequence, offset, ids if keep else None))
                offset += to - at
            sequence += 1

        def flush(least: int):
            nonlocal out
            while len(out) > least:
                some, out = out[:10_000], out[10_000:]
                columns = [pa.array([row[0] for row in some], kind), *[pa.array([row[k] for row in some], pa.int64()) for k in range(1, 7)]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                if keep:
                    columns, names = [*columns, pa.array([row[7] for row in some], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        shard, size = [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            columns = [batch.column(n) for n in ("doc_id", "doc_tokens", "n_whole", "whole_crc32", "whole", "passage")]
            for cells in zip(*columns):
                doc_id, tokens, n_whole, crcs, whole, passage = (cell.as_py() for cell in cells)
                for n in range(n_whole):
                    ids = whole[4 * n * window : 4 * (n + 1) * window] if keep else None
                    out.append((doc_id, n * window, window, crcs[n], tokens, sequence, 0, ids))
                    sequence += 1
                passage = np.frombuffer(passage, "<u2")
                if len(passage):
                    shard.append(((doc_id, tokens, n_whole * window), passage))
                    size += len(passage)
                if len(shard) >= shard_passages or size >= SHARD_IDS:
                    windows, over = fill([p for _, p in shard], weights, window)
                    for spans in windows:
                        add(spans, shard)
                    # What is left of the shard joins the next one.
                    shard = [((*shard[w][0][:2], shard[w][0][2] + at), shard[w][1][at:to]) for w, at, to in over]
                    size = sum(len(p) for _, p in shard)
                yield from flush(10_000)
        if shard:
            windows, over = fill([p for _, p in shard], weights, window)
            for spans in [*windows, *in_powers(over)]:
                add(spans, shard)
        yield from flush(0)

    return pack


def pack(
    spark: SparkSession,
    docs: DataFrame,
    window: int = WINDOW,
    end: int = END,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    shard_passages: int = SHARD_PASSAGES,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece, and its ``ids``.

    Null texts count as empty and are the end id alone. Rows without id, of one
    id or of equal texts are packed once each; sequences are filled from
    offset 0 without gaps. An empty input gives an empty result. ``ids`` are
    little-endian 32-bit numbers. Ties of score and weight go to what comes
    first in sorted order, so sequences depend on how Spark deals out rows; the
    pieces of each document always cover it exactly once.
    """
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    passages = texts.mapInArrow(_tokenised(vocabulary, window, end, with_ids), PASSAGES.format(kind=kind))
    # Tells rows apart that are equal otherwise; fixed once the table is written.
    passages = written(spark, passages.withColumn("row", F.monotonically_increasing_id()), "passages")
    counts = passages.select("passage").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    weights = Weights({r["term"]: r["n"] for r in counts.collect()})

    terms = [f"term_{k}" for k in range(SORT_TERMS)]
    order = [*terms, F.xxhash64("row"), "row"]
    schema = f"{PASSAGES.format(kind=kind)}, row long, " + ", ".join(f"{t} int" for t in terms)
    placed = passages.mapInArrow(_sort_terms(weights), schema).repartitionByRange(*order).sortWithinPartitions(*order)
    result = PIECES.format(kind=kind) + ", ids binary" * with_ids
    return placed.drop(*terms, "row").mapInArrow(_pack(weights, window, with_ids, shard_passages), result)
