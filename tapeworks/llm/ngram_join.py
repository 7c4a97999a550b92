"""Similarity join on word n-grams: a blocked sparse matrix product.

Overlaps are the product of the document by n-gram incidence matrix with its
transpose. It is never formed as a whole; size-derived bounds say which blocks
of it can hold a pair that is similar enough:

1. Sizes fall into classes such that linked documents are in one class or two
   neighbouring ones. Two linked sets of a class differ in at most ``d`` n-grams.
   A class's n-grams are dealt by hash to more than ``d`` parts, so linked sets
   agree on some part entirely. Each set names its ``d + 1`` largest parts, which
   is enough for linked sets to name a common one. Documents that share a part
   with its whole content are candidates; a common passage alone seldom makes
   them so, as a part also holds other n-grams, unless it is more than about
   half of the texts.
2. Candidates, closed transitively, form clusters. Their texts come together
   in blocks of bounded size: a cluster, or a share of one with some pivots of
   the whole. Within a block overlaps are accumulated by products over slices
   of the n-grams, and pairs below the bound are discarded.
3. A divided cluster that is still in several components is taken relative to
   its centre, the n-grams that most of it has: a set becomes what it has beyond
   the centre and what it lacks of it. Differences of sets stay what they are.
   Sets near enough to the centre are linked without being compared. Others
   meet in blocks where they share a rare n-gram of these. Sets that share none
   are told apart by their numbers of rare and common ones; blocks of different
   components meet pairwise only for the sets of which these leave it open.

Equal sets are one row of the matrix: links go to their smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import components, maybe_among, whole_text, written
from tapeworks.llm.hashing import WORDS, mix, runs, task_words

SHINGLE = 4
PERCENT = 85
STEPS = 2  # links of the least similarity that lead from a class's smallest sets to its largest
SPARE = 10  # percent of parts beyond those that linked sets can differ in
BLOCK = 400  # documents
PIVOTS = 24
SLICE = 4096  # n-grams of one product
RARE = 64  # documents of a cluster that have a rare n-gram beyond, or lack it of, the centre
OFTEN = 8  # n-grams that more than one in so many sets of a cluster has are passed with its centre
MET = 20_000  # digests of sets that a task remembers


def shingle_set(text: str, length: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's n-grams, or of all its words if they are fewer."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(runs(WORDS.of(words), min(length, len(words))))


def digest(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    signed = lambda v: int(np.uint64(v).astype(np.int64))
    return signed(np.add.reduce(mix(grams + np.uint64(1)))), signed(np.add.reduce(mix(grams ^ np.uint64(0x5555555555555555))))


class Classes:
    """Size classes for links of at least ``percent`` Jaccard similarity."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.tops = np.array([0, 1], np.int64)

    def _grow(self) -> None:
        top = int(self.tops[-1])
        for _ in range(STEPS):
            top = max(top + 1, self.reach(top))
        self.tops = np.append(self.tops, top)

    def of(self, size: int) -> int:
        while self.tops[-1] < size:
            self._grow()
        return int(np.searchsorted(self.tops, size))

    def top(self, number: int) -> int:
        while number >= len(self.tops):
            self._grow()
        return int(self.tops[number])

    def reach(self, size: int) -> int:
        """The largest set that one of ``size`` n-grams may link to."""
        return size * 100 // self.percent

    def apart(self, size: int, other: int) -> int:
        """In how many n-grams linked sets of these sizes differ at most."""
        return (size + other) * (100 - self.percent) // (100 + self.percent)

    def parts(self, number: int) -> int:
        """Parts of a class: more than linked sets of it differ in."""
        top = self.top(number)
        apart = self.apart(top, top)
        return 1 + apart + (apart + 1) * SPARE // 100 if apart else 1


def signatures(grams: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts by which a set can meet the sets it may link to; which are of the next class.

    Of a class's parts a set emits the largest, one more than it may differ in
    from a set of the class; equal sizes go by key. This order depends on the
    content of parts alone. So if linked sets agree on all but ``d`` parts, the
    first one on which they agree is among the first ``d + 1`` of both.
    """
    keys = []
    own, reach = classes.of(len(grams)), classes.reach(len(grams))
    for number in (own, own + 1):
        largest = min(reach, classes.top(number))
        if number > own and reach <= classes.top(own):
            break
        count = classes.parts(number)
        mixed = mix(grams ^ np.uint64(77))
        part = ((mixed >> np.uint64(33)) % np.uint64(count)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sizes = np.bincount(part, minlength=count)
        totals = np.zeros(count, np.uint64)
        held = np.flatnonzero(sizes)
        totals[held] = np.add.reduceat(mix(mixed + grams)[order], (np.cumsum(sizes) - sizes)[held])
        place = np.arange(count, dtype=np.uint64) + np.uint64(number << 32)
        key = mix(totals + mix(place * np.uint64(0x9E3779B97F4A7C15)))
        needed = classes.apart(len(grams), largest) + 1
        keys.append(key[np.lexsort((key, -sizes))[:needed]])
    return np.concatenate(keys).view(np.int64), np.repeat([False, True][: len(keys)], [len(k) for k in keys])


def _sets(length: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_words():
            for batch in batches:
                sets = [shingle_set(text, length) for text in batch.column(1).to_pylist()]
                names = [digest(s) for s in sets]
                columns = [[len(s) for s in sets], [a for a, _ in names], [b for _, b in names]]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "n_shingles", "s1", "s2"])

    return describe


def _keys(length: int, percent: int):
    def together(rows):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["key", "above", "doc_id"])

    def keys_of(batch: pa.RecordBatch, classes: Classes, met: set) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grams = shingle_set(text, length)
            name = digest(grams)
            # Equal sets that a task meets are one row of the matrix already here.
            if doc_id is None or not len(grams) or name in met:
                continue
            if len(met) >= MET:
                met.clear()
            met.add(name)
            keys, above = signatures(grams, classes)
            rows.append((keys, above, np.full(len(keys), doc_id, np.int64)))
            size += len(keys)
            if size > 1 << 18:
                yield together(rows)
                rows, size = [], 0
        if rows:
            yield together(rows)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, met = Classes(percent), set()
        with task_words():
            for batch in batches:
                yield from keys_of(batch, classes, met)

    return emit


def overlaps(sets: list[np.ndarray], width: int = SLICE) -> np.ndarray:
    """Shared n-grams of every pair, by products over slices of the n-grams that two sets hold."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    rows, column = rows[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int((times > 1).sum()), width):
        begin, end = np.searchsorted(column, [first, first + width])
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[rows[begin:end], column[begin:end] - first] = 1
        total += matrix @ matrix.T
    return total.astype(np.int64)


def linked_groups(sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """For each set the position of the first set it is linked to, directly or over others."""
    sizes = np.array([len(s) for s in sets], np.int64)
    both = overlaps(sets)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    root = np.full(len(sets), -1)
    for i in range(len(sets)):
        reach = [i] if root[i] < 0 else []
        while reach:
            member = reach.pop()
            root[member] = i
            new = np.flatnonzero(linked[member] & (root < 0))
            root[new] = i
            reach.extend(new.tolist())
    return root.tolist()


def _verify(length: int, percent: int):
    """Edges (document, first linked document) of each block of rows with one ``block``."""

    def flush(ids, texts):
        root = linked_groups([shingle_set(t, length) for t in texts], percent)
        pairs = [(ids[i], ids[r]) for i, r in enumerate(root) if r != i]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, texts = None, [], []
        with task_words():
            for batch in batches:
                for block, doc_id, text in zip(*(column.to_pylist() for column in batch.columns)):
                    if block != now:
                        if len(ids) > 1:
                            yield flush(ids, texts)
                        now, ids, texts = block, [], []
                    ids.append(doc_id)
                    texts.append(text)
            if len(ids) > 1:
                yield flush(ids, texts)

    return verify


def _edges(spark: SparkSession, docs: DataFrame, placed: DataFrame, length: int, percent: int) -> DataFrame:
    """Links found in the blocks that ``placed`` (``block, doc_id``) puts documents in."""
    docs = docs.where(maybe_among(spark, placed.select("doc_id"), F.col("doc_id")))
    texts = placed.join(docs, "doc_id").select("block", "doc_id", "text").repartition("block").sortWithinPartitions("block", "doc_id")
    return texts.mapInArrow(_verify(length, percent), "a long, b long")


def join(
    spark: SparkSession,
    docs: DataFrame,
    length: int = SHINGLE,
    percent: int = PERCENT,
    block: int = BLOCK,
    pivots: int = PIVOTS,
    rare: int = RARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Documents link when 100 * shared >= percent * union of their n-gram sets.
    Null texts count as empty; texts without words have no n-grams and link to
    nothing. Rows that repeat an id are one document and lie in one component;
    rows without an id link to nothing and have no component.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))
    name = ["s1", "s2", "n_shingles"]
    sets = written(spark, texts.mapInArrow(_sets(length), "doc_id long, n_shingles long, s1 long, s2 long"), "sets")
    known = sets.where("doc_id is not null and n_shingles > 0")
    firsts = known.groupBy(*name).agg(F.min("doc_id").alias("first"))
    same = known.join(firsts, name).select("doc_id", "first").where("doc_id <> first").distinct()
    same = written(spark, same, "same-sets")

    keys = texts.mapInArrow(_keys(length, percent), "key long, above boolean, doc_id long")
    # Sets in a class from below only look for sets of the class itself.
    order = Window.partitionBy("key").orderBy("above", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    meet = keys.withColumn("other", F.first(F.when(~F.col("above"), F.col("doc_id"))).over(order))
    meet = meet.where("doc_id <> other").select("doc_id", "other").distinct()
    for side in ("doc_id", "other"):
        to_first = same.select(F.col("doc_id").alias(side), F.col("first").alias("to"))
        meet = meet.join(to_first, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    meet = meet.where("doc_id <> other").select(F.col("doc_id").alias("a"), F.col("other").alias("b"))
    clusters = written(spark, components(spark, meet).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "clusters")

    counts = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    shares = F.expr(f"cast(ceil(size / {block}) as int)")
    members = clusters.join(counts, "cluster").withColumn("shares", shares)
    members = members.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.col("shares")))
    nth = F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    chosen = members.where("shares > 1").withColumn("nth", nth).where(F.col("nth") <= pivots)
    chosen = chosen.select("cluster", "doc_id", F.explode(F.expr("sequence(0L, shares - 1L)")).alias("share"))
    placed = members.select("cluster", "doc_id", "share").unionByName(chosen).distinct()
    placed = written(spark, placed.select(F.concat_ws(":", "cluster", "share").alias("block"), "doc_id"), "blocks")
    edges = written(spark, _edges(spark, texts, placed, length, percent), "links")
    edges = edges.unionByName(same.select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
    found = written(spark, components(spark, edges), "components")

    # Divided clusters in several components.
    divided = members.where("shares > 1").select("cluster", "doc_id")
    divided = divided.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    divided = divided.withColumn("component", F.coalesce("component", "doc_id"))
    several = divided.groupBy("cluster").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    divided = written(spark, divided.join(several.where("low <> high").select("cluster"), "cluster"), "divided")
    if not divided.isEmpty():
        beyond = _beyond(spark, texts, divided, length, percent, rare)
        best = beyond.groupBy("cluster").agg(F.min(F.struct("excess", "doc_id", "component")).alias("best"))
        beyond = beyond.join(best, "cluster").withColumn("sure", F.expr("excess + best.excess <= 0"))
        sure = beyond.where("sure and doc_id <> best.doc_id").select(F.col("doc_id").alias("a"), F.col("best.doc_id").alias("b"))
        # From here on a component may stand for a part of one.
        beyond = beyond.withColumn("component", F.expr("if(sure, best.component, component)"))
        beyond = written(spark, beyond.select("cluster", "doc_id", "component", "mark", "n_shingles", "often", "beyond"), "beyond")
        placed, left = _by_rare(beyond, percent, rare)
        placed = written(spark, placed, "blocks")
        edges = edges.unionByName(sure).unionByName(_edges(spark, texts, placed, length, percent))
        left = written(spark, left, "open")
        if not left.isEmpty():
            placed = written(spark, _pairwise(left, block, percent), "blocks")
            edges = edges.unionByName(_edges(spark, texts, placed, length, percent))
        found = components(spark, written(spark, edges, "links"))
    answer = sets.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return answer.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _beyond(spark: SparkSession, docs: DataFrame, divided: DataFrame, length: int, percent: int, rare: int) -> DataFrame:
    """Rows of ``divided`` with ``mark, n_shingles, often, beyond, excess``, once for each set of a document.

    A set differs from the centre of its cluster, the n-grams that more than
    half of it has, in those in ``beyond`` and in ``often`` others. Two sets are
    linked when twice the number of these that both have, times 100 + percent,
    is at least the sum of their ``excess``. ``often`` counts the n-grams in
    which more than ``rare`` sets differ and which are the centre's or had by
    more than one set in OFTEN. However large a cluster is, these are at most
    OFTEN times as many as a set of it has on average; they are passed with the
    centre and counted in the row.
    """
    docs = docs.where(maybe_among(spark, divided.select("doc_id"), F.col("doc_id")))
    texts = written(spark, docs.join(divided, "doc_id").select("cluster", "doc_id", "component", "text"), "divided-texts")

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def together(rows):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["cluster", "gram"])

        with task_words():
            for batch in batches:
                rows, size = [], 0
                for cluster, text in zip(*(column.to_pylist() for column in batch.columns)):
                    grams = shingle_set(text, length).view(np.int64)
                    rows.append((np.full(len(grams), cluster, np.int64), grams))
                    size += len(grams)
                    if size > 1 << 18:
                        yield together(rows)
                        rows, size = [], 0
                if rows:
                    yield together(rows)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_words():
            for batch in batches:
                sets = [shingle_set(text, length) for text in batch.column(3).to_pylist()]
                centres = [c.values.to_numpy() if c.is_valid else np.zeros(0, np.int64) for c in batch.column(4)]
                apart = [np.setxor1d(s.view(np.int64), c) for s, c in zip(sets, centres)]
                excess = [(100 + percent) * len(d) - (100 - percent) * len(s) for s, d in zip(sets, apart)]
                common = [c.values.to_numpy() if c.is_valid else np.zeros(0, np.int64) for c in batch.column(5)]
                rest = [np.setdiff1d(d, c, assume_unique=True) for d, c in zip(apart, common)]
                often = [len(d) - len(r) for d, r in zip(apart, rest)]
                columns = [[digest(s)[0] for s in sets], [len(s) for s in sets], excess, often]
                places = pa.array(np.cumsum([0, *map(len, rest)]), pa.int32())
                beyond = pa.ListArray.from_arrays(places, pa.array(np.concatenate([np.zeros(0, np.int64), *rest])))
                names = ["cluster", "doc_id", "component", "mark", "n_shingles", "excess", "often", "beyond"]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, pa.int64()) for c in columns], beyond], names=names)

    counts = texts.groupBy("cluster").agg(F.count("*").alias("size"))
    held = texts.select("cluster", "text").mapInArrow(grams_of, "cluster long, gram long").groupBy("cluster", "gram").agg(F.count("*").alias("n"))
    lists = {"centre": "2 * n > size", "common": f"least(n, size - n) > {rare}"}
    lists = [F.collect_list(F.when(F.expr(which), F.col("gram"))).alias(name) for name, which in lists.items()]
    centre = held.join(counts, "cluster").where(f"{OFTEN} * n > size").groupBy("cluster").agg(*lists)
    rows = texts.join(centre, "cluster", "left").select("cluster", "doc_id", "component", "text", "centre", "common")
    shape = "cluster long, doc_id long, component long, mark long, n_shingles long, excess long, often long, beyond array<long>"
    found = rows.mapInArrow(differ, shape).where("n_shingles > 0").dropDuplicates(["doc_id", "mark"])
    return written(spark, found, "beyond")


def _by_rare(beyond: DataFrame, percent: int, rare: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the documents of several components with a rare n-gram in ``beyond``; which documents may have links besides.

    Sets that share no rare one differ in all their rare ones and in at least
    as many common ones as they have more or fewer. Those in ``often`` are common.
    """
    row = ["cluster", "doc_id", "component", "mark"]
    single = beyond.select(*row, F.explode("beyond").alias("gram"))
    times = single.groupBy("cluster", "gram").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    few = times.where((F.col("n") <= rare) & (F.col("low") != F.col("high"))).select("cluster", "gram")
    groups = single.join(few, ["cluster", "gram"]).groupBy("cluster", "gram").agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
    placed = groups.select("ids").distinct().select(F.sha2(F.array_join("ids", ","), 256).alias("block"), F.explode("ids").alias("doc_id"))

    many = times.where(F.col("n") > rare).select("cluster", "gram")
    common = single.join(many, ["cluster", "gram"], "left_semi").groupBy("doc_id", "mark").agg(F.count("*").alias("common"))
    rows = beyond.withColumn("size", F.size("beyond")).drop("beyond").join(common, ["doc_id", "mark"], "left")
    rows = rows.withColumn("common", F.coalesce("common", F.lit(0)))
    rows = rows.withColumn("over", F.expr(f"{100 + percent} * (size - common) - {100 - percent} * n_shingles"))
    rows = rows.withColumn("common", F.col("common") + F.col("often"))
    # The least by number of common ones, and the least of another component.
    least = rows.groupBy("cluster", "common", "component").agg(F.min("over").alias("over"))
    nth = F.row_number().over(Window.partitionBy("cluster", "common").orderBy("over", "component"))
    least = least.withColumn("nth", nth).where("nth <= 2")
    least = least.groupBy("cluster").agg(F.collect_list(F.struct("common", "component", "over")).alias("least"))
    may = f"exists(least, l -> l.component <> component and l.over + over + {100 + percent} * abs(l.common - common) <= 0)"
    left = rows.join(least, "cluster").where(may).select("cluster", "doc_id", "component", "n_shingles").distinct()
    return placed, left


def _pairwise(divided: DataFrame, block: int, percent: int) -> DataFrame:
    """``block, doc_id`` for pairs of half blocks that may hold a link between components.

    A half block is a share of one large component, or of the small ones
    together, of one band of sizes; bands are so wide that links stay in a
    band or go to the next.
    """
    half = block // 2
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100.0 / percent) + 1e-9)).cast("int")
    rows = divided.withColumn("band", band)
    large = rows.groupBy("cluster", "band", "component").agg(F.count("*").alias("n"))
    large = large.withColumn("part", F.when(F.col("n") >= half, F.col("component")).otherwise(-1))
    rows = rows.join(large.drop("n"), ["cluster", "band", "component"])
    kind = ["cluster", "band", "part"]
    shares = rows.groupBy(*kind).agg(F.expr(f"cast(ceil(count(*) / {half}) as int)").alias("shares"))
    rows = rows.join(shares, kind).withColumn("share", F.pmod(F.xxhash64("doc_id"), F.col("shares")))
    rows = rows.withColumn("unit", F.concat_ws(":", "band", "part", "share"))
    units = rows.select("cluster", "band", "part", "unit").distinct()
    left = units.select("cluster", "band", *[F.col(c).alias(f"l_{c}") for c in ("part", "unit")])
    right = units.select("cluster", F.explode(F.array("band", F.col("band") - 1)).alias("band"), F.col("band").alias("r_band"), *[F.col(c).alias(f"r_{c}") for c in ("part", "unit")])
    pairs = left.join(right, ["cluster", "band"]).where("(r_band > band or l_unit <= r_unit) and (l_part <> r_part or l_part = -1)")
    pairs = pairs.select("cluster", F.concat_ws("|", "cluster", "l_unit", "r_unit").alias("block"), F.explode(F.array_distinct(F.array("l_unit", "r_unit"))).alias("unit"))
    return pairs.join(rows.select("cluster", "unit", "doc_id"), ["cluster", "unit"]).select("block", "doc_id")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM w
), gram AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM s
  UNION
  SELECT reach.doc_id, edge.y FROM reach JOIN edge ON reach.other = edge.x
)
SELECT doc_id, any_value(len(g))::bigint AS n_shingles, min(other) AS component_id FROM reach JOIN s USING (doc_id) GROUP BY doc_id
"""
