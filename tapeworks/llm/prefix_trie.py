"""Trie of conversation prefixes, its nodes in tables addressed by minimal perfect hashes.

1. Turns are numbered. A conversation's rows may lie in several partitions of one
   sorted order; each partition knows how many rows of it came before.
2. The digest of a prefix combines those of its turns with their depths, so it
   is a running exclusive-or, carried from block to block of a conversation.
   Distinct digests, counted, are the nodes; the smallest member of a node stands for it.
3. Conversations are dealt to shards, in blocks of bounded length. A shard
   enumerates its distinct digests and gives each a slot by a minimal perfect hash,
   verified against the digest in the slot. What nodes weigh is scattered into flat
   arrays by slot and accumulated through the array of parent slots, deepest first.
4. A node's weight is entered once, on the path of the conversation that stands for
   it. All members of an ancestor have that conversation's path among them, so the
   sums of the shards add up to those of the whole trie, however rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import written
from tapeworks.llm.hashing import mix

# Depths of one block of a conversation, rows of one shard's table, ids that are joined at once.
BLOCK = 4096
SHARD_ROWS = 1 << 17
IDS = 1 << 12

NODE = ["depth", "x", "y"]


class Slots:
    """Minimal perfect hash of distinct keys, the rows of ``keys`` (64-bit columns).

    Level by level, keys that alone hash to a place get the next free slot; the
    others go on to the next level. ``find`` verifies each answer by the key.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, self.keys = [], np.empty_like(keys)
        left, given, seed = keys, 0, 0
        while len(left):
            size = max(16, 2 * len(left))
            place = self._place(left, seed, size)
            alone = np.bincount(place, minlength=size) == 1
            slot = np.where(alone, given + np.cumsum(alone) - 1, -1)
            self.levels.append((seed, size, slot))
            found = slot[place]
            self.keys[found[found >= 0]] = left[found >= 0]
            left, given, seed = left[found < 0], given + int(alone.sum()), seed + 1

    @staticmethod
    def _place(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
        value = np.full(len(keys), seed + 1, np.uint64)
        for column in keys.T:
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + column.view(np.uint64))
        return (value % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each row of ``keys``, -1 for those that have none."""
        answer, open_ = np.full(len(keys), -1), np.arange(len(keys))
        for seed, size, slot in self.levels:
            found = slot[self._place(keys[open_], seed, size)]
            answer[open_[found >= 0]] = found[found >= 0]
            open_ = open_[found < 0]
        known = answer >= 0
        known[known] = (self.keys[answer[known]] == keys[known]).all(axis=1)
        return np.where(known, answer, -1)


def accumulated(nodes: np.ndarray, parents: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes ``depth, x, y`` with the sums of ``weights`` over their subtrees.

    Rows of ``nodes`` and ``parents`` are ``depth, x, y``; parents that are in
    no row of ``nodes`` get nothing, but for the root, at depth 0.
    """
    roots = parents[parents[:, 0] == 0][:1]
    table = Slots(np.unique(np.concatenate([nodes, roots]), axis=0))
    slot = table.find(nodes)
    totals = np.zeros((len(table.keys), weights.shape[1]), np.int64)
    np.add.at(totals, slot, weights)
    parent = np.full(len(table.keys), -1)
    parent[slot] = table.find(parents)
    depth = table.keys[:, 0]
    by_depth = np.argsort(-depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(totals, parent[level], totals[level])
    return table.keys, totals


def _accumulate(block: int, shard_rows: int):
    """Sums of a shard's nodes; its rows come by conversation, block and depth."""

    def flush(rows):
        above = rows[:, 2] - 1
        # What a block hands on is carried apart from the tables, so that its first nodes have no parent.
        above[(above > 0) & (above % block == 0)] = -1
        parents = np.column_stack([above, rows[:, 5], rows[:, 6]])
        keys, totals = accumulated(rows[:, 2:5], parents, rows[:, 7:9])
        columns = [pa.array(np.ascontiguousarray(c)) for c in (*keys.T, *totals.T)]
        return pa.RecordBatch.from_arrays(columns, names=[*NODE, "saved", "leaves"])

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.column_stack([column.to_numpy(zero_copy_only=False) for column in batch.columns]))
            size += batch.num_rows
            if size >= shard_rows:
                rows = np.concatenate(held)
                # The last block may go on in the next batch.
                begins = np.flatnonzero((np.diff(rows[:, :2], axis=0) != 0).any(axis=1)) + 1
                last = int(begins[-1]) if len(begins) else 0
                if last:
                    yield flush(rows[:last])
                held, size = [rows[last:]], len(rows) - last
        if size:
            yield flush(np.concatenate(held))

    return accumulate


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``depth, x, y, first, ids``: sorted conversation ids of a node, joined by commas, in bounded pieces."""
    for batch in batches:
        out = []
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        change = np.zeros(batch.num_rows, bool)
        for column in columns[:3]:
            change[1:] |= column[1:] != column[:-1]
        change[:: IDS] = True
        begins = np.flatnonzero(change).tolist()
        for begin, end in zip(begins, [*begins[1:], batch.num_rows]):
            out.append((*(int(c[begin]) for c in columns), ",".join(map(str, columns[3][begin:end].tolist()))))
        kinds = [*[pa.int64()] * 4, pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=[*NODE, "first", "ids"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``depth, x, y, ends_sha256`` of pieces that come by node and first id."""

    def flush(done):
        columns = [pa.array([d[0][k] for d in done], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([d[1].hexdigest() for d in done])], names=[*NODE, "ends_sha256"])

    now, digest, done = None, None, []
    for batch in batches:
        for *node, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
            if node == now:
                digest.update(b",")
            else:
                if now is not None:
                    done.append((now, digest))
                now, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield flush(done)
            done = []
    if now is not None:
        yield flush([(now, digest)])


def numbered(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``conv_id, part, place, mark, chars`` and segments ``conv_id, part, lowest, before, n``.

    A turn's position, from 0, is ``place - lowest + before``. Conversations are
    ordered by turn, null first, then by ``mark``, a SHA-256 of role and text; null
    ones are empty. Rows without ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    narrow = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", mark.alias("mark"), F.char_length(text).cast("bigint").alias("chars")
    )
    order = ["conv_id", "turn", "mark"]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"), "mark", "chars")
    rows = written(spark, ordered, "turns")
    segments = rows.groupBy("conv_id", "part").agg(F.min("place").alias("lowest"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return rows, written(spark, segments, "segments")


def plain(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, mark, chars`` of the turns as they are, and the conversations."""
    rows, segments = numbered(spark, turns)
    depth = (F.col("place") - F.col("lowest") + F.col("before") + 1).alias("depth")
    return rows.join(segments, ["conv_id", "part"]).select("conv_id", depth, "mark", "chars"), segments.select("conv_id").distinct()


def rebuilt(spark: SparkSession, turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The same with conversations rebuilt on those whose ids are multiples of ``family``.

    A conversation's first ``h`` turns, the CRC-32 of its decimal id modulo
    ``most``, are replaced by the first ``h`` of its family's, as far as there are any.
    """
    rows, segments = numbered(spark, turns)
    convs = segments.groupBy("conv_id").agg(F.sum("n").alias("n"))
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    convs = convs.select("conv_id", "n", base, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("kept", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = written(spark, convs.select("conv_id", "base", "h", "kept"), "conversations")
    places = segments.join(convs.select("conv_id", "h", "kept"), "conv_id").select("conv_id", "part", "h", "kept", (F.col("before") - F.col("lowest")).alias("shift"))
    position = F.col("place") + F.col("shift")
    own = rows.join(places, ["conv_id", "part"]).where(position >= F.col("h"))
    own = own.select("conv_id", (position - F.col("h") + F.col("kept") + 1).alias("depth"), "mark", "chars")
    firsts = rows.where(F.col("conv_id") % family == 0).join(places, ["conv_id", "part"]).where(position < most - 1)
    firsts = firsts.select(F.col("conv_id").alias("base"), position.alias("position"), "mark", "chars")
    taken = firsts.join(convs.select("conv_id", "base", "h"), "base").where("position < h")
    return own.unionByName(taken.select("conv_id", (F.col("position") + 1).alias("depth"), "mark", "chars")), convs.select("conv_id")


def _paths(rows: DataFrame, block: int) -> DataFrame:
    """Each turn with the digest of the prefix that ends with it and of the one before."""
    x, y = F.xxhash64("depth", "mark"), F.xxhash64("mark", "depth", F.lit(7))
    number = F.call_function("div", F.col("depth") - 1, F.lit(block))
    rows = rows.select("conv_id", "depth", number.alias("block"), "chars", x.alias("own_x"), y.alias("own_y"))
    whole = rows.groupBy("conv_id", "block").agg(F.bit_xor("own_x").alias("all_x"), F.bit_xor("own_y").alias("all_y"), F.max("depth").alias("last"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.withColumns({f"before_{c}": F.bit_xor(f"all_{c}").over(earlier) for c in "xy"}).where("block > 0")
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    paths = rows.withColumns({c: F.bit_xor(f"own_{c}").over(upto) for c in "xy"})
    paths = paths.join(before.select("conv_id", "block", "before_x", "before_y"), ["conv_id", "block"], "left")
    paths = paths.withColumns({c: F.col(c).bitwiseXOR(F.coalesce(f"before_{c}", F.lit(0))) for c in "xy"})
    parent = [F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"p{c}") for c in "xy"]
    return paths.select("conv_id", "block", "depth", "x", "y", *parent, "chars")


def trie(spark: SparkSession, rows: DataFrame, convs: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per distinct prefix, root included, of the turns ``conv_id, depth, mark, chars``.

    Depths run from 1 without gaps; ``convs`` are the ids of all conversations,
    turnless ones too. Turns are equal when their marks are. Result, one row a node:
    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. No conversations, no nodes.
    """
    paths = written(spark, _paths(rows, block), "paths")
    grown = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("px").alias("px"), F.min("py").alias("py"), F.min("chars").alias("chars")
    )
    zero = [F.lit(0).cast("bigint").alias(c) for c in NODE]
    none = [F.lit(None).cast("bigint").alias(c) for c in ("px", "py")]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*zero, "conv_id", "n_convs", *none, F.lit(0).cast("bigint").alias("chars"))
    children = grown.groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    nodes = grown.withColumn("depth", F.col("depth").cast("bigint")).unionByName(root).join(children, NODE, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("chars")).withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
    nodes = written(spark, nodes, "nodes")

    # What a block's last turn gets from the blocks behind it.
    owned = nodes.where("depth > 0").select("conv_id", "depth", "weight", "leaf")
    behind = owned.where(F.col("depth") > block).groupBy("conv_id", F.expr(f"(depth - 1) div {block}").alias("block"))
    behind = behind.agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    ends = paths.where(F.col("depth") % block == 0).select("conv_id", "block", "depth")
    both = ends.unionByName(behind, allowMissingColumns=True).withColumn("back", -F.col("block"))
    later = Window.partitionBy("conv_id").orderBy("back").rangeBetween(Window.unboundedPreceding, -1)
    carried = both.withColumns({f"c_{c}": F.sum(c).over(later) for c in ("weight", "leaf")}).where("depth is not null")
    carried = carried.select("conv_id", "depth", "c_weight", "c_leaf")

    units = paths.join(owned, ["conv_id", "depth"], "left").join(carried, ["conv_id", "depth"], "left")
    total = [(F.coalesce(c, F.lit(0)) + F.coalesce(f"c_{c}", F.lit(0))).alias(c) for c in ("weight", "leaf")]
    units = units.select("conv_id", "block", "depth", "x", "y", "px", "py", *total)
    units = units.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")
    sums = units.mapInArrow(_accumulate(block, shard_rows), "depth long, x long, y long, saved long, leaves long")
    sums = sums.groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))

    last = paths.select("conv_id", *NODE).unionByName(convs.select("conv_id", *zero)).groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("last"))
    last = last.select("last.*", "conv_id")
    pieces = last.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(_joined_ids, "depth long, x long, y long, first long, ids string")
    hashes = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hashed_ids, "depth long, x long, y long, ends_sha256 string")

    above = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, NODE, "left").join(hashes, NODE, "left").join(above, ["depth", "px", "py"], "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


OP12_SQL = r"""
WITH RECURSIVE byte AS (
  SELECT i, 0 AS step, i::ubigint AS v FROM range(256) r(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::ubigint) ELSE v // 2 END FROM byte WHERE step < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM byte WHERE step = 8),
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))
  ) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_transform(string_split(conv_id::varchar, ''), lambda d: ascii(d)::ubigint), lambda a, b: xor(a // 256, t[(xor(a, b) % 256 + 1)::int]), 4294967295::ubigint
  ), 4294967295::ubigint) % 6 AS h FROM (SELECT DISTINCT conv_id FROM o), crc
), r AS (
  SELECT c.conv_id, 0 AS own, pos, role, text FROM c JOIN o ON o.conv_id = c.base WHERE pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id WHERE pos >= h
), s AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, pos) AS turns FROM r GROUP BY conv_id),
w AS (SELECT conv_id, coalesce(turns, []) AS turns FROM c LEFT JOIN s USING (conv_id)),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM w),
n AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
  FROM p GROUP BY 1, 2
), k AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(length(path[depth].text), 0) AS w FROM n LEFT JOIN k USING (depth, path)),
u AS (SELECT path, w, n_children, unnest(range(0, depth + 1)) AS depth FROM m),
t AS (SELECT depth, path[1:depth] AS path, sum(w)::bigint AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY 1, 2)
SELECT m.conv_id, m.depth::bigint AS depth, above.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN t USING (depth, path) LEFT JOIN n above ON above.depth = m.depth - 1 AND above.path = m.path[1:m.depth - 1]
"""
