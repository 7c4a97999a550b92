import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from tapeworks.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def key(row):
    role, text = row[2] or "", row[3] or ""
    mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (row[1] is not None, row[1] or 0, mark)


def brute(rows, rebuild):
    turns = {}
    for row in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], key(r))):
        turns.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in turns}
        turns = {c: turns.get(c - int(math.fmod(c, 100)), [])[: h[c]] + own[h[c] :] for c, own in turns.items()}
    members = {}
    for c, own in turns.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    saved, leaves = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        own = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        saved[path] = own + sum(saved[b] for b in below)
        leaves[path] = sum(leaves[b] for b in below) or 1
    found = []
    for path, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(turns[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        below = len(children.get(path, []))
        found.append((min(of), len(path), parent, len(of), below, leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def ours(spark, rows, rebuild, schema=SCHEMA, **options):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, schema)
    frame = frame.withColumns({c: F.lit(1) for c in ("depth", "part", "place", "mark", "chars", "x", "block", "base", "h", "n_convs")})
    make = prefix_trie.rebuilt if rebuild else prefix_trie.plain
    return sorted((tuple(r) for r in prefix_trie.trie(spark, *make(spark, frame), **options).collect()), key=str)


def some_rows(seed, n=400):
    chance = random.Random(seed)
    roles, texts = ["user", "assistant", "", None], ["a", "b", "hello there", "", None, "é😀"]
    return [
        (chance.choice([None, 0, 1, 2, 7, 99, 100, 101, 150, 205, 206, 312, -5, 2**40]), chance.choice([None, 0, 1, 1, 2, 3, 4, 5, 9]), chance.choice(roles), chance.choice(texts))
        for _ in range(n)
    ]


@pytest.mark.parametrize("rebuild", [False, True])
def test_odd_rows(spark, rebuild):
    """Null ids, turns, roles and texts, repeated rows and turns, absent families, turnless conversations."""
    for seed, n in ((1, 30), (2, 400)):
        rows = some_rows(seed, n)
        assert ours(spark, rows, rebuild, block=3, shard_rows=40) == brute(rows, rebuild)


def test_many_copies_and_one_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(5)]
    rows += [(1000, t, "user", f"turn {t % 7}") for t in range(2000)] + [(1001, t, "user", f"turn {t % 7}") for t in range(1500)]
    rows += [(2000, 0, "user", "x" * 1_000_000)]
    assert ours(spark, rows, False, block=64, shard_rows=100) == brute(rows, False)
    assert ours(spark, rows, True) == brute(rows, True)


def test_nothing(spark):
    assert ours(spark, [], True) == [] == ours(spark, [(None, 1, "user", "a")], False)


def test_only_turnless_conversations(spark):
    turnless = [c for c in range(301, 400) if zlib.crc32(str(c).encode()) % 6]
    rows = [(c, 0, "user", "a") for c in turnless]
    assert ours(spark, rows, True) == brute(rows, True)
    assert len(ours(spark, rows, True)) == 1


def test_slots_are_minimal_and_verified():
    chance = np.random.default_rng(3)
    for size in (0, 1, 2, 17, 5000):
        keys = np.unique(chance.integers(-(2**62), 2**62, (size, 3)), axis=0)
        table = prefix_trie.Slots(keys)
        assert sorted(table.find(keys)) == list(range(len(keys)))
        assert (prefix_trie.Slots(keys).find(keys + 1) == -1).all()


def test_sums_through_parent_slots():
    """A chain and a branch whose parent is in no row."""
    nodes = np.array([[1, 5, 5], [2, 6, 6], [3, 7, 7], [3, 8, 8], [9, 1, 1]])
    parents = np.array([[0, 0, 0], [1, 5, 5], [2, 6, 6], [2, 6, 6], [8, 4, 4]])
    keys, totals = prefix_trie.accumulated(nodes, parents, np.array([[1], [10], [100], [1000], [7]]))
    found = {tuple(k): t[0] for k, t in zip(keys.tolist(), totals.tolist())}
    assert found == {(0, 0, 0): 1111, (1, 5, 5): 1111, (2, 6, 6): 1110, (3, 7, 7): 100, (3, 8, 8): 1000, (9, 1, 1): 7}
