import random
import re
import time

import numpy as np
import pytest

from tapeworks.llm import ngram_join
from tapeworks.llm.common import CLEAN_UP, components, documents, written

SF = "/root/testdata/sf0.001"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def plain_components(rows):
    ids, sets = [r[0] for r in rows], [plain_set(r[1]) for r in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and ids[i] is not None and ids[j] is not None:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((find(ids[i]), find(ids[j])))
                    root[b] = a
    return {i: find(i) for i in ids}, dict(zip(ids, map(len, sets)))


def near_copies(seed, groups=25, copies=6):
    chance = random.Random(seed)
    passage = [f"P{i}" for i in range(30)]
    texts = [None, "", " \n ", "one", "One", "one two three", "ONE  two\tthree", "a b c d", "a b c D", "İ x y z w", "i̇ x y z w"]
    for g in range(groups):
        n = chance.choice([5, 9, 14, 30, 60, 150, 400])
        words = [f"w{chance.randint(0, 10**6)}" for _ in range(n)]
        if chance.random() < 0.5:
            words[len(words) // 2 : 0] = passage
        for _ in range(copies):
            edited = list(words)
            for _ in range(chance.randint(0, max(1, len(words) // 45))):
                edited[chance.randrange(len(edited))] = f"e{chance.randint(0, 10**6)}"
            texts.append(" ".join(edited + words[: chance.randint(0, 2)]))
    return texts


def check(spark, docs, **options):
    expected, sizes = plain_components([(r.doc_id, r.text) for r in docs.collect()])
    rows = ngram_join.join(spark, docs, **options).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.component_id == expected[r.doc_id]
        assert r.n_shingles == sizes[r.doc_id]


def test_table(spark):
    check(spark, documents(spark, SF))


@pytest.mark.parametrize("block", [400, 8])
def test_near_copies(spark, docs_of, block):
    check(spark, docs_of(near_copies(block)), block=block, pivots=2)


def test_one_large_group(spark, docs_of):
    """A chain of drifting copies: linked only over others, over many blocks."""
    words, texts = [f"w{i}" for i in range(120)], []
    for i in range(90):
        words[(i * 37) % 120] = f"x{i}"
        texts.append(" ".join(words))
    check(spark, docs_of(texts), block=10, pivots=2)


def test_odd_rows(spark, docs_of):
    docs = docs_of(["a b c d e"] * 3 + [None, "x"])
    docs = docs.unionByName(docs)
    rows = ngram_join.join(spark, docs).collect()
    assert len(rows) == 10 and {r.component_id for r in rows if r.doc_id < 3} == {0}
    assert ngram_join.join(spark, docs.limit(0)).collect() == []
    from pyspark.sql import functions as F

    unnamed = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert all(r.component_id is None for r in ngram_join.join(spark, unnamed).collect())


def test_linked_sets_share_a_key():
    """At the least similarity allowed, for sizes around every class; a set of the class meets one of it or from below."""
    rng = np.random.default_rng(3)
    for trial in range(3000):
        percent = (85, 80)[trial // 2 % 2]
        classes = ngram_join.Classes(percent)
        n = int(rng.integers(1, 700)) if trial % 2 else int(rng.integers(1, 40))
        m = int(rng.integers(int(np.ceil(percent * n / 100)), n + 1))
        shared = -(-percent * (n + m) // (100 + percent))
        if shared > m or 100 * shared < percent * (n + m - shared):
            continue
        grams = rng.integers(0, 2**63, n + m - shared).astype(np.uint64)
        a, b = np.unique(grams[:n]), np.unique(np.concatenate([grams[:shared], grams[n:]]))
        (k, k_above), (l, l_above) = ngram_join.signatures(a, classes), ngram_join.signatures(b, classes)
        ours, theirs = dict(zip(k.tolist(), k_above)), dict(zip(l.tolist(), l_above))
        assert any(not (ours[key] and theirs[key]) for key in ours.keys() & theirs.keys())


def test_sets_name_no_more_parts_than_links_need():
    """A set of its class, and one of the next class if it can link to any there."""
    rng = np.random.default_rng(4)
    for percent in (85, 80):
        classes, keys, grams = ngram_join.Classes(percent), 0, 0
        for n in rng.integers(1, 1500, 500).tolist():
            found, above = ngram_join.signatures(np.unique(rng.integers(0, 2**63, n).astype(np.uint64)), classes)
            bound = 1 + (n + n * 100 // percent) * (100 - percent) // (100 + percent)
            assert 0 < (~above).sum() <= bound and above.sum() <= bound
            keys, grams = keys + len(found), grams + n
        assert keys < {85: 0.35, 80: 0.45}[percent] * grams


def test_common_passage_is_no_candidate(spark, docs_of, monkeypatch):
    """Short texts that have a line in common don't form a cluster of their number."""
    found = {}
    written = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda s, df, name: found.setdefault(name, written(s, df, name)))
    chance, line = random.Random(5), [f"l{i}" for i in range(14)]
    texts = []
    for _ in range(600):
        words = [f"w{chance.randint(0, 10**6)}" for _ in range(chance.randint(80, 100))]
        place = chance.randint(0, len(words))
        texts.append(" ".join([*words[:place], *line, *words[place:]]))
    rows = ngram_join.join(spark, docs_of(texts), length=5, percent=80).collect()
    assert all(r.component_id == r.doc_id for r in rows)
    assert found["clusters"].count() < 150


def test_table_leaves_no_shuffle_behind(spark):
    from pyspark.sql import functions as F

    def blocks():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = (block.name() for block in iter_seq(manager.getAllBlocks()))
        return {name for name in names if name.startswith("shuffle_")}

    def iter_seq(seq):
        return [seq.apply(i) for i in range(seq.size())]

    conf = spark.conf.get(CLEAN_UP, None)
    before = blocks()
    frame = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    table = written(spark, frame.join(frame.withColumnRenamed("count", "n"), "k"), "test")
    for _ in range(100):
        if blocks() <= before:
            break
        time.sleep(0.1)
    assert blocks() <= before and spark.conf.get(CLEAN_UP, None) == conf
    assert table.count() == frame.count() == 100


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    found = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 150, 200), 100)}


def drifting(seed, copies, templates=1, words=100):
    """Copies of a text with few and with many words changed, cut or put in, some of them changed further."""
    chance = random.Random(seed)
    texts = []
    for _ in range(templates):
        first = [f"w{chance.randint(0, 10**6)}" for _ in range(words)]
        for _ in range(copies):
            edited = list(chance.choice([first, first, texts[-1].split() if texts else first]))
            for _ in range(chance.randint(0, 8)):
                edited[chance.randrange(len(edited))] = chance.choice([f"e{chance.randint(0, 10**6)}", f"e{chance.randint(0, 3)}", ""])
            texts.append(" ".join(edited[: len(edited) - chance.choice([0, 0, 3, 9])]))
    return texts


@pytest.mark.parametrize("rare,templates", [(64, 1), (3, 1), (0, 2), (5, 3)])
def test_divided_group_in_many_components(spark, docs_of, rare, templates):
    docs = docs_of(drifting(rare, 150 // templates, templates))
    check(spark, docs.unionByName(docs.limit(30)), block=20, pivots=1, rare=rare)


def test_lone_edits_do_not_meet_pairwise(spark, docs_of, monkeypatch):
    """Rows put in blocks grow with the group, not with its square."""
    rows = []
    edges = ngram_join._edges
    monkeypatch.setattr(ngram_join, "_edges", lambda s, d, placed, *rest: rows.append(placed.count()) or edges(s, d, placed, *rest))
    base = [f"w{i}" for i in range(120)]
    texts, chance = [], random.Random(1)
    for i in range(600):
        words = list(base)
        for place in chance.sample(range(120), 1 + i % 8):
            words[place] = f"x{i}y{place}"
        texts.append(" ".join(words))
    check(spark, docs_of(texts), block=20, pivots=1, rare=8)
    assert len(rows) > 1 and sum(rows) < 8 * len(texts)


@pytest.mark.parametrize("one_in", [0, 3, 10])
def test_ngrams_of_much_of_a_cluster_are_no_rows(spark, docs_of, monkeypatch, one_in):
    """What many copies lack of their centre or have beyond it is counted in the row; a row each is for what fewer have."""
    from pyspark.sql import functions as F

    rows = []

    def by_rare(beyond, percent, rare):
        times = beyond.select("cluster", F.explode("beyond").alias("gram")).groupBy("cluster", "gram").count()
        rows.append(times.where(F.col("count") > rare).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0])
        return taken(beyond, percent, rare)

    taken = ngram_join._by_rare
    monkeypatch.setattr(ngram_join, "_by_rare", by_rare)
    chance, texts = random.Random(2), []
    base = [f"w{i}" for i in range(120)]
    for i in range(300):
        words = list(base)
        for place in chance.sample(range(120), 2 + i % 9):
            words[place] = f"x{i}y{place}"
        if one_in and i % one_in == 0:
            words[40:48] = [f"z{k}" for k in range(8)]
        texts.append(" ".join(words))
    check(spark, docs_of(texts), block=20, pivots=1, rare=4)
    # The 11 n-grams with a word of the other middle are common, but one text in ten has them.
    assert 0 < rows[0] <= 11 * 30 if one_in == 10 else rows == [0]
