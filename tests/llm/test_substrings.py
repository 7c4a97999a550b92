import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tapeworks.llm import substring_dedup
from tapeworks.llm.common import documents
from tapeworks.llm.hashing import WORDS, runs, stretches

SF = "/root/testdata/sf0.001"


def plain(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        yield len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()


def check(spark, docs, window=35, **options):
    given = docs.select("doc_id", "text").collect()
    expected = sorted((str(r.doc_id), *found) for r, found in zip(given, plain([r.text for r in given], window)))
    rows = substring_dedup.report(spark, docs, window=window, **options).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows) == expected
    return sum(r.n_removed for r in rows)


def test_table(spark):
    assert check(spark, documents(spark, SF)) > 1000


def test_table_by_longer_prefixes(spark):
    check(spark, documents(spark, SF), tree=1)


@pytest.mark.parametrize("seed", range(3))
def test_spliced(spark, docs_of, seed):
    """Texts spliced from shared passages of every length, with loops and few words."""
    chance = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(chance.randint(3, 40))] for k in range(12)] + [["la"] * 60, ["do", "re"] * 20]
    texts = [None, "", " \n", "a b", "é\x1cf ü\x85g"]
    for _ in range(60):
        words = []
        for _ in range(chance.randint(1, 7)):
            words += chance.choice(passages)[: chance.randint(1, 60)]
            words += [f"u{chance.randint(0, 10**6)}" for _ in range(chance.randint(0, 4))]
        texts.append(chance.choice([" ", "\n", " \t"]).join(words))
    docs = docs_of(texts).unionByName(docs_of(texts[8:12])).unionByName(docs_of(["other text of one id " * 9], first=8))
    check(spark, docs, window=10, run=[4, 10, 1][seed], tree=[4000, 1, 5][seed])


def test_rows_of_one_checksum_and_one_id(spark):
    """Texts of one 32-bit checksum, one of them with a copy, all without ids, of one id, or of null and 0."""
    # Two hundred thousand endings of each text: some nine agree.
    own, shared = (" ".join(f"{c}{i}" for i in range(45)) for c in "us")
    words = [hashlib.md5(str(n).encode()).hexdigest() for n in range(200_000)]
    ends = {zlib.crc32(f"{own} {w}".encode()): w for w in words}
    m, n = next((ends[c], w) for w in words if (c := zlib.crc32(f"{shared} {w}".encode())) in ends)
    for one, other in ((None, None), (7, 7), (None, 0), (0, None)):
        rows = [(9, f"{shared} copy"), (one, f"{own} {m}"), (other, f"{shared} {n}")]
        assert check(spark, spark.createDataFrame(rows, "doc_id long, text string")) == 90


def test_nothing(spark, docs_of):
    assert substring_dedup.report(spark, docs_of(["x"]).limit(0)).collect() == []


def test_every_window_has_one_sample():
    rng = np.random.default_rng(0)
    for n in (10, 11, 40, 300):
        hashes = runs(rng.integers(0, 5, n).astype(np.uint64), 4)
        place, first, last = substring_dedup.samples(hashes, 10, 4)
        assert first[0] == 0 and last[-1] == n - 10 and (first[1:] == last[:-1] + 1).all()
        for p, a, b in zip(place, first, last):
            for start in range(a, b + 1):
                assert p == start + int(np.argmin(hashes[start : start + 7]))


def test_stretch_hashes_compare_words():
    words = WORDS.of([b"a", b"b", b"c", b"a", b"b", b"c", b"b"])
    found = stretches(words, np.array([0, 3, 1, 0]), np.array([3, 6, 4, 2]))
    assert found[0] == found[1] and len(set(found.tolist())) == 3
