import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tapeworks.llm import retrieval_packing
from tapeworks.llm.common import documents
from tapeworks.llm.tokens import RankEncoder, vocabulary_path

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", "  \n ", "The the, THE. don't l'été  ÉTÉ!\n\n straße", "a<|endoftext|>b <|endoftext|>", "İstanbul Σας",
    "x\x00y a\xa0b c\x1cd\r\n", "日本語 テキスト 😀 ok", "12345 6,7.8!!", "word " * 5000, "word " * 5000, "q" * 3000, "a" * 700 + " " * 900,
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ranks_give_the_tokenizers_ids(plain):
    encoder = RankEncoder("byte_bpe_50k")
    alphabet = "aBcé ÜßñÇ.,!?'s \n\t<>#12Σ́ſƀ"
    chance = random.Random(4)
    for text in TEXTS + ["".join(chance.choice(alphabet) for _ in range(300)) for _ in range(60)]:
        assert encoder.ids(text or "").tolist() == plain(text)


def check(rows, texts, plain, window, tasks):
    """Every id lies in one piece, sequences have no gaps and are full or powers of two."""
    parts = {}
    for r in rows:
        parts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    expected = {}
    for doc_id, text in texts:
        ids = np.array(plain(text) + [retrieval_packing.END], "<u4")
        expected.setdefault((doc_id, len(ids)), []).append(ids)
    assert parts.keys() == expected.keys()
    for key, copies in expected.items():
        assert sum(r.length for r in parts[key]) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for r in sorted(parts[key], key=lambda r: r.start):
                assert r.start == at
                assert r.ids_crc32 == zlib.crc32(copies[0][at : at + r.length].tobytes())
                at += r.length
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end and length > 0
            end += length
        assert end == window or end < window and end & (end - 1) == 0
        short += end < window
    assert short <= tasks * window.bit_length()


@pytest.mark.parametrize("window", [16, 100, 1024])
def test_small(spark, docs_of, plain, window):
    docs = docs_of(TEXTS + ["a b"] * 40)
    rows = retrieval_packing.pack(spark, docs, window, shard_passages=7).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], plain, window, 8)


def test_table(spark, plain):
    docs = documents(spark, SF)
    rows = retrieval_packing.pack(spark, docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], plain, retrieval_packing.WINDOW, 8)


def test_rows_of_no_id_and_of_one_id(spark, docs_of, plain):
    from pyspark.sql import functions as F

    docs = docs_of(["one two", "one two", "three"]).withColumn("doc_id", F.when(F.col("text") == "three", 5))
    docs = docs.unionByName(docs).withColumnRenamed("text", "body").withColumn("text", F.lit(1))
    rows = retrieval_packing.pack(spark, docs, text_col="body").collect()
    check(rows, [(r.doc_id, r.body) for r in docs.collect()], plain, 1024, 8)


def test_ids_are_those_of_the_pieces(spark, docs_of, plain):
    docs = docs_of(["word " * 300, "other words " * 40, None])
    rows = retrieval_packing.pack(spark, docs, 64, with_ids=True).collect()
    whole = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
        whole[r.doc_id] = whole.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert whole == {r.doc_id: plain(r.text) + [0] for r in docs.collect()}


def test_nothing(spark, docs_of):
    assert retrieval_packing.pack(spark, docs_of(["x"]).limit(0)).collect() == []


def bm25(passages, seed, weights):
    """Scores of all passages by the formula, one term at a time."""
    held = [dict(zip(*np.unique(p, return_counts=True))) for p in passages]
    found = []
    for passage, terms in zip(passages, held):
        score = 0.0
        for term in held[seed]:
            n = sum(term in other for other in held)
            idf = np.log1p((len(passages) - n + 0.5) / (n + 0.5))
            times = terms.get(term, 0)
            norm = retrieval_packing.SATURATION * (1 - retrieval_packing.LENGTH + retrieval_packing.LENGTH * len(passage) / weights.mean)
            score += idf * times * (retrieval_packing.SATURATION + 1) / (times + norm)
        found.append(score)
    return np.array(found)


def frequencies(passages):
    found = {-1: len(passages), -2: sum(map(len, passages))}
    for passage in passages:
        for term in np.unique(passage).tolist():
            found[term] = found.get(term, 0) + 1
    return found


def test_scores_are_bm25():
    chance = np.random.default_rng(1)
    passages = [chance.integers(0, 40, chance.integers(1, 60)).astype(np.uint16) for _ in range(30)]
    weights = retrieval_packing.Weights(frequencies(passages))
    index = retrieval_packing.Index(passages, weights)
    for seed in range(30):
        others = np.arange(30) != seed
        assert np.allclose(index.scores(seed)[others], bm25(passages, seed, weights)[others], rtol=1e-4)


def test_windows_hold_neighbours():
    """Passages of few topics, shuffled: windows hold one topic, not a mix of them."""
    chance = np.random.default_rng(2)
    passages = [(chance.integers(0, 100, 100) + 100 * (n % 8)).astype(np.uint16) for n in chance.permutation(160)]
    windows, over = retrieval_packing.fill(passages, retrieval_packing.Weights(frequencies(passages)), 500)
    assert sum(to - at for w in [*windows, over] for _, at, to in w) == 16_000
    pure = [len({int(passages[p][0]) // 100 for p, _, _ in w}) == 1 for w in windows]
    assert np.mean(pure) > 0.8


def test_in_powers():
    found = retrieval_packing.in_powers([(0, 3, 10), (1, 0, 1), (2, 0, 5)])
    assert [sum(to - at for _, at, to in s) for s in found] == [8, 4, 1]
    assert retrieval_packing.in_powers([]) == []
