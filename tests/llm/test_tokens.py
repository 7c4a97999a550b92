import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapeworks.llm import packing, token_codes
from tapeworks.llm.common import documents
from tapeworks.llm.tokens import Encoder, vocabulary_path

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", "  \n", "The the, THE. don't l'été ÉTÉ! straße", "a<|endoftext|>b <|startoftext|>", "É́ ́a Σας ΟΔΟΣ İstanbul",
    "x\x00y a\xa0b c\x1cd", "日本語 テキスト 😀 ok", "ﬁne ª º ǅ", "12345 6,7.8!!", "word " * 9000, "word " * 9000, "q" * 5000,
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(vocabulary_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer(plain):
    encoder = Encoder(vocabulary_path(), cached=9000)
    alphabet = "aBcé ÜßñÇ.,!?'s \n\t<>#12Σ́ſƀ"
    chance = random.Random(4)
    texts = TEXTS + ["".join(chance.choice(alphabet) for _ in range(300)) for _ in range(60)]
    for text in texts:
        for _ in range(2):
            assert np.frombuffer(encoder.ids(text or ""), "<u4").tolist() == plain(text)


def check_packing(rows, texts, plain, limit):
    cut = {}
    for doc_id, text in texts:
        ids = plain(text) + [packing.END]
        for n, at in enumerate(range(0, len(ids), limit)):
            part = np.array(ids[at : at + limit], "<u4")
            cut.setdefault((doc_id, n, at, len(part), zlib.crc32(part.tobytes())), []).append(1)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(k for k, v in cut.items() for _ in v)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= limit
    return len(sequences)


def best_fit(lengths, limit):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            gaps.append(limit - length)
    return len(gaps)


def test_packing_small(spark, docs_of, plain):
    docs = docs_of(TEXTS + ["a b"] * 40)
    for limit in (16, 4096):
        rows = packing.pack(spark, packing.pieces(docs, limit), limit).collect()
        used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], plain, limit)
        assert used == best_fit([r.length for r in rows], limit)


def test_packing_table(spark, plain):
    docs = documents(spark, SF)
    rows = packing.pack(spark, packing.pieces(docs)).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], plain, packing.LIMIT)
    assert used == best_fit([r.length for r in rows], packing.LIMIT)


def test_packing_nothing(spark, docs_of):
    assert packing.pack(spark, packing.pieces(docs_of(["x"]).limit(0))).collect() == []


def test_plan_is_best_fit():
    chance = random.Random(1)
    for _ in range(30):
        lengths = [chance.randint(1, 40) for _ in range(300)]
        counts = {n: lengths.count(n) for n in set(lengths)}
        slots = packing.plan(counts, 50)
        assert sum(s[2] for s in slots) == 300
        assert 1 + max(s[3] + s[2] - 1 for s in slots) == best_fit(lengths, 50)


@pytest.mark.parametrize("size", [1, 100, 1 << 20])
def test_codes_round_trip(spark, docs_of, plain, size):
    docs = docs_of(TEXTS).unionByName(docs_of(["tie", "tie"], first=3))
    rows = sorted(token_codes.round_trip(spark, docs, segment_ids=size).collect(), key=lambda r: r.start)
    expected, start = [], 0
    for doc_id, text in sorted((r.doc_id, r.text or "") for r in docs.collect()):
        ids = np.array(plain(text) + [token_codes.END], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in rows] == expected


def test_codes_nothing(spark, docs_of):
    assert token_codes.round_trip(spark, docs_of(["x"]).limit(0)).collect() == []


def test_direct_access():
    ids = np.random.default_rng(0).choice([3, 255, 256, 49407, 2**24 + 5, 2**32 - 1], 5000).astype(np.uint32)
    levels, bitmaps, ranks = token_codes.encode(ids)
    assert token_codes.decode(levels, bitmaps).tolist() == ids.tolist()
    assert [token_codes.at(levels, bitmaps, ranks, i) for i in range(len(ids))] == ids.tolist()
    places = np.random.default_rng(1).integers(0, len(ids), 40_000)
    assert (token_codes.at_places(levels, bitmaps, ranks, places) == ids[places]).all()
    assert token_codes.at_places(levels, bitmaps, ranks, places[:0]).tolist() == []


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_lookup_of_single_ids(spark, docs_of, plain, tmp_path, size):
    """Every place of every document, by ranks, without decoding; odd requests have no row."""
    docs = docs_of(TEXTS).unionByName(docs_of(["tie", "tie", "tie knot"], first=3)).unionByName(docs_of(["no id"], first=99))
    docs = docs.withColumn("doc_id", F.expr("nullif(doc_id, 99)"))
    path = str(tmp_path / "codes")
    token_codes.write(spark, docs, path, segment_ids=size)
    expected, asked = [], []
    for doc_id, text in ((r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()):
        ids = plain(text) + [token_codes.END]
        expected += [(doc_id, i, token) for i, token in enumerate(ids)]
        asked += [(doc_id, i, 0) for i in range(-1, len(ids) + 1)]
    asked += [(None, 0, 0), (0, None, 0), (77, 0, 0), *asked[:50]]
    requests = spark.createDataFrame(asked, "doc_id long, position long, segment int")
    found = sorted(tuple(r) for r in token_codes.lookup(spark, path, requests).collect())
    assert found == sorted(expected)
    assert token_codes.lookup(spark, path, requests.limit(0)).collect() == []


def test_lookup_in_nothing(spark, docs_of, tmp_path):
    token_codes.write(spark, docs_of(["x"]).limit(0), str(tmp_path / "none"))
    requests = spark.createDataFrame([(0, 0)], "doc_id long, position long")
    assert token_codes.lookup(spark, str(tmp_path / "none"), requests).collect() == []
