import random
import re
import zlib
from collections import Counter

import pytest

from tapeworks.llm import spelling

ALPHABET = "abéÿ×"


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, length, count, ratio, deleted):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if deleted and code % deleted == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    found = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(found)


def ours(spark, rows, length, count, ratio, deleted):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("word", "n", "prefix", "size", "at", "letter", "lead", "rank")})
    return sorted(map(tuple, spelling.variants(spark, docs, length, count, ratio, deleted).collect()))


@pytest.mark.parametrize("length, deleted", [(1, None), (1, 3), (4, 2)])
def test_dense_words(spark, length, deleted):
    """Few letters, so that most words have neighbours and letters repeat."""
    chance = random.Random(length)
    rows = [(None, None), (None, ""), (3, "  \n"), (None, "aab AAB aAb aabb"), (None, "aab AAB aAb aabb"), (0, "aab"), (0, "aab")]
    for doc_id in range(60):
        made = ["".join(chance.choices(ALPHABET, weights=[8, 4, 2, 1, 1], k=chance.randint(1, 5))) for _ in range(120)]
        rows.append((doc_id % 50, chance.choice([" ", ", ", "1", "\n"]).join(made)))
    rows.append((77, "abab " * 20_000 + "É" * 100_000))
    assert ours(spark, rows, length, 2, 2, deleted) == brute(rows, length, 2, 2, deleted)


def test_chain_of_forms(spark):
    """Forms that lead to forms: the root is where the chain of twelve ends."""
    rows, word = [], "zzzzzzzzzzzz"
    for step in range(13):
        rows.append((step, f"{'a' * step + word[step:]} " * 2**step))
    found = ours(spark, rows, 6, 1, 2, None)
    assert found == brute(rows, 6, 1, 2, None)
    assert {root for *_, root, _, _, _ in found} == {"a" * 12}


def test_ties_go_to_the_first_word(spark):
    rows = [(0, "abcdef " + "abcdeg abcdeh " * 9)]
    found = {row[0]: row for row in ours(spark, rows, 6, 1, 5, None)}
    assert found["abcdef"] == ("abcdef", "abcdeg", "abcdeg", 1, 2, 9)
    assert found["abcdeg"] == ("abcdeg", None, "abcdeg", 9, 2, None)


def test_long_words(spark):
    """Lengths around the one from which prefixes are named by hashes, and one very long word in many documents."""
    chance = random.Random(5)
    made = ["".join(chance.choices("ab", k=size)) for size in (62, 63, 64, 65, 66, 67, 200)]
    made += [w[:30] + w[31:] for w in made] + [w[:30] + "b" + w[31:] for w in made] + [w[:30] + "b" + w[30:] for w in made] + [w[1:] for w in made] + [w + "a" for w in made]
    rows = [(n, " ".join([word] * chance.randint(1, 12))) for n, word in enumerate(made)]
    assert ours(spark, rows, 6, 1, 2, None) == brute(rows, 6, 1, 2, None)
    rows = [(n, "q" * 100_000 + " " + "q" * 99_999) for n in range(5)]
    assert [row[3:] for row in ours(spark, rows, 6, 5, 5, None)] == [(5, 1, None)] * 2


def test_nothing(spark):
    assert ours(spark, [], 6, 5, 5, 199) == [] == ours(spark, [(1, None)], 6, 5, 5, 199)


def test_ranges_hold_one_word_a_letter(spark):
    rows = [(n, "prefix" + chr(97 + n) + " other" + chr(97 + n) + "words") for n in range(26)]
    counted = spelling.words(spark.createDataFrame(rows, "doc_id long, text string"), 6, 1)
    ranges = spelling.rotations(counted.selectExpr("word", "n", "xxhash64(word) as number")).groupBy("prefix", "letter").count()
    assert ranges.where("count > 1").isEmpty()
