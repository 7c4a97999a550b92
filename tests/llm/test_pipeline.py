"""The pipeline against a brute-force version of every stage."""

import duckdb
import numpy as np
import pandas as pd
from tokenizers import Tokenizer

import corpus_pipeline
from tapeworks.llm import mixing, packing
from tapeworks.llm.common import documents
from tapeworks.llm.tokens import vocabulary_path

from . import plain_quality as plain
from .test_scans import plain_counts
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def plain_quality(rows):
    judged = plain.judged(rows, [plain_counts(r.text) for r in rows])
    return [r for i, r in enumerate(rows) if judged[i][1]]


def plain_exact(rows):
    best = {}
    for r in rows:
        norm = "".join(c for c in r.text if c not in " \t\n\x0b\x0c\r")
        if norm not in best or (-len(r.text), r.doc_id) < (-len(best[norm].text), best[norm].doc_id):
            best[norm] = r
    return list(best.values())


def test_run(spark):
    rows = documents(spark, SF).collect()
    kept = plain_exact(plain_quality(rows))
    assert len(kept) < len(rows)

    def shingles(text):
        words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {r.doc_id: shingles(r.text) for r in kept}
    root = {r.doc_id: r.doc_id for r in kept}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and root[a] != root[b]:
                    shared = len(sets[a] & sets[b])
                    if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                        low, high = sorted((root[a], root[b]))
                        root = {k: low if v == high else v for k, v in root.items()}
                        changed = True
    kept = [r for r in kept if root[r.doc_id] == r.doc_id]
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame([r.asDict() for r in kept]))
    sql = mixing._sql(corpus_pipeline.MIX_SHARE, corpus_pipeline.MIX_EPOCHS)
    taken = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({sql}) WHERE copies > 0").fetchall()}
    assert 0 < len(taken) < len(kept)
    tokenizer = Tokenizer.from_file(vocabulary_path())
    plain = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    result = corpus_pipeline.run(spark, SF).collect()
    check_packing(result, [(r.doc_id, r.text) for r in kept if r.doc_id in taken], plain, packing.LIMIT)


def test_stages_keep_columns(spark, docs_of):
    """Each stage takes odd rows and extra columns and returns what it was given."""
    from pyspark.sql import functions as F

    texts = [None, "", "short", *[" ".join(f"w{i}x{j}" for j in range(60)) for i in range(8)]]
    docs = docs_of(texts).withColumn("wanted", F.lit("x"))
    docs = docs.unionByName(docs.limit(4))
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            found = stage(spark, given, SF)
            if name != "best_fit_packing":
                assert found.columns == docs.columns
            assert (found.count() > 0) == (given is docs)


def test_rows_without_id_are_judged_one_by_one(spark, docs_of):
    from pyspark.sql import functions as F

    good = [" ".join(f"w{i}x{j}" for j in range(60 + i)) for i in range(40)]
    docs = docs_of(["too short", None, *good]).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    for same in (None, 7):
        given = docs.withColumn("doc_id", F.lit(same).cast("long"))
        kept = [r.text for r in corpus_pipeline.quality(spark, given, SF).collect()]
        assert sorted(kept) == sorted(good)
        taken = corpus_pipeline.mixed(spark, given.where("length(text) > 20"), SF).collect()
        words = sum(len(t.split()) for t in good)
        assert 0 < sum(len(r.text.split()) for r in taken) <= corpus_pipeline.MIX_SHARE * words
