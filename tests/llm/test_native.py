import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tapeworks.llm import exact_dedup, mixing, url_cascade

SF = "/root/testdata/sf0.001"
WITH_SQL = ("op1_exact_dedup", "op3_url_filter", "op5_substring_dedup", "op7_mix_sources", "op9_ngram_join")
NATIVE = ("op1_exact_dedup", "op3_url_filter", "op7_mix_sources")


def python_nodes(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("Python", "Pandas", "Arrow") if w in plan]


@pytest.mark.parametrize("name", WITH_SQL)
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = contract.queries()[name](spark, SF)
    assert name not in NATIVE or python_nodes(frame) == []
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    columns = sorted(frame.columns)
    theirs = relation.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted(map(str, map(tuple, frame.select(columns).collect()))) == sorted(map(str, theirs))


TEXTS = [None, "", " \n", "a b", "ab", "a\tb ", "a b  ", "AB", "a\xa0b", "é" * 3, "x" * 100_000, "x" * 100_000 + "\n", "ab"]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, docs_of, weak):
    docs = docs_of(TEXTS).unionByName(docs_of(["ab", None], first=4))
    digest = (lambda c: F.substring(F.unhex(F.md5(c)), 1, 0)) if weak else exact_dedup.sha256
    rows = exact_dedup.groups(docs, digest=digest, salts=3).collect()
    groups = {}
    for r in docs.collect():
        text = r.text or ""
        groups.setdefault("".join(c for c in text if c not in " \t\n\x0b\x0c\r"), []).append((-len(text), r.doc_id))
    expected = [(i, min(g)[1], len(g), (n, i) == min(g)) for g in groups.values() for n, i in g]
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows) == sorted(expected)
    if not weak:
        assert {r.text_sha256 for r in rows} == {hashlib.sha256(t.encode()).hexdigest() for t in groups}


def test_exact_rows_kept(spark, docs_of):
    docs = docs_of(TEXTS).unionByName(docs_of(["ab"], first=6)).unionByName(docs_of(["zz"], first=6))
    docs = docs.unionByName(docs_of(["q", "q"]).withColumn("doc_id", F.lit(None).cast("long")))
    kept = exact_dedup.deduplicate(spark, docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(rows, key=str) == sorted(
        [(2, " \n"), (6, "a b  "), (7, "AB"), (8, "a\xa0b"), (9, "é" * 3), (11, "x" * 100_000 + "\n"), (6, "zz"), (None, "q")], key=str
    )
    assert exact_dedup.groups(docs.limit(0)).collect() == []


URLS = [None, "", "no scheme", "http://", "http:///path", "http://ORG", "https://X.Org/a?b#c", "http://org?x=/", "a://b.example.org/es/1", "a://example.org/en/12", "a://example.org/EN/1", "a://notexample.org/es/", "http://com/fr/", "http://x.com/de/?q", "http://x.com/de", "http://casino.net/", "http://big-bets.co.uk/a://b", "http://alphabets.net/", "http://example.org:80/es/", "http://é.com/fr/é"]


def plain_verdict(url, rules, words):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for mark in "/?#":
            host = host.split(mark)[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    listed = any(w in words for label in host.split(".") for w in label.split("-"))
    return host, path, None, "block" if listed else "allow"


@pytest.mark.parametrize("max_bits", [2**23, 64])
def test_url_verdicts(spark, max_bits):
    words = ("casino", "bets", "adult")
    hosts = [f"h{i}.{w}{i % 3}.example.org" for i in range(20) for w in ("bets-", "net", "adult-")]
    urls = URLS + [f"http://{h}/{p}" for h in hosts for p in ("", "es/", "en/1", "fr/")]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(None, URLS[6], 1)], "page_id long, url string, key int")
    rows = url_cascade.judge(spark, pages, words=words, max_bits=max_bits).collect()
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls) + 1
    assert all(found[i] == plain_verdict(u, url_cascade.RULES, words) for i, u in enumerate(urls))
    assert url_cascade.judge(spark, pages.limit(0)).collect() == []


@pytest.mark.parametrize("max_bits", [2**23, 256])
def test_url_lists_are_tables(spark, max_bits):
    """Lists far longer than a shard, of which the corpus has a part; very long urls; nulls and contradictions."""
    chance = random.Random(7)
    host = lambda: ".".join(chance.choice("abcdefgh") for _ in range(chance.randint(1, 2))) + chance.choice((".org", ".com"))
    path = lambda: "/" + "".join(chance.choice(("x/", "y/", "é/")) for _ in range(chance.randint(0, 2)))
    rules = {(host(), path()): chance.choice(("allow", "block")) for _ in range(400)}
    rules["q.org", "/" + "z" * 5000] = "block"
    listed = {host() for _ in range(300)}
    urls = URLS + [f"http://{host()}{path()}?q" for _ in range(1500)] + ["http://q.org/" + "z" * n for n in (4999, 5000, 200_000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    odd = [("allow", None, "/"), ("block", "a.org", None), (None, "a.org", "/"), ("other", "com", "/"), ("block", "com", ""), ("block", "", "/")]
    table = [(v, h.upper(), p) for (h, p), v in rules.items()]
    table = spark.createDataFrame(table + table[:9] + odd, "verdict string, host string, path string")
    hosts = spark.createDataFrame([(h, 1) for h in [*listed, "a.org", "A.ORG", "", None]], "host string, seen int")
    rows = url_cascade.judge(spark, pages, rules=table, hosts=hosts, max_bits=max_bits).collect()
    plain = [(v, h, p) for (h, p), v in rules.items()]
    assert len(rows) == len(urls)
    for r in rows:
        expected = plain_verdict(urls[r.page_id], plain, ())
        if expected[2] is None:
            expected = (*expected[:3], "block" if expected[0] in listed | {"a.org"} else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == expected
    assert {r.verdict for r in rows if r.rule} == {r.verdict for r in rows if not r.rule} == {"allow", "block"}


def test_url_lists_may_be_empty_or_contradict(spark):
    pages = spark.createDataFrame([(1, "http://casino.org/a"), (2, None)], "page_id long, url string")
    none = url_cascade.judge(spark, pages, rules=(), hosts=spark.createDataFrame([], "host string"))
    assert {(r.page_id, r.rule, r.verdict) for r in none.collect()} == {(1, None, "allow"), (2, None, "allow")}
    both = url_cascade.judge(spark, pages, rules=(("allow", "org", "/"), ("block", "org", "/")))
    assert {(r.page_id, r.rule, r.verdict) for r in both.collect()} == {(1, "org/", "block"), (2, None, "allow")}


@pytest.mark.parametrize("max_bits", [2**23, 512])
def test_cascade_is_exact_on_its_universe(spark, max_bits):
    keys = spark.range(4000).select(F.concat(F.lit("key"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    found = url_cascade.cascade(spark, keys, "listed", max_bits)
    assert len(found.levels) > 1
    assert (found.levels[0].shards > 1) == (max_bits == 512)
    assert keys.where(found.contains(F.col("key")) != F.col("listed")).count() == 0


def fill(budget, children):
    """Water level by bisection: each takes min(capacity, level * weight)."""
    low, high = 0.0, 1e15
    for _ in range(300):
        level = (low + high) / 2
        taken = sum(min(c, level * w) for w, c in children.values())
        low, high = (level, high) if taken < budget else (low, level)
    return {k: min(c, high * w) for k, (w, c) in children.items()}


@pytest.mark.parametrize("share", [0.1, 0.6, 1.5, 9.0])
def test_budgets(spark, share):
    chance = random.Random(5)
    leaves = {(d, l, s): chance.randint(0, 900) for d in ("web", "books", "none") for l in ("en", "fr") for s in "abcd"}
    weights = {"domain": {"web": 3.0, "none": 0.0}, "lang": {"en": 2.0}, "source": {"a": 5.0}}
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(frame, share, 2, weights).collect()}
    weight = lambda level, name: weights[level].get(name, 1.0)
    room = {k: 2.0 * v if k[0] != "none" else 0.0 for k, v in leaves.items()}
    part = lambda *names: sum(v for k, v in room.items() if k[: len(names)] == names)
    budget = min(share * sum(leaves.values()), part())
    expected = {}
    domains = fill(budget, {d: (weight("domain", d), part(d)) for d in ("web", "books", "none")})
    for d, b in domains.items():
        for lang, c in fill(b, {x: (weight("lang", x), part(d, x)) for x in ("en", "fr")}).items():
            for s, e in fill(c, {x: (weight("source", x), part(d, lang, x)) for x in "abcd"}).items():
                expected[d, lang, s] = e
    assert all(abs(got[k] - expected[k]) <= 1 for k in leaves)


def test_mix_odd_rows(spark, docs_of):
    docs = docs_of([None, "", "a b c", "d e"] + ["w " * 50] * 30).withColumn("lang", F.when(F.col("doc_id") != 2, F.col("lang")))
    docs = docs.unionByName(docs.limit(3))
    rows = mixing.mix(spark, docs, share=0.5, epochs=1).collect()
    assert len(rows) == 37 and sum(r.n_tokens * r.copies for r in rows) <= 0.5 * sum(r.n_tokens for r in rows)
    assert {r.lang for r in rows if r.doc_id == 2} == {"unknown"}
    assert mixing.mix(spark, docs.limit(0)).collect() == []
