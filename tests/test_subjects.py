"""A table of subject patterns matches what the patterns match one by one."""

import random

from tapeworks.sources import readers


def test_table_equals_the_list(spark):
    chance = random.Random(3)
    word = lambda extra: chance.choice(["a", "b", "cc", "", *extra])
    patterns = {".".join(chance.choice(["a", "b", "cc", "*", "*"]) for _ in range(chance.randint(1, 4))) for _ in range(60)}
    patterns |= {p + ".>" for p in list(patterns)[::2]} | {">", "*", "a", "*.>", "a.*.>", "x+.y"}
    subjects = sorted({".".join(word(["x+", "y", "*"]) for _ in range(chance.randint(1, 5))) for _ in range(300)}) + [None, "", ".", "x+.y", "xx.y"]
    made = spark.createDataFrame([(i, s, '{"k": 1}' if i % 2 else "no json") for i, s in enumerate(subjects)], "id long, subject string, value string")
    table = spark.createDataFrame([(p,) for p in [*patterns, *patterns, None]], "wanted string")
    got = readers.subscribe_table(made, table, "wanted")
    expected = readers.subscribe(made.where("subject is not null"), sorted(patterns))
    assert got.columns == expected.columns
    rows = lambda df: sorted((r.id, r.pattern, r.text, str(r.data)) for r in df.collect())
    assert rows(got) == rows(expected) and got.count() > 500
    assert readers.subscribe_table(made, table.limit(0), "wanted").count() == 0


def test_many_patterns_are_one_join(spark):
    """A hundred thousand patterns of three shapes: a message is tried against the shapes."""
    table = spark.range(100_000).selectExpr("concat('t', id, case when id % 3 = 0 then '.*' when id % 3 = 1 then '.>' else '' end) as pattern")
    made = spark.createDataFrame([(f"t{i}{tail}", "v") for i in range(9) for tail in ("", ".u", ".u.v")], "subject string, value string")
    found = sorted((r.subject, r.pattern) for r in readers.subscribe_table(made, table).collect())
    expected = [(f"t{i}.u", f"t{i}.*") for i in (0, 3, 6)] + [(f"t{i}.u{v}", f"t{i}.>") for i in (1, 4, 7) for v in ("", ".v")] + [(f"t{i}", f"t{i}") for i in (2, 5, 8)]
    assert found == sorted(expected)
