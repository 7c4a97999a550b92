"""Run registered queries beside their SQL: python tests/llm/compare.py SF NAME..."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as contract  # noqa: E402
from tapeworks.session import build_session  # noqa: E402

TABLES = "documents pages labels benchmark conversations events".split()


def against_sql(spark, name, sf_dir):
    """The rows only one side has: (Spark's, SQL's)."""
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    relation = duck.sql(contract.oracle_sql()[name])
    frame = contract.queries()[name](spark, sf_dir)
    assert sorted(frame.columns) == sorted(relation.columns)
    columns = sorted(frame.columns)
    ours = sorted(tuple(map(str, row)) for row in frame.select(columns).collect())
    theirs = sorted(tuple(map(str, row)) for row in relation.select(*[f'"{c}"' for c in columns]).fetchall())
    return sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours)), len(ours), len(theirs)


if __name__ == "__main__":
    session = build_session(
        "local[8]", "compare", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    for query in sys.argv[2:]:
        began = time.time()
        if query in contract.oracle_sql():
            left, right, n, m = against_sql(session, query, sys.argv[1])
            print(query, n, m, len(left), len(right), left[:3], right[:3])
        else:
            frame = contract.queries()[query](session, sys.argv[1])
            frame.show(8, 60)
            print(query, frame.count(), frame.columns)
        print("seconds", round(time.time() - began, 1))
