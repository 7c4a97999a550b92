"""The package reaches workers that don't have it, and folders are shared or refused."""

import os
import shutil
import subprocess
import sys

import pytest

from tapeworks import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
# Python workers do not get the driver's own search path.
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as contract
from tapeworks.session import build_session, prepare
from tapeworks.streaming import stateful
conf = {{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", **stateful.state_store_conf()}}
spark = build_session("local[2]", "elsewhere", **conf)
for name in ("leaky_bucket", "breaker_metrics"):
    print(name, contract.queries()[name](spark, "/root/testdata/sf0.001").count())
log = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 2 * 10**9, True)], "name string, seq long, ok boolean")
log.selectExpr("*", "timestamp_seconds(seq) as ts").write.parquet("log")
prepare(spark)
stream = stateful.breaker_stream(spark.readStream.schema("name string, seq long, ok boolean, ts timestamp").parquet("log"), 1, 60)
query = stream.writeStream.format("memory").queryName("told").option("checkpointLocation", "cp").trigger(availableNow=True).start()
query.awaitTermination(200)
print("stream", [tuple(r) for r in spark.table("told").orderBy("us").select("name", "seq", "result").collect()])
"""


def test_workers_need_no_installation(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240
    )
    assert "leaky_bucket 1000" in done.stdout and "breaker_metrics" in done.stdout, done.stderr[-2000:]
    assert "stream [('a', 1, 'failed'), ('a', 2, 'rejected')]" in done.stdout, done.stdout + done.stderr[-3000:]


def test_the_rest_needs_no_corpus_operators(tmp_path):
    """Without the corpus operators the entry point offers all other queries."""
    for name in ("tapeworks", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(REPO, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    script = "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op') and q[2].isdigit()], 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.split(maxsplit=1)[1:] == ["[] False\n"], done.stdout + done.stderr[-2000:]


class Elsewhere:
    """A session of a cluster that names no shared folder."""

    class conf:  # noqa: N801
        get = staticmethod(lambda name, default=None: default)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError):
        session.shared_dir(Elsewhere)
