"""Time the registered queries; prints one JSON line.

The headline is parse, route and count of raw frames, the work of the live
path; ``frames_per_second`` follows from it. Every query is written to a sink
that discards its rows, so that nothing is optimised away or collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapeworks.operators import intake  # noqa: E402
from tapeworks.plans import catalog, inputs  # noqa: E402
from tapeworks.session import build_session  # noqa: E402
from tapeworks.sources import readers, writers  # noqa: E402

HEADLINE = "streams_by_kind"
HEADLINE_RUNS = 3


def timed(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def text_to_text(spark, sf_dir: str) -> float:
    """Landed text read, parsed, routed, enveloped and written as messages."""
    inputs.frames(spark, sf_dir).select("raw").write.text(f"{sf_dir}/frames.txt")
    started = time.perf_counter()
    frames = readers.read_frames(spark, f"{sf_dir}/frames.txt")
    enveloped = intake.attach_envelope(intake.published(intake.classify(frames)))
    writers.write_messages(writers.to_messages(enveloped), f"{sf_dir}/messages.txt")
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    chosen = {n: q for n, (q, _) in catalog.QUERIES.items() if not only or n in only}
    # As on a cluster, the table lies in files that the cores can share.
    landed = tempfile.mkdtemp(prefix="bench-")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(int(cpus)).write.parquet(f"{landed}/events.parquet")
    frames = events.count()
    name, sf_dir = os.path.basename(os.path.normpath(sf_dir)), landed
    headline = catalog.QUERIES[HEADLINE][0]
    timed(headline, spark, sf_dir)
    best = min(timed(headline, spark, sf_dir) for _ in range(HEADLINE_RUNS))
    seconds = {}
    for query_name, query in chosen.items():
        timed(query, spark, sf_dir)  # plans, Python workers and compiled code are warm from here on
        seconds[query_name] = round(timed(query, spark, sf_dir), 3)
    seconds[HEADLINE] = round(best, 3)
    seconds["text_in_text_out"] = round(text_to_text(spark, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "parse_route_count_seconds",
                "value": round(best, 3),
                "unit": "sec",
                "frames_per_second": round(frames / best),
                "queries": seconds,
                "total_seconds": round(sum(seconds.values()), 3),
                "sf": name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
