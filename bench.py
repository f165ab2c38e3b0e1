"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is built and executed in full (``noop`` sink: every row and
column is computed, nothing is collected to the driver) once to warm up,
then ``$BENCH_REPEAT`` (default 3) times; the median is reported. The
timed span includes plan construction and any checkpoint the query
writes.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitrina.plans.catalog import QUERIES  # noqa: E402
from vitrina.plans.streams import STREAM_QUERIES  # noqa: E402
from vitrina.session import build_session  # noqa: E402

HEADLINE = [
    "clean_ventas",
    "clean_clientes",
    "clientes_cuarentena",
    "expectation_metrics",
    "scd1_ventas",
    "dim_cliente",
    "dim_tiempo",
    "fact_ventas",
    "fact_ventas_rechazadas",
    "union_rejects",
    "scd1_tiendas_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="vitrina-bench")
    queries = {**QUERIES, **STREAM_QUERIES}
    out = {}
    for name in names:
        # timed: building the plan (including any checkpoint it writes) and
        # running it to the end
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({
        "metric": "headline_queries_total_warm_median",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
