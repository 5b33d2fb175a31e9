"""Benchmark: run every registered query at one scale and print one JSON line.

Each query is fully executed into Spark's ``noop`` sink (no rows pulled to
the driver), ``BENCH_REPEAT`` times (default 2); ``queries`` holds the
fastest run of each (the host's load varies a lot between runs) and
``first_run_total`` the sum of the first runs.  Env: ``BENCH_SF_DIR``
(default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_QUERIES`` (comma list, default all).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkloom.plans.queries import QUERIES  # noqa: E402
from linkloom.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": "16g"}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), extra=extra)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-bench-"))
    # warm-up: JVM, Python workers, Arrow (a pandas UDF over the page URLs)
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    @F.pandas_udf(T.LongType())
    def _warm(s):
        return s.str.len()
    spark.read.parquet(f"{sf_dir}/pages.parquet").select(_warm("url").alias("n")) \
        .write.format("noop").mode("overwrite").save()
    QUERIES["page_hash"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if wanted and name not in wanted:
            continue
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        first[name] = runs[0]
        times[name] = round(min(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "first_run_total": round(sum(first.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
