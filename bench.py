"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed into Spark's ``noop`` sink (nothing is
collected to the driver).  Per query the median of $BENCH_RUNS warm runs is
reported; one JSON line is printed at the end.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default: all).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans import QUERIES  # noqa: E402
from lodestar.session import build_session, use_checkpoint_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(QUERIES)
    # spark.checkpoint.dir comes from the Spark configuration; a folder of this machine only if that has none
    spark = build_session(f"local[{cpus}]", app_name="lodestar-bench", shuffle_partitions=cpus * 2,
                          extra_conf={"spark.driver.memory": "16g"})
    use_checkpoint_dir(spark, lambda: tempfile.mkdtemp(prefix="lodestar-bench-"))
    # warm the JVM, parquet readers and Python workers once
    QUERIES["count_rows"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        samples = []
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(samples), 3)
        except Exception as exc:  # keep going; report the failure
            errors[name] = repr(exc)[:300]
        print(f"# {name}: {timings.get(name, 'ERROR')}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "total_median_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "runs": runs,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
