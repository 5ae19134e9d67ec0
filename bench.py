"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query is run to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  All queries run once to warm
the JVM, then three times timed; ``value`` is the sum over queries of the median
timed run and ``cold_total`` the sum of the first pass.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "classify_changes",
    "two_version_merge",
    "upsert_all",
    "cdc_scd1",
    "cdc_scd2_tracked",
    "cdc_scd2_hot_key",
    "stream_cdc_scd1",
    "expect_or_drop",
    "profile_table",
    "metrics_pivot",
    "publish_masked_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from tidemark.plans.all import QUERIES
    from tidemark.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="tidemark-bench")
    errors: dict[str, str] = {}

    def run(name: str) -> float | None:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - report, keep measuring the others
            errors[name] = str(e).splitlines()[0][:300]
            return None
        return round(time.perf_counter() - t0, 3)

    # first pass warms the JVM (class loading, JIT, code generation caches)
    cold = {name: run(name) for name in names}
    passes = [{name: run(name) for name in names if name not in errors} for _ in range(3)]
    times = {name: statistics.median(t for p in passes if (t := p.get(name)) is not None)
             for name in names if name not in errors}
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    result = {"metric": "total_query_time", "value": round(sum(v for v in times.values() if v), 3), "unit": "sec",
              "queries": times, "sf": sf, "cpus": int(cpus),
              "cold_total": round(sum(v for v in cold.values() if v), 3)}
    if errors:
        result["errors"] = errors
    print(json.dumps(result))


if __name__ == "__main__":
    main()
