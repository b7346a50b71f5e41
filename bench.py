"""Times the headline queries on a loaded warehouse.

Prints one JSON line. ``queries`` holds the second run of each query, when
generated code has been compiled; ``first_run`` holds the first. ``load`` is the
derivation and write of each table, once. ``value`` is the sum of ``queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import CHECKS
from plandrift import schemas as S
from plandrift.session import local_session
from plandrift.sources.fixture import Fixture

HEADLINE = [
    "r4_slowest_queries", "v8_fact_top_queries", "m5_merge_runtime_stats",
    "m7_detect_regressions", "r5_cpu_consumers", "r14_tenant_performance_all_time",
    "k_all_runtime_measures", "k53_executive_bundle", "k33_duration_rank", "w3_ytd",
    "r12_plan_instability", "m11_cleanup_report", "m8_flag_regressions", "j17_star",
    "r25_duration_trend", "f5_report_slicers", "m12_cleanup_applied", "m10_load_job", "r34_incremental_refresh",
]


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus)
    fixture = Fixture(spark, data_dir)
    load: dict[str, float] = {}
    first_run: dict[str, float] = {}
    queries: dict[str, float] = {}

    def timed(into, name, action) -> None:
        started = time.perf_counter()
        action()
        into[name] = round(time.perf_counter() - started, 3)

    # Start-up cost of the session is not part of any query.
    fixture.read_source("lineitem").count()
    for table in (S.RUNTIME, *[t for t in S.TABLES.values() if t is not S.RUNTIME]):
        timed(load, table.name, lambda t=table: fixture.table(t))
    for into in (first_run, queries):
        for name in HEADLINE:
            # The noop sink computes every row and column without collecting them.
            timed(into, name, lambda n=name: CHECKS[n].run(spark, data_dir)
                  .write.format("noop").mode("overwrite").save())
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(queries.values()), 3),
        "unit": "sec", "queries": queries, "first_run": first_run, "load": load,
        "sf": os.path.basename(data_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    sys.exit(main())
