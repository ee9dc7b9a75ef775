"""Benchmark the headline workloads; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (full execution,
nothing collected).  The fixed-width input is written once, untimed, and
then parsed in the timed step.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fixreg.plans import driver_queries as Q  # noqa: E402
from fixreg.plans import driver_views as V  # noqa: E402
from fixreg.session import local_session, scratch_path  # noqa: E402
from fixreg.sources.fixed_width import read_fixed_width  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="fixreg-bench")

    # Untimed: orders as fixed-width text (the register's input format).
    fwf_dir = scratch_path(spark, "bench-fwf")
    V.table(spark, sf_dir, "orders").selectExpr(f"{Q.ORDERS_LINE} AS value").write.text(fwf_dir)

    def workloads(d: str, fwf: str):
        return {
            "fwf_parse_orders": lambda: read_fixed_width(spark, fwf, Q.ORDERS_LAYOUT),
            "enriched_enrolments": lambda: Q.enriched_enrolments(spark, d),
            "cohort_full": lambda: Q.cohort_full(spark, d),
            "feed_report": lambda: Q.feed_report_query(spark, d),
            "sink_parquet": lambda: Q.sink_parquet(spark, d),
            "exam_grades_last_attempt": lambda: Q.exam_grades(spark, d),
            "pseudonymise_permute": lambda: Q.pseudonymise_two_tables(spark, d),
            "pseudonymise_hash": lambda: Q.pseudonymise_hash(spark, d),
            "lookup_join_checked": lambda: Q.lookup_join_checked(spark, d),
        }

    # Warm-up on the smallest tables (untimed): JVM class loading and code
    # generation, so the timings below measure the data work.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        warm_fwf = scratch_path(spark, "bench-warm")
        V.table(spark, warm_dir, "orders").selectExpr(f"{Q.ORDERS_LINE} AS value").write.text(warm_fwf)
        for build in workloads(warm_dir, warm_fwf).values():
            run(build())
    run(V.table(spark, sf_dir, "orders").select(F.count(F.lit(1))))

    times, rows = {}, {}
    for name, build in workloads(sf_dir, fwf_dir).items():
        t0 = time.perf_counter()
        seen = Observation()
        run(build().observe(seen, F.count(F.lit(1)).alias("rows")))
        times[name] = round(time.perf_counter() - t0, 3)
        rows[name] = seen.get["rows"]
    total = round(sum(times.values()), 3)
    fwf_rows = spark.read.text(fwf_dir).count()
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "fwf_parse_rows_per_sec": round(fwf_rows / times["fwf_parse_orders"]) if times["fwf_parse_orders"] else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
