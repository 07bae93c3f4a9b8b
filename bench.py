"""Headline queries timed on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. ``load_bronze`` is the load all other queries read from, timed
once. Every query runs twice: ``queries`` is the second run, ``first_run`` the
one that also compiles its code.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbflow import registry  # noqa: E402
from curbflow.plans import marts  # noqa: E402
from curbflow.session import local_session  # noqa: E402
from curbflow.workspace import Workspace  # noqa: E402

HEADLINE = [
    *marts.MARTS,
    "val_null_profile", "val_duplicate_rows", "qc_partition", "ods_count_checks",
    "kpi_summary", "zone_hour_wait", "deficit_window_select", "airport_trip_time",
    "reagg_quantile", "session_dedupe", "itt_summary", "geo_explode_polygons",
]


def run(df) -> None:
    """Compute every row without sending it anywhere."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "curbflow-bench")
    times: dict[str, float] = {}

    started = time.perf_counter()
    work = Workspace(spark, sf_dir)
    rows = work.trips().count()
    work.zones()
    times["load_bronze"] = time.perf_counter() - started

    first = {}
    for name in names:
        for kept in (first, times):
            started = time.perf_counter()
            run(registry.QUERIES[name](spark, sf_dir))
            kept[name] = time.perf_counter() - started

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_seconds", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "first_run": {k: round(v, 3) for k, v in first.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "trips": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
