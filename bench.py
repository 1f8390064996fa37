"""Benchmark the headline queries.

Runs each headline query from ``shelfcost.plans.registry`` over the star tables
in ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line::

    {"metric": "headline_total", "value": <sum of seconds>, "unit": "sec",
     "queries": {"rollup": sec, ...}, "sf": "0.1"}

Every query is fully computed into Spark's ``noop`` sink (no collect to the
driver), timed from plan construction to the end of execution. An untimed
warm-up runs the rollup once on the tiny sf0.001 tables first, so JVM class
loading and code generation are not charged to whichever query runs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from shelfcost.plans.registry import QUERIES  # noqa: E402
from shelfcost.session import build_session  # noqa: E402

HEADLINE = (
    "category_dim",
    "sales_tidy",
    "xfers_tidy",
    "rollup",
    "report_all_locations",
    "rollup_replace_by_key",
    "v1_report",
)


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    run(spark, "rollup", warm_dir if os.path.isdir(warm_dir) else sf_dir)  # warm-up, untimed
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": m.group(1) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
