"""spark-submit entry points: category load, rollup, report, v1 script, and upkeep of the rollup's versions.

Run through the root launcher (spark-submit runs a file), or ``python -m shelfcost.plans.jobs``:

    spark-submit run_job.py category --sources sources.json --out <path>
    spark-submit run_job.py rollup   --sources sources.json --target <path> [--month 2024-03-01] [--as-of ...]
    spark-submit run_job.py report   --sources sources.json --target <path> --type Region --location ASIA \\
                                     --start 2024-01-01 --end 2024-03-31 --out <path>
    spark-submit run_job.py v1       --sources sources.json --start 2021-06-01 --end 2021-07-01 --out <path>

    spark-submit run_job.py rollback --target <path> --version 7      (or: expire --target <path> --keep 3)

``sources.json`` maps each source name of :mod:`shelfcost.sources.schemas` to a
parquet path or a catalog table name. The session is built with the cluster
profile of :mod:`shelfcost.session`; ``--conf`` of the submitting environment
sets cluster resources. Checkpoints go to the session's
``spark.checkpoint.dir``, which must name a shared folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from shelfcost.functions.dates import Window
from shelfcost.operators import legacy, versions
from shelfcost.plans.monthly import run_category_load, run_rollup
from shelfcost.plans.report import run_report
from shelfcost.session import build_session
from shelfcost.sources.catalog import from_tables


def _date(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shelfcost")
    ap.add_argument("job", choices=["category", "rollup", "report", "v1", "rollback", "expire"])
    ap.add_argument("--sources", help="JSON file: source name -> path or table")
    ap.add_argument("--target", help="rollup table path")
    ap.add_argument("--out", help="output path (category table, report parquet)")
    ap.add_argument("--month", help="roll up only this month (any day in it)")
    ap.add_argument("--as-of", help="run date; defaults to today")
    ap.add_argument("--out-window-on", choices=["header", "event_time"], default="header",
                    help="outbound transfers: window on header time (default) or on line event time")
    ap.add_argument("--allow-rejects", action="store_true",
                    help="go on when rows have a NULL month or store (they are kept in the reject ledger of the target)")
    ap.add_argument("--version", type=int, help="rollback: the version to go back to")
    ap.add_argument("--keep", type=int, default=2, help="expire: versions to keep")
    ap.add_argument("--type", default="All Locations")
    ap.add_argument("--location")
    ap.add_argument("--start")
    ap.add_argument("--end")
    args = ap.parse_args(argv)

    spark = SparkSession.getActiveSession() or build_session("cluster", app_name=f"shelfcost-{args.job}")
    if args.job == "rollback":
        versions.rollback(spark, args.target, args.version)
        return
    if args.job == "expire":
        versions.expire(spark, args.target, args.keep)
        return
    with open(args.sources) as fh:
        src = from_tables(spark, json.load(fh))
    as_of = _date(args.as_of) or dt.date.today()

    if args.job == "category":
        run_category_load(src, args.out)
    elif args.job == "rollup":
        run_rollup(src, args.target, _date(args.month), as_of, args.out_window_on, args.allow_rejects)
    elif args.job == "v1":
        # the v1 script's window: start inclusive, end exclusive
        window = Window(_date(args.start), _date(args.end))
        legacy.v1_report(src, window).write.mode("overwrite").parquet(args.out)
    else:
        rows = run_report(src, args.target, args.type, args.location, _date(args.start), _date(args.end), as_of)
        rows.write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
