"""End-to-end through the spark-submit entry points, reading real source tables from files."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import pytest

from shelfcost.operators import writer
from shelfcost.plans import jobs, registry
from shelfcost.plans.monthly import RejectedRows
from shelfcost.sources.schemas import REQUIRED_SOURCES
from tests.conftest import SF_SMALL


def test_category_rollup_report_jobs(spark, star_src):
    root = tempfile.mkdtemp(prefix="shelfcost-jobs-")
    paths = {}
    for name in REQUIRED_SOURCES:  # materialise every source as its own parquet table
        paths[name] = os.path.join(root, "src", name)
        star_src.table(name).write.parquet(paths[name])
    cfg = os.path.join(root, "sources.json")
    with open(cfg, "w") as fh:
        json.dump(paths, fh)
    target = os.path.join(root, "rollup")

    jobs.main(["category", "--sources", cfg, "--out", os.path.join(root, "category")])
    assert spark.read.parquet(os.path.join(root, "category")).count() == 20
    # the monthly flow: later jobs read the persisted category table
    paths["category_dim"] = os.path.join(root, "category")
    with open(cfg, "w") as fh:
        json.dump(paths, fh)

    rollup = ["rollup", "--sources", cfg, "--target", target, "--as-of", registry.AS_OF.isoformat()]
    with pytest.raises(RejectedRows):       # some facilities name no store
        jobs.main(rollup)
    rollup.append("--allow-rejects")
    jobs.main(rollup)
    expected = registry.QUERIES["rollup"](spark, SF_SMALL)
    got = writer.read_rollup(spark, target)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))

    # re-running one month is idempotent
    for _ in range(2):
        jobs.main([*rollup, "--month", "2000-03-01"])
    again = writer.read_rollup(spark, target)
    replaced = registry.QUERIES["rollup_replace_by_key"](spark, SF_SMALL)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, replaced.collect()))

    out = os.path.join(root, "report")
    jobs.main(["report", "--sources", cfg, "--target", target, "--type", "Region", "--location", "ASIA",
               "--start", "2000-01-01", "--end", "2000-06-30", "--out", out])
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 30 and {r.BusinessMonth for r in rows} == {dt.date(2000, m, 1) for m in range(1, 7)}


def test_v1_job(spark, star_src):
    root = tempfile.mkdtemp(prefix="shelfcost-v1-")
    paths = {}
    for name in REQUIRED_SOURCES:
        paths[name] = os.path.join(root, "src", name)
        star_src.table(name).write.parquet(paths[name])
    cfg = os.path.join(root, "sources.json")
    with open(cfg, "w") as fh:
        json.dump(paths, fh)
    out = os.path.join(root, "v1")
    w = registry.WINDOW
    jobs.main(["v1", "--sources", cfg, "--start", w.start.isoformat(), "--end", w.end.isoformat(), "--out", out])
    expected = registry.QUERIES["v1_report"](spark, SF_SMALL)
    assert set(map(tuple, spark.read.parquet(out).collect())) == set(map(tuple, expected.collect()))
