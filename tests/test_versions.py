"""Versioned rollup and reject ledger: atomic commits, rollback, snapshots, store pruning."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcost.functions.dates import Window
from shelfcost.operators import report, transfers, versions, writer
from shelfcost.plans.monthly import build_rollup, run_rollup
from shelfcost.sources.schemas import ROLLUP
from tests.edge import make_sources, money
from tests.test_plans import plan

D = dt.date
KEYS = ("BusinessMonth", "LocationNo")


def _path() -> str:
    return os.path.join(tempfile.mkdtemp(prefix="shelfcost-versions-"), "rollup")


def _rows(spark, keys, value: int):
    zero = {f.name: F.lit(0).cast(f.dataType) for f in ROLLUP.fields if f.name not in KEYS}
    df = spark.createDataFrame(keys, "BusinessMonth date, LocationNo string")
    return df.select("*", *[(F.lit(value).cast(ROLLUP[n].dataType) if n == "DistSoldCost" else c).alias(n) for n, c in zero.items()])


def _held(spark, path, version=None):
    return {(r.BusinessMonth, r.LocationNo): int(r.DistSoldCost) for r in writer.read_rollup(spark, path, version).collect()}


MAY, JUNE, JULY = D(2001, 5, 1), D(2001, 6, 1), D(2001, 7, 1)


class Killed(BaseException):
    """Stands for a driver that dies: no handler may catch it."""


@pytest.mark.parametrize("step", ["stage", "staged", "rejects", "version file", "publish", "after"])
def test_a_job_killed_at_any_step_leaves_a_whole_table(spark, monkeypatch, step):
    path = _path()
    old = _rows(spark, [(MAY, "1"), (MAY, "2"), (JUNE, "1")], 1)
    rejects = spark.createDataFrame([("sales", MAY, MAY, None, 2, "dist", 1, money(1), money(1), money(0))], writer.REJECTS)
    window = Window(MAY, JULY)
    writer.replace_by_key(spark, path, old, old, rejects, window)
    before, ledger = _held(spark, path), writer.read_rejects(spark, path).count()
    new = _rows(spark, [(MAY, "1"), (JUNE, "3"), (JULY, "1")], 2)
    reader = writer.read_rollup(spark, path)                      # resolved before the second job

    def die(*a, **k):
        raise Killed

    staged = versions.stage

    def stage(df, p, table, *a):
        if step == "stage" or (step == "rejects" and table == writer.REJECT_TABLE):
            raise Killed
        return staged(df, p, table, *a)

    published = versions._publish

    def publish(*a):
        if step == "after":
            published(*a)
        raise Killed

    monkeypatch.setattr(versions, "stage", stage)
    monkeypatch.setattr(writer.quality, "enforce_key", die if step == "staged" else writer.quality.enforce_key)
    monkeypatch.setattr(versions, "commit", die if step == "version file" else versions.commit)
    if step in ("publish", "after"):
        monkeypatch.setattr(versions, "_publish", publish)
    with pytest.raises(Killed):
        writer.replace_by_key(spark, path, new, new, rejects.limit(0), window)
    monkeypatch.undo()
    after = {**before, (MAY, "1"): 2, (JUNE, "3"): 2, (JULY, "1"): 2}
    assert _held(spark, path) == (after if step == "after" else before)
    assert writer.read_rejects(spark, path).count() == (0 if step == "after" else ledger)
    assert reader.count() == len(before)                          # a reader keeps its version
    writer.replace_by_key(spark, path, new, new, rejects.limit(0), window)
    assert _held(spark, path) == after and writer.read_rejects(spark, path).count() == 0


def test_rollback_conflict_and_expiry(spark):
    path = _path()
    for k, keys in enumerate(([(MAY, "1")], [(MAY, "1"), (JUNE, "1")], [(JUNE, "2")]), 1):
        rows = _rows(spark, keys, k)
        writer.replace_by_key(spark, path, rows, rows)
    assert versions.numbers(spark, path) == [1, 2, 3]
    second = _held(spark, path, versions.load(spark, path, 2))
    assert second == {(MAY, "1"): 2, (JUNE, "1"): 2}
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, versions.load(spark, path, 2), {})
    versions.rollback(spark, path, 2)
    assert _held(spark, path) == second and versions.numbers(spark, path) == [1, 2, 3, 4]
    versions.expire(spark, path, keep=1)
    assert _held(spark, path) == second and versions.numbers(spark, path) == [4]
    folders = [f for f in os.listdir(f"{path}/rollup") if f.startswith("run=")]
    assert len(folders) == 1                                      # both months are of the second run
    writer.create_table(spark, path)
    assert _held(spark, path) == {} and writer.table_exists(spark, path)


def _orders(spark, n_may: int, n_june: int):
    """Web orders without any store: rejects in May and June; and one with a store."""
    orders, heads, lines = [], [], []
    for i in range(n_may + n_june + 1):
        day = D(2001, 5, 3) if i < n_may else D(2001, 6, 3)
        fac = 1 if i == n_may + n_june else 3
        orders.append({"ISIS_OrderID": i, "MarketOrderID": "M", "MarketOrderItemID": i, "FacilityID": fac, "OrderStatus": "x", "ItemStatus": "Shipped",
                       "ShippingMethod": "1", "Quantity": 1, "ExtendedAmount": money(3), "ShippingAmount": money(1), "ItemRefundAmount": money(0),
                       "ShipDate": day, "SiteLastModifiedDate": None, "OrderDate": day, "SKU": "D1"})
        heads.append({"OrderID": 100 + i, "ISISOrderID": i, "OrderSystem": "HMP", "MarketOrderID": "M"})
        lines.append({"OrderID": 100 + i, "ItemCode": f"{1:020d}", "LocationNo": None, "Status": 1, "MarketOrderItemID": str(i)})
    bins = [{"TransferBinNo": 1, "LocationNo": None, "ToLocationNo": "00002", "TransferType": 3, "StatusCode": 3, "CreateTime": D(2001, 5, 10)}]
    moved = [{"TransferBinNo": 1, "DipsItemCode": f"{1:020d}", "Quantity": 2, "DipsCost": money(5), "StatusCode": 1, "CreateTime": D(2001, 5, 10), "UpdateTime": D(2001, 6, 2)}]
    facilities = [{"FacilityID": 1, "FacilityLocationNo": "00001"}, {"FacilityID": 3, "FacilityLocationNo": None}]
    return make_sources(spark, web_orders=orders, fulfil_header=heads, fulfil_detail=lines, facilities=facilities, xfer_header=bins, xfer_detail=moved)


def test_ledger_keeps_the_rejects_of_other_months(spark):
    path = _path()
    run_rollup(_orders(spark, 2, 3), path, None, D(2001, 8, 1), allow_rejects=True)

    def ledger():
        return {(r.Source, r.RunMonth, r.BusinessMonth): r.Qty for r in writer.read_rejects(spark, path).collect()}

    # the transfer's sender is unknown; its line is June's, but it was read in the header's month, May
    want = {("sales", MAY, MAY): 2, ("sales", JUNE, JUNE): 3, ("xfers", MAY, JUNE): 2}
    assert ledger() == want
    src = _orders(spark, 5, 3)                                    # more of May's orders come to light
    run = run_rollup(src, path, MAY, D(2001, 8, 1), allow_rejects=True)
    assert ledger() == {**want, ("sales", MAY, MAY): 5}
    run_rollup(_orders(spark, 0, 3), path, MAY, D(2001, 8, 1), allow_rejects=True)
    assert ledger() == {k: v for k, v in want.items() if k != ("sales", MAY, MAY)}
    run_rollup(src, path, MAY, D(2001, 8, 1), allow_rejects=True)
    # rollup and ledger together are the tidy rows of both runs: of the full run outside May, of the last one in May
    full = build_rollup(src, Window(D(1998, 1, 1), D(2001, 8, 1)))
    value = sum(r.DistOnlineSoldVal for r in writer.read_rollup(spark, path).collect()) + sum(r.Val or 0 for r in writer.read_rejects(spark, path).collect())
    assert value == sum(r.Val or 0 for r in full.tidy.collect()) and run.rejects.count() == 2


def test_run_month_splits_no_good_row(spark, star_src):
    from shelfcost.plans.registry import WINDOW

    plain = transfers.xfers_tidy(star_src, WINDOW)
    marked = transfers.transfers(star_src, WINDOW, run_month=True).drop("RunMonth")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, marked.collect()))


def test_months_are_read_from_the_version_file(spark, star_src):
    from shelfcost.plans import registry
    from shelfcost.plans.report import report_months

    text = plan(report_months(star_src, registry._persisted(star_src), registry.AS_OF))
    assert "parquet" not in text.lower()


def _scanned(df) -> int:
    """Rows that came out of the Parquet scan."""
    df.collect()
    plan_ = df._jdf.queryExecution().executedPlan()
    plan_ = plan_.executedPlan() if hasattr(plan_, "executedPlan") else plan_
    todo, rows = [plan_], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Scan parquet"):
            rows += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return rows


def test_a_store_report_skips_row_groups(spark, monkeypatch):
    monkeypatch.setattr(writer, "ROW_GROUP_BYTES", 16 << 10)
    path = _path()
    stores = [f"{k:05d}" for k in range(6000)]
    rows = _rows(spark, [(MAY, s) for s in stores], 1).withColumn("DistSoldVal", (F.xxhash64("LocationNo") % 100000).cast("decimal(19,4)"))
    rows = rows.select(*ROLLUP.fieldNames())
    writer.replace_by_key(spark, path, rows, rows)
    locations = [{"LocationID": k, "LocationNo": s, "Name": "N", "RetailStore": "Y", "Status": "A", "DistrictCode": "D1"} for k, s in enumerate(stores)]
    src = make_sources(spark, locations=locations)
    one, every = report.select_locations(src, "Store", "00100"), report.select_locations(src, "All Locations", None)
    held = writer.read_rollup(spark, path)
    args = (MAY, MAY)
    near = report.report(report.near_stores(held, one), one, *args)
    assert [r.LocationNo for r in near.collect()] == ["00100"]
    assert _scanned(near) < 3000 < 6000 <= _scanned(report.report(held, every, *args))
    none = report.select_locations(src, "Store", "no such store")
    assert report.report(report.near_stores(held, none), none, *args).count() == 0
