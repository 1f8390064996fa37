"""Signed deltas: state plus delta equals a full recompute, over random corrections of every fact table."""

from __future__ import annotations

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcost.functions.dates import Window
from shelfcost.operators import reach, versions, writer
from shelfcost.plans import incremental
from shelfcost.plans.monthly import build_rollup
from tests.edge import item, make_sources, money
from tests.test_reduction import _metric

D = dt.date
WINDOW = Window(D(2001, 4, 1), D(2001, 7, 1))
FACILITIES = [{"FacilityID": 1, "FacilityLocationNo": "00001"}, {"FacilityID": 2, "FacilityLocationNo": "00002"}, {"FacilityID": 3, "FacilityLocationNo": None}]
BOOKWORM_ITEM = "00000000000010222778"


def _facts(r: random.Random) -> dict[str, list[dict]]:
    day = lambda: D(2001, r.randint(3, 7), r.randint(1, 28))
    f: dict[str, list[dict]] = {n: [] for n in incremental.FACTS}
    for k in range(14):
        d, loc, txn = day(), r.randint(1, 2), f"1{k:09d}"
        f["sales_header"].append({"LocationID": loc, "BusinessDate": d, "SalesXactionID": txn, "Status": r.choice("AAV"), "XactionType": "S"})
        for n in range(r.randint(1, 3)):
            code = r.choice([item(1), item(2), item(3), BOOKWORM_ITEM])
            f["sales_item"].append({"LocationID": loc, "BusinessDate": d, "SalesXactionId": txn, "LineNumber": n, "ItemCode": code,
                                    "Quantity": r.randint(1, 3), "IsReturn": r.choice("YN"), "ExtendedAmt": money(r.randint(1, 9))})
            if code == BOOKWORM_ITEM:
                f["bookworm"].append({"locationId": loc, "tillnumber": "1", "transactionNumber": str(k), "detailNumber": n, "SKU": "1", "LocationNo": "00001"})
        shared = {"ISIS_OrderID": k, "FacilityID": r.randint(1, 3), "SKU": "D1", "ShipDate": day(), "OrderDate": day()}
        f["istore_orders"].append({**shared, "OrderStatus": r.choice(["Shipped", "New"]), "ShippedQuantity": r.randint(0, 2), "Price": money(4), "ShippingFee": money(1),
                                   "RefundDate": day(), "RefundAmount": money(r.randint(0, 2))})
        f["web_orders"].append({**shared, "MarketOrderID": "M", "MarketOrderItemID": 1, "OrderStatus": "Shipped", "ItemStatus": r.choice(["Shipped", "Open"]), "ShippingMethod": "1",
                                "Quantity": r.randint(1, 2), "ExtendedAmount": money(7), "ShippingAmount": money(2), "ItemRefundAmount": money(r.randint(0, 3)), "SiteLastModifiedDate": day()})
        for system in ("MON", "HMP"):
            order = 100 + r.randint(0, 9) if r.random() < 0.4 else 1000 + 10 * k + len(system)
            f["fulfil_header"].append({"OrderID": order, "ISISOrderID": k, "OrderSystem": system, "MarketOrderID": "M"})
            f["fulfil_detail"].append({"OrderID": order, "ItemCode": item(r.randint(1, 3)), "LocationNo": r.choice([None, "00002"]), "Status": r.choice([1, 4, 9]), "MarketOrderItemID": "1"})
        f["xfer_header"].append({"TransferBinNo": k, "LocationNo": r.choice(["00001", None]), "ToLocationNo": "00002", "TransferType": r.choice([1, 2, 3, 7]), "StatusCode": 3, "CreateTime": day()})
        f["xfer_detail"].append({"TransferBinNo": k, "DipsItemCode": item(r.randint(1, 3)), "Quantity": r.randint(1, 4), "DipsCost": money(2), "StatusCode": 1,
                                 "CreateTime": r.choice([None, day()]), "UpdateTime": r.choice([None, day()])})
    return f


def _corrected(r: random.Random, facts: dict[str, list[dict]]) -> dict[str, list[dict]]:
    """Rows dropped, changed and added in every table."""
    other = _facts(r)
    out = {}
    for n, rows in facts.items():
        rows = [dict(x) for x in rows if r.random() > 0.08]
        for x in rows:
            if r.random() < 0.1:
                y = r.choice(other[n])
                column = r.choice(sorted(y))
                x[column] = y[column]
        out[n] = rows + r.sample(other[n], min(2, len(other[n])))
    return out


def _sources(spark, facts):
    return make_sources(spark, facilities=FACILITIES, **facts)


def _set(df, columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_a_full_recompute(spark, seed):
    r = random.Random(seed)
    facts = _facts(r)
    old = _sources(spark, facts)
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-delta-"), "rollup")
    incremental.start(old, path, WINDOW, allow_rejects=True)
    for _ in range(2):
        facts = _corrected(r, facts)
        new = _sources(spark, facts)
        changes = incremental.between(old, new)
        run = incremental.apply_changes(new, path, changes, WINDOW, allow_rejects=True)
        full = build_rollup(new, WINDOW)
        columns = full.tidy.columns
        assert _set(incremental.read_state(new, path), columns) == _set(full.tidy, columns)
        assert _set(run.rollup, full.rollup.columns) == _set(full.rollup, full.rollup.columns)
        assert _set(writer.read_rejects(spark, path), columns) == _set(full.rejects, columns)
        kept = {(x.BusinessMonth, x.LocationNo): tuple(x) for x in writer.read_rollup(spark, path).collect()}
        assert all(kept[x.BusinessMonth, x.LocationNo] == tuple(x) for x in full.rollup.collect())
        old = new


def test_only_changed_documents_are_read(spark):
    r = random.Random(5)
    facts = _facts(r)
    old = _sources(spark, facts)
    more = {n: [dict(x) for x in rows] for n, rows in facts.items()}
    more["fulfil_detail"][3]["Status"] = 4 if more["fulfil_detail"][3]["Status"] != 4 else 1
    changes = incremental.between(old, _sources(spark, more))
    order = more["fulfil_detail"][3]["OrderID"]
    orders = {h["ISISOrderID"] for h in facts["fulfil_header"] if h["OrderID"] == order}
    assert {x.ISIS_OrderID for x in changes.after["web_orders"].collect()} == orders
    assert changes.after["sales_item"].count() == changes.after["xfer_detail"].count() == 0
    assert changes.before["fulfil_detail"].count() == changes.after["fulfil_detail"].count() < len(facts["fulfil_detail"])


def test_no_change_no_delta_and_no_state_is_an_error(spark):
    old = _sources(spark, _facts(random.Random(7)))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-delta-"), "rollup")
    nothing = incremental.Changes({}, {})
    with pytest.raises(ValueError, match="start first"):
        incremental.apply_changes(old, path, nothing, WINDOW)
    incremental.start(old, path, WINDOW, allow_rejects=True)
    before = versions.load(spark, path).tables[incremental.STATE_TABLE]
    assert incremental.delta(old, incremental.between(old, old), WINDOW).count() == 0
    incremental.apply_changes(old, path, nothing, WINDOW, allow_rejects=True)
    assert versions.load(spark, path).tables[incremental.STATE_TABLE] == before   # no month of the state was rewritten


def _snapshots(spark, changed: int):
    """Two snapshots of 3,000 documents of two lines, in some of which one line differs."""
    def lines(salt):
        return spark.range(6000).selectExpr("cast(id % 3000 as int) as doc", f"case when id < {changed} then id + {salt} else id end as v", "id as line")
    return lines(0), lines(1)


@pytest.mark.parametrize("changed", [0, 1, 20, 3000])
def test_only_buckets_with_changes_are_compared_by_document(spark, monkeypatch, changed):
    monkeypatch.setattr(incremental, "BUCKETS", 64)
    old, new = _snapshots(spark, changed)
    found = incremental._differing(old, new, {"Doc": F.col("doc")})
    assert sorted(r["Doc"] for r in found.collect()) == list(range(changed))
    documents = sum(_metric(found, "Exchange", "shuffleRecordsWritten").values())
    assert documents <= 2 * 2 * 3000 * changed // 64


def test_images_of_few_changes_are_few_and_unchanged_ones_cancel(spark, monkeypatch):
    """One changed transaction; with a bitmap of 64 bits unchanged documents come along, the delta is the same."""
    r = random.Random(5)
    facts = _facts(r)
    after = {n: [dict(x) for x in rows] for n, rows in facts.items()}
    after["sales_item"][0]["Quantity"] += 1
    old, new = (make_sources(spark, facilities=FACILITIES, **f) for f in (facts, after))
    few = incremental.between(old, new)
    assert few.before["sales_item"].count() <= 3 and few.before["fulfil_detail"].count() == 0 == few.after["xfer_detail"].count()
    want = sorted(map(str, incremental.delta(new, few, WINDOW).collect()))
    monkeypatch.setattr(reach, "BITS", 64)
    many = incremental.between(old, new)
    assert many.before["sales_item"].count() >= few.before["sales_item"].count()
    assert sorted(map(str, incremental.delta(new, many, WINDOW).collect())) == want
