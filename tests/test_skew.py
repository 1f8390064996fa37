"""Hot keys: one item, one store and one transfer bin each carry a large share of rows.

AQE skew splitting is forced on with tiny thresholds and broadcasts are
disabled, so the pre-aggregated, shuffle-joined plan with split partitions
is really exercised; results must equal a line-level brute force.
"""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfcost.functions.dates import Window, month_bucket
from shelfcost.operators import sales, transfers
from tests.edge import D, item, make_sources, money

W = Window(D(2001, 1, 1), D(2001, 4, 1))
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _world(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    headers, lines = [], []
    for t in range(n):
        loc = 1 if t % 3 == 0 else 2                      # store 1: a third of transactions
        day = D(2001, 1 + t % 3, 1 + t % 28)
        xid = f"{t:011d}"
        headers.append({"LocationID": loc, "BusinessDate": day, "SalesXactionID": xid, "Status": "A",
                        "XactionType": "S"})
        for ln in range(1, 3):
            code = item(1) if rnd.random() < 0.34 else item(rnd.choice([2, 3, 6]))  # item 1: a third of lines
            ret = rnd.random() < 0.1
            q = rnd.randint(1, 5)
            lines.append({"LocationID": loc, "BusinessDate": day, "SalesXactionId": xid, "LineNumber": ln,
                          "ItemCode": code, "Quantity": q, "IsReturn": "Y" if ret else "N",
                          "ExtendedAmt": money((-1 if ret else 1) * q * 3.5)})
    bins, bin_lines = [], []
    for b in range(200):
        bins.append({"TransferBinNo": b, "LocationNo": "00001", "ToLocationNo": "00002",
                     "TransferType": [1, 2, 3, 7][b % 4], "StatusCode": 3, "CreateTime": D(2001, 2, 1)})
        for k in range(400 if b == 0 else 3):              # bin 0 holds most lines
            bin_lines.append({"TransferBinNo": b, "DipsItemCode": item(1 + k % 3), "Quantity": 1 + k % 4,
                              "DipsCost": money(2.25), "StatusCode": 1, "CreateTime": D(2001, 2, 1),
                              "UpdateTime": D(2001, 3, 1) if k % 2 else None})
    return make_sources(spark, sales_header=headers, sales_item=lines, xfer_header=bins, xfer_detail=bin_lines)


def test_register_under_hot_item_and_store(spark, skewed):
    src = _world(spark)
    got = sorted(map(tuple, sales.sales_register(src, W).select(
        "BusinessMonth", "LocationNo", "PrCat", "Qty", "Cost", "Val").collect()))
    # brute force on the driver from the raw rows (tiny fixture)
    items = {r.ItemCode: r for r in src.product_master.collect()}
    cats = {r.ProductType: r for r in __import__("shelfcost.operators.dims", fromlist=["x"]).category_dim(src).collect()}
    stores = {r.LocationID: r.LocationNo for r in src.locations.collect()}
    acc = {}
    for ln in src.sales_item.collect():
        p = items.get(ln.ItemCode)
        c = cats.get(p.ProductType) if p else None
        if c is None or c.PTypeClass != "NEW" or c.PTypeCategory == "gc":
            continue
        s = -1 if ln.IsReturn == "Y" else 1
        key = (ln.BusinessDate.replace(day=1), stores[ln.LocationID], c.PTypeCategory)
        q, cost, val = acc.get(key, (0, 0, 0))
        acc[key] = (q + ln.Quantity * s, cost + ln.Quantity * p.Cost * s, val + ln.ExtendedAmt)
    want = sorted((k[0], k[1], k[2], v[0], money(v[1]), money(v[2])) for k, v in acc.items())
    assert got == want


def test_transfers_under_hot_bin(spark, skewed):
    src = _world(spark)
    got = transfers.xfers_tidy(src, W)
    lines = src.xfer_detail.join(src.xfer_header.drop("CreateTime"), "TransferBinNo")
    total = lines.agg(F.sum("Quantity")).first()[0]
    # every line is NEW goods in this world (items 1-3), so tidy quantities add up to the lines: out + in
    assert got.agg(F.sum("Qty")).first()[0] == 2 * total
    assert got.where(F.col("BusinessMonth").isNull()).count() == 0
    assert set(r[0] for r in got.select(month_bucket(F.col("BusinessMonth"))).collect()) == {D(2001, 2, 1), D(2001, 3, 1)}
