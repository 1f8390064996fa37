"""A short run reads and shuffles fulfilment rows only near its own orders."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from shelfcost.functions.dates import Window
from shelfcost.operators import sales
from shelfcost.sources.catalog import from_tables
from tests.edge import item, make_sources, money
from tests.test_plans import plan

D = dt.date
MONTHS = 12


def _tables(spark, root):
    orders, heads, lines = [], [], []
    for k in range(1200):
        day = D(2001, 1 + k * MONTHS // 1200, 1 + k % 28)
        orders.append({"ISIS_OrderID": k, "FacilityID": 1, "SKU": "D1", "OrderStatus": "Shipped", "ShippedQuantity": 1, "Price": money(4), "ShippingFee": money(1),
                       "ShipDate": day, "OrderDate": day, "RefundDate": None, "RefundAmount": money(0)})
        heads.append({"OrderID": 5000 + k, "ISISOrderID": k, "OrderSystem": "MON", "MarketOrderID": "M"})
        lines.append({"OrderID": 5000 + k, "ItemCode": item(1), "LocationNo": None, "Status": 1, "MarketOrderItemID": "1"})
    src = make_sources(spark, istore_orders=orders, fulfil_header=heads, fulfil_detail=lines)
    paths = {}
    for n in src.names():
        paths[n] = os.path.join(root, n)
        df = src.table(n)
        if n.startswith("fulfil"):
            df = df.repartitionByRange(MONTHS, "OrderID").sortWithinPartitions("OrderID")
        df.write.parquet(paths[n])
    return from_tables(spark, paths)


def _metric(df, name: str, metric: str) -> dict[str, int]:
    """Sum of a metric by node of the executed plan."""
    out: dict[str, int] = {}
    plan_ = df._jdf.queryExecution().executedPlan()
    todo = [plan_]
    while todo:
        node = todo.pop()
        kind = node.nodeName()
        if kind.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in kind:
            todo.append(node.plan())
        if kind.startswith(name):
            text = node.simpleString(200)
            value = node.metrics().get(metric)
            if value.isDefined():
                out[text] = out.get(text, 0) + value.get().value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return out


def test_fulfilment_rows_fall_with_the_window(spark, monkeypatch):
    src = _tables(spark, tempfile.mkdtemp(prefix="shelfcost-near-"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    try:
        read, shuffled, rows = {}, {}, {}
        for months in (0, 1, 3):
            monkeypatch.setattr(sales, "NEAR_MONTHS", 3 if months else 0)
            df = sales.online_sales(src, Window(D(2001, 5, 1), D(2001, 5 + max(months, 1), 1)), web=())
            rows[months] = sorted(map(tuple, df.collect()))
            read[months] = sum(v for k, v in _metric(df, "Scan parquet", "numOutputRows").items() if "OrderSystem" in k or "ProblemStatusID" in k)
            shuffled[months] = sum(_metric(df, "Exchange", "shuffleRecordsWritten").values())
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.optimizer.runtime.bloomFilter.enabled"):
            spark.conf.unset(key)
    assert rows[0] == rows[1] and len(rows[1]) == 1
    assert read[0] == 2400 and read[1] <= 2400 // 4 and read[1] < read[3] <= 2400 // 2
    assert shuffled[1] < shuffled[0] // 4


def test_bounds_reach_the_scans(spark):
    src = _tables(spark, tempfile.mkdtemp(prefix="shelfcost-near-"))
    text = plan(sales.online_sales(src, Window(D(2001, 5, 1), D(2001, 6, 1)), web=()))
    assert "GreaterThanOrEqual(ISISOrderID,400)" in text and "GreaterThanOrEqual(OrderID,5400)" in text
    assert "GreaterThanOrEqual(ISISOrderID" not in plan(sales.online_sales(src, Window(D(2001, 1, 1), D(2002, 1, 1)), web=()))


def test_no_orders_no_rows(spark):
    src = _tables(spark, tempfile.mkdtemp(prefix="shelfcost-near-"))
    assert sales.online_sales(src, Window(D(2010, 5, 1), D(2010, 6, 1))).count() == 0
