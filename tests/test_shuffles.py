"""Lines are shuffled once per join they need: by their transaction and by their item; the star's joined lines are made once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.dates import Window
from shelfcost.operators import sales, transfers
from shelfcost.operators.dims import products_categorised
from shelfcost.sources.catalog import from_star
from tests.conftest import SF_SMALL
from tests.edge import D, item, make_sources, money
from tests.test_plans import plan
from tests.test_reduction import _metric

W = Window(D(2001, 1, 1), D(2001, 4, 1))
N = 600
OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def no_broadcast(spark):
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield
    for k in OFF:
        spark.conf.unset(k)


def _world(spark, spread=False):
    """A transaction per three lines, with ``spread`` each of its own item; its id comes again on another day, and some Bookworm orders come twice."""
    heads, lines, orders, bins, moved = [], [], [], [], []
    for t in range(N // 3):
        xid = f"01{t // 2:09d}"
        day = D(2001, 1 + t % 3, 1 + t % 2)
        heads.append({"LocationID": 1, "BusinessDate": day, "SalesXactionID": xid, "Status": "A" if t % 7 else "V", "XactionType": "S"})
        for ln in range(1, 4):
            placeholder = ln == 1 and t % 5 == 0
            lines.append({"LocationID": 1, "BusinessDate": day, "SalesXactionId": xid, "LineNumber": ln, "Quantity": 1 + ln,
                          "ItemCode": fixed.BOOKWORM_PLACEHOLDER_ITEM if placeholder else item(1000 + 3 * t + ln if spread else 1 + t % 3), "IsReturn": "N" if t % 4 else "Y",
                          "ExtendedAmt": money(2.5 * ln)})
            if placeholder and t % 3:
                orders += [{"locationId": 1, "tillnumber": "01", "transactionNumber": str(t // 2), "detailNumber": ln, "SKU": "1",
                            "LocationNo": "00002"}] * (1 + t % 2)
        bins.append({"TransferBinNo": t, "LocationNo": "00001", "ToLocationNo": "00002", "TransferType": 7, "StatusCode": 3, "CreateTime": day})
        moved += [{"TransferBinNo": t, "DipsItemCode": item(1000 + 3 * t + k if spread else 1 + k), "Quantity": 1, "DipsCost": money(2), "StatusCode": 1, "CreateTime": day,
                   "UpdateTime": None} for k in range(3)]
    return make_sources(spark, sales_header=heads, sales_item=lines, bookworm=orders, xfer_header=bins, xfer_detail=moved)


def _shuffled(df) -> int:
    df.collect()
    return sum(_metric(df, "Exchange", "shuffleRecordsWritten").values())


def test_store_lines_are_shuffled_twice(spark, no_broadcast):
    src = _world(spark, spread=True)
    assert _shuffled(sales.store_sales(src, W, products_categorised(src, True))) < 3.5 * N


def test_transfer_lines_are_shuffled_twice(spark, no_broadcast):
    assert _shuffled(transfers.xfers_tidy(_world(spark, spread=True), W)) < 3 * N


def test_one_pass_is_the_sum_of_the_branches(spark, no_broadcast):
    src = _world(spark)
    cols = ["BusinessMonth", "LocationNo", "SldTy", "PrCat", "Qty", "Cost", "Val", "Fee", "Lines"]
    both = sales.store_sales(src, W, products_categorised(src, True), lines=True)
    parts = sales.sales_register(src, W, lines=True).unionByName(sales.sales_bookworm(src, W, lines=True))
    rows = sorted(map(tuple, both.select(cols).collect()))
    assert rows == sorted(map(tuple, parts.select(cols).collect()))
    assert {r[2] for r in rows} == {fixed.SLD_REGISTER, fixed.SLD_BOOKWORM}


@pytest.mark.parametrize("table", ["sales_item", "bookworm", "istore_orders", "web_orders", "fulfil_header"])
def test_stored_lines_give_the_same_tables(spark, table):
    src = from_star(spark, SF_SMALL)
    a, b = src.table(table), src.stored().table(table)
    assert a.schema == b.schema and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert "Join" not in plan(b)


def test_headers_are_laid_out_by_their_order(spark, no_broadcast):
    heads = from_star(spark, SF_SMALL).fulfil_header
    joined = heads.join(spark.range(10).select(F.col("id").alias("ISISOrderID")), "ISISOrderID")
    assert plan(joined).count("+- Exchange") <= 2
