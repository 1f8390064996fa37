"""Rows of a join's large side that meet nothing are kept back before its shuffle, and none that meet something."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.operators import reach, sales
from shelfcost.operators.dims import products_categorised
from shelfcost.sources import star
from shelfcost.sources.catalog import Sources, from_star
from tests.conftest import SF_SMALL
from tests.edge import D, item, make_sources, money
from tests.test_reduction import _metric
from tests.test_shuffles import OFF, W, no_broadcast  # noqa: F401

N = 2000


def _orders(spark):
    """A Bookworm order per line, as the fixture has them; every fortieth line stands for one."""
    heads, lines, orders = [], [], []
    for t in range(N):
        key = {"LocationID": 1, "BusinessDate": D(2001, 1 + t % 3, 1)}
        heads.append({**key, "SalesXactionID": f"01{t:09d}", "Status": "A", "XactionType": "S"})
        lines.append({**key, "SalesXactionId": f"01{t:09d}", "LineNumber": 1, "Quantity": 1, "IsReturn": "N", "ExtendedAmt": money(1),
                      "ItemCode": fixed.BOOKWORM_PLACEHOLDER_ITEM if t % 40 == 0 else item(1)})
        orders.append({"locationId": 1, "tillnumber": "01", "transactionNumber": str(t), "detailNumber": 1, "SKU": "1", "LocationNo": "00002"})
    return make_sources(spark, sales_header=heads, sales_item=lines, bookworm=orders)


@pytest.mark.parametrize("branch", ["one pass", "bookworm"])
def test_bookworm_orders_of_other_lines_are_not_shuffled(spark, no_broadcast, branch):  # noqa: F811
    src = _orders(spark)
    df = sales.sales_bookworm(src, W) if branch == "bookworm" else sales.store_sales(src, W, products_categorised(src, True))
    found = {(r["LocationNo"], r["Qty"]) for r in df.where(F.col("SldTy") == fixed.SLD_BOOKWORM).collect()}
    assert found == {("00002", 17), ("00002", 16)}
    sent = {k: v for k, v in _metric(df, "Exchange", "shuffleRecordsWritten").items() if "BkXactionId" in k}
    assert sent and sum(sent.values()) < N // 10


def test_short_runs_keep_back_ids_between_their_own(spark, no_broadcast):  # noqa: F811
    rnd = random.Random(3)
    ids = rnd.sample(range(10**6), 500)
    rows = spark.range(10**6).withColumnRenamed("id", "key")
    kept = sales.between_ids(rows, "key", spark.createDataFrame([(i,) for i in ids], "id long"))
    got = {r["key"] for r in kept.collect()}
    assert set(ids) <= got and len(got) < 600


def test_no_row_is_lost_and_none_is_doubled(spark, monkeypatch):
    """Also where every bit is shared by many keys, and for keys that are null or come twice."""
    rows = spark.createDataFrame([(i % 50, None if i % 7 == 0 else f"k{i}") for i in range(300)] * 2, "a int, b string")
    wanted = rows.where("a < 5").unionByName(rows.where("a < 5"))
    for bits in (1 << 26, 128):
        monkeypatch.setattr(reach, "BITS", bits)
        kept = reach.among(rows, ["a", "b"], reach.marks(wanted))
        assert kept.exceptAll(rows).isEmpty() and rows.where("a < 5").exceptAll(kept).isEmpty()


def test_bin_lines_come_laid_out_by_their_bin(spark, no_broadcast):  # noqa: F811
    """One shuffle by the part and one by the order; the join on the bin takes the latter as it is, the same rows as by the order first."""
    src = from_star(spark, SF_SMALL)
    lines = src.xfer_detail
    joined = lines.join(src.xfer_header.select("TransferBinNo", "LocationNo"), "TransferBinNo")
    joined.collect()
    n = lines.count()
    sent = [v for v in _metric(joined, "Exchange", "shuffleRecordsWritten").values() if v >= n]
    assert len(sent) == 2

    t = star.StarTables(spark, SF_SMALL)
    part = t.read("part").select("p_partkey", "p_retailprice")
    by_order = star._lo(t).join(part, F.col("l_partkey") == F.col("p_partkey"))
    plain = by_order.select(F.col("l_orderkey").alias("TransferBinNo"), star.pad(F.col("l_partkey"), 20).alias("DipsItemCode"), F.col("p_retailprice").cast("decimal(19,4)").alias("DipsCost"))
    got = lines.select(*plain.columns)
    assert isinstance(src, Sources) and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
