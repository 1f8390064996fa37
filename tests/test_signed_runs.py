"""Signed runs: both sides in one pass, what is the same on both stays behind, and steps leave no shuffle files on the disk."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcost.operators import sales, transfers
from shelfcost.operators.dims import products_categorised
from shelfcost.plans import incremental
from shelfcost.plans.monthly import build_rollup
from shelfcost.sources.catalog import from_star
from tests.edge import D, item, make_sources, money
from tests.test_incremental import WINDOW, _facts, _set, _sources
from tests.test_shuffles import no_broadcast  # noqa: F401  (a fixture)
from tests.test_reduction import _metric

N = 200   # documents


def _world(spark, quantity: int):
    """Three lines a transaction and a bin, each of its own item; the third line's quantity is the given one."""
    day = D(2001, 5, 2)
    f = {"sales_header": [], "sales_item": [], "xfer_header": [], "xfer_detail": []}
    for t in range(N):
        xid = f"01{t:09d}"
        f["sales_header"].append({"LocationID": 1, "BusinessDate": day, "SalesXactionID": xid, "Status": "A", "XactionType": "S"})
        f["xfer_header"].append({"TransferBinNo": t, "LocationNo": "00001", "ToLocationNo": "00002", "TransferType": 7, "StatusCode": 3, "CreateTime": day})
        for n in range(3):
            code, q = item(1000 + 3 * t + n), quantity if n == 2 else 1
            f["sales_item"].append({"LocationID": 1, "BusinessDate": day, "SalesXactionId": xid, "LineNumber": n, "ItemCode": code,
                                    "Quantity": q, "IsReturn": "N", "ExtendedAmt": money(2)})
            f["xfer_detail"].append({"TransferBinNo": t, "DipsItemCode": code, "Quantity": q, "DipsCost": money(2), "StatusCode": 1,
                                     "CreateTime": day, "UpdateTime": None})
    products = [{"ItemCode": item(1000 + k), "ProductType": "HB", "Cost": money(1)} for k in range(3 * N)]
    return make_sources(spark, product_master=products, **f)


def test_lines_that_did_not_change_are_not_shuffled_to_their_products(spark, no_broadcast):  # noqa: F811
    old, new = _world(spark, 1), _world(spark, 5)
    both = incremental._both_sides(new, incremental.between(old, new))
    sold = sales.store_sales(both, WINDOW, products_categorised(both, True), lines=True, signed=True)
    moved = transfers.transfers(both, WINDOW, run_month=True, lines=True, signed=True)
    for rows in (sold, moved):
        rows.collect()
        by_item = [n for text, n in _metric(rows, "Exchange", "shuffleRecordsWritten").items() if "hashpartitioning(ItemCode" in text]
        assert sorted(by_item) == [2 * N, 3 * N]   # the third lines, before and after (all lines of both are 6 * N); the products


def test_rows_meet_those_of_their_own_side(spark):
    """A line is there twice, then once, and a second transaction is voided while its line changes."""
    def world(copies, status, amount):
        day = D(2001, 5, 2)
        head = {"LocationID": 1, "BusinessDate": day, "XactionType": "S"}
        line = {"LocationID": 1, "BusinessDate": day, "LineNumber": 1, "ItemCode": item(1), "Quantity": 1, "IsReturn": "N"}
        return make_sources(
            spark, sales_header=[{**head, "SalesXactionID": "01000000001", "Status": "A"}, {**head, "SalesXactionID": "01000000002", "Status": status}],
            sales_item=[{**line, "SalesXactionId": "01000000001", "ExtendedAmt": money(3)}] * copies + [{**line, "SalesXactionId": "01000000002", "ExtendedAmt": money(amount)}])

    old, new = world(2, "A", 10), world(1, "V", 20)
    signed = incremental.delta(new, incremental.between(old, new), WINDOW).collect()
    assert [(r["Qty"], r["Val"], r["Lines"]) for r in signed] == [(-2, money(-13), -2)]


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (os.path.basename(p) for p in files.mkString("\n").split("\n")) if name.startswith("shuffle_")}


@pytest.fixture()
def scratch(spark):
    return os.path.join(tempfile.mkdtemp(prefix="shelfcost-signed-"), "rollup")


def test_steps_leave_no_shuffle_files(spark, scratch, monkeypatch):
    """All steps over the facts: those of the written rollup, which is small at any size, are not looked at."""
    monkeypatch.setattr(incremental, "_write", lambda *_: None)
    r = random.Random(3)
    old, new = (_sources(spark, _facts(r)) for _ in range(2))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), _shuffle_files(spark)
    incremental.start(old, scratch, WINDOW)
    incremental.materialise(incremental.delta(new, incremental.between(old, new), WINDOW))
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(key) == setting


@pytest.fixture()
def star(spark):
    """Star tables with an order and a part that come twice, lines without an order, without a part and without keys."""
    d = tempfile.mkdtemp(prefix="shelfcost-star-")

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")

    day = F.to_timestamp(F.lit("2001-05-02"))
    write("part", [(1, 2.5), (2, 4.0), (2, 4.0), (None, 1.0)], "p_partkey long, p_retailprice double")
    keys = [(o, p, n) for o in (1, 2, 3, None) for p in (1, 2, 9, None) for n in (1, 2)]
    lines = spark.createDataFrame(keys, "l_orderkey long, l_partkey long, l_linenumber int").selectExpr(
        "*", "1L as l_suppkey", "2.0D as l_quantity", "9.5D as l_extendedprice", "'N' as l_returnflag", "'F' as l_linestatus").withColumn("l_shipdate", day)
    lines.coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    orders = spark.createDataFrame([(1,), (2,), (2,), (None,)], "o_orderkey long").selectExpr(
        "*", "4L as o_custkey", "'F' as o_orderstatus").withColumn("o_orderdate", day)
    orders.coalesce(1).write.parquet(f"{d}/orders.parquet")
    return d


def test_a_table_that_is_read_again_is_kept_as_it_is(spark, star):
    src = from_star(spark, star)
    kept = src.stored("xfer_detail")
    want = _set(src.xfer_detail, src.xfer_detail.columns)
    assert len(want) == 18 and _set(kept.xfer_detail, src.xfer_detail.columns) == want == _set(src.stored().xfer_detail, src.xfer_detail.columns)
    assert kept.xfer_detail.dtypes == src.xfer_detail.dtypes
    assert "Join" not in kept.xfer_detail._jdf.queryExecution().optimizedPlan().toString()
    assert kept is src.stored("xfer_detail") and "Join" in src.stored().xfer_detail._jdf.queryExecution().optimizedPlan().toString()


def test_a_signed_run_without_changes_is_empty_and_one_from_nothing_is_the_whole(spark):
    facts = _facts(random.Random(11))
    src = _sources(spark, facts)
    full = build_rollup(src, WINDOW).tidy
    rows = {n: src.table(n) for n in incremental.FACTS}
    assert incremental.delta(src, incremental.Changes(rows, rows), WINDOW).count() == 0
    assert _set(incremental.delta(src, incremental.Changes({}, rows), WINDOW), full.columns) == _set(full, full.columns)
