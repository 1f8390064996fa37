"""Edge rows the derived test tables cannot reach (FIXTURES part C)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from shelfcost.functions.columns import bookworm_xaction_id, item_code_from_sku
from shelfcost.functions.dates import Window
from shelfcost.operators import dims, legacy, quality, report, sales, transfers, writer
from shelfcost.plans.monthly import build_rollup
from tests.edge import D, item, make_sources, money

MAY = Window(D(2001, 5, 1), D(2001, 6, 1))


def _header(loc, day, xid):
    return {"LocationID": loc, "BusinessDate": day, "SalesXactionID": xid, "Status": "A", "XactionType": "S"}


def _line(loc, day, xid, line, code, q, amt, ret="N"):
    return {"LocationID": loc, "BusinessDate": day, "SalesXactionId": xid, "LineNumber": line, "ItemCode": code,
            "Quantity": q, "IsReturn": ret, "ExtendedAmt": money(amt)}


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_e1_padded_gift_card_type_is_trimmed_and_excluded(spark):
    src = make_sources(spark, sales_header=[_header(1, D(2001, 5, 2), "0100000001")],
                       sales_item=[_line(1, D(2001, 5, 2), "0100000001", 1, item(4), 1, 10),
                                   _line(1, D(2001, 5, 2), "0100000001", 2, item(1), 1, 9)])
    cat = {r.ProductType: r.PTypeCategory for r in dims.category_dim(src).collect()}
    assert cat["PGC"] == "gc"
    assert _rows(sales.sales_register(src, MAY), "PrCat") == [("dist",)]


def _web(**kw):
    row = {"ISIS_OrderID": 11, "MarketOrderID": "M1", "MarketOrderItemID": 11, "FacilityID": 1,
           "SKU": "D" + item(1), "OrderStatus": "open", "ItemStatus": "shipped", "ShippingMethod": "100",
           "Quantity": 3, "ExtendedAmount": money(30), "ShippingAmount": money(4.99),
           "ItemRefundAmount": money(0), "OrderDate": D(2001, 5, 1), "ShipDate": D(2001, 5, 3),
           "SiteLastModifiedDate": D(2001, 5, 18)}
    row.update(kw)
    return row


def _web_src(spark, orders):
    fh = [{"OrderID": 1000 + o["ISIS_OrderID"], "ISISOrderID": o["ISIS_OrderID"], "OrderSystem": "HMP",
           "MarketOrderID": o["MarketOrderID"]} for o in orders]
    fd = [{"OrderID": 1000 + o["ISIS_OrderID"], "ItemCode": item(1), "LocationNo": None, "Status": 1,
           "ProblemStatusID": None, "MarketOrderItemID": str(o["MarketOrderItemID"])} for o in orders]
    return make_sources(spark, web_orders=orders, fulfil_header=fh, fulfil_detail=fd)


def test_e2_e3_status_case_and_nulls_exclude_web_rows(spark):
    orders = [
        _web(ISIS_OrderID=1, MarketOrderItemID=1, OrderStatus="Canceled"),
        _web(ISIS_OrderID=2, MarketOrderItemID=2, OrderStatus="CANCELED"),
        _web(ISIS_OrderID=3, MarketOrderItemID=3, ShippingMethod=None),
        _web(ISIS_OrderID=4, MarketOrderItemID=4, OrderStatus=None),
        _web(ISIS_OrderID=5, MarketOrderItemID=5, ItemStatus="SHIPPED"),
    ]
    src = _web_src(spark, orders)
    rows = sales.sales_web_shipped(src, MAY).collect()
    assert len(rows) == 1 and rows[0].Qty == 3  # only order 5 (ItemStatus compared without case)


def test_e4_e5_bookworm_ids(spark):
    df = spark.createDataFrame([("01", "42", "123"), ("02", "1234567890123", None), (None, "7", "9")],
                               "till string, txn string, sku string")
    got = df.select(bookworm_xaction_id(F.col("till"), F.col("txn")).alias("x"),
                    item_code_from_sku(F.col("sku")).alias("i")).collect()
    assert got[0].x == "01000000042" and got[0].i == item(123)
    assert got[1].x == "02567890123" and got[1].i is None
    assert got[2].x is None


def test_e8_window_edges_and_e23_returns(spark):
    src = make_sources(
        spark,
        sales_header=[_header(1, D(2001, 5, 1), "A"), _header(1, D(2001, 6, 1), "B")],
        sales_item=[_line(1, D(2001, 5, 1), "A", 1, item(1), 2, 10),
                    _line(1, D(2001, 5, 1), "A", 2, item(1), 1, -4, ret="Y"),
                    _line(1, D(2001, 6, 1), "B", 1, item(1), 5, 50)],
    )
    rows = sales.sales_register(src, MAY).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.BusinessMonth, r.LocationNo, r.Qty, r.Cost, r.Val) == (D(2001, 5, 1), "00001", 1, money(5), money(6))


def test_e10_frontline_used_counts_online_not_register(spark):
    types = [{"ProductType": "TRF", "PTypeClass": "USED"}]
    products = [{"ItemCode": item(2), "ProductType": "TRF", "Cost": money(7)}]
    src = make_sources(spark, product_types=types, product_master=products,
                       sales_header=[_header(1, D(2001, 5, 2), "A")],
                       sales_item=[_line(1, D(2001, 5, 2), "A", 1, item(2), 1, 9)])
    assert dims.category_dim(src).first().PTypeCategory == "frln"
    assert sales.sales_register(src, MAY).count() == 0
    orders = [_web(ISIS_OrderID=1, MarketOrderItemID=1)]
    fh = [{"OrderID": 1001, "ISISOrderID": 1, "OrderSystem": "HMP", "MarketOrderID": "M1"}]
    fd = [{"OrderID": 1001, "ItemCode": item(2), "Status": 4, "MarketOrderItemID": "1"}]
    src = make_sources(spark, product_types=types, product_master=products, web_orders=orders, fulfil_header=fh,
                       fulfil_detail=fd)
    assert _rows(sales.sales_web_shipped(src, MAY), "PrCat", "LocationNo") == [("frln", "00001")]


def _istore(oid, fac=1, **kw):
    row = {"ISIS_OrderID": oid, "FacilityID": fac, "SKU": "D" + item(1), "OrderStatus": "Shipped",
           "ShippedQuantity": 3, "Price": money(20), "ShippingFee": money(3.99), "OrderDate": D(2001, 5, 1),
           "ShipDate": D(2001, 5, 4), "RefundDate": None, "RefundAmount": money(0)}
    row.update(kw)
    return row


def test_e11_e12_e13_istore_fanout_fallback_and_cost(spark):
    orders = [_istore(1), _istore(2, fac=2)]
    fh = [{"OrderID": 101, "ISISOrderID": 1, "OrderSystem": "MON"},
          {"OrderID": 102, "ISISOrderID": 2, "OrderSystem": "MON"}]
    fd = [{"OrderID": 101, "ItemCode": item(1), "LocationNo": None, "Status": 1},
          {"OrderID": 101, "ItemCode": item(1), "LocationNo": None, "Status": 4},
          {"OrderID": 102, "ItemCode": item(1), "LocationNo": "00001", "Status": 1}]
    src = make_sources(spark, istore_orders=orders, fulfil_header=fh, fulfil_detail=fd)
    rows = sales.sales_istore_shipped(src, MAY).collect()
    assert len(rows) == 1  # both land at store 00001: fallback for order 1, fulfilment store for order 2
    r = rows[0]
    # order 1 counted twice (two valid detail lines), order 2 once; cost is per line, not x quantity
    assert (r.Qty, r.Cost, r.Val) == (9, money(15), money(60))


def test_e11_null_location_is_rejected_not_gridded(spark):
    orders = [_istore(1, fac=9)]  # facility 9 has no store
    fh = [{"OrderID": 101, "ISISOrderID": 1, "OrderSystem": "MON"}]
    fd = [{"OrderID": 101, "ItemCode": item(1), "LocationNo": None, "Status": 1}]
    facilities = [{"FacilityID": 9, "FacilityLocationNo": None}]
    src = make_sources(spark, istore_orders=orders, fulfil_header=fh, fulfil_detail=fd, facilities=facilities)
    run = build_rollup(src, MAY)
    assert run.rejects.count() == 1
    assert run.rollup.count() == 0


def _xfer(bin_no, loc, to, ttype, created, updated, code, q=2, cost=5):
    head = {"TransferBinNo": bin_no, "LocationNo": loc, "ToLocationNo": to, "TransferType": ttype,
            "StatusCode": 3, "CreateTime": created}
    line = {"TransferBinNo": bin_no, "DipsItemCode": code, "Quantity": q, "DipsCost": money(cost),
            "StatusCode": 1, "CreateTime": created, "UpdateTime": updated}
    return head, line


def test_e14_e15_e16_transfer_rules(spark):
    h1, d1 = _xfer(1, "00001", "00002", 1, D(2001, 5, 10), None, item(3))            # scan trash
    h2, d2 = _xfer(2, "00001", "00002", 3, D(2001, 5, 20), D(2001, 6, 2), item(1))   # updated in June
    h3, d3 = _xfer(3, "00002", "00001", 1, D(2001, 5, 5), None, item(1))             # trash, inbound side
    src = make_sources(spark, xfer_header=[h1, h2, h3], xfer_detail=[d1, d2, d3])
    out = _rows(transfers.xfers_out(src, MAY), "BusinessMonth", "LocationNo", "XfrTy", "PrCat", "Qty", "Cost")
    assert (D(2001, 6, 1), "00001", 3, "dist", 2, money(10)) in out  # E15: lands in June
    run = build_rollup(src, MAY)
    keys = {(r.BusinessMonth, r.LocationNo): r for r in run.rollup.collect()}
    # E14 + E16: (May, 00001) holds only the scan trash sent out and the trash received -- a key, no measure
    may1 = keys[(D(2001, 5, 1), "00001")]
    assert all(v == 0 for v in list(may1)[2:])
    may2 = keys[(D(2001, 5, 1), "00002")]
    assert may2.DistTshQty == 2 and may2.TotDistRfiCost == money(10)
    # The store-to-store created in May but updated in June is June's outbound
    assert keys[(D(2001, 6, 1), "00001")].DistTotXfrOutQty == 2
    assert keys[(D(2001, 6, 1), "00002")].DistTotXfrInQty == 0  # IN filters on event time, June is outside May


def test_e17_grid_zero_rows(spark):
    sw = spark.createDataFrame([(D(2001, 5, 1), "00001")], "BusinessMonth date, LocationNo string")
    xw = spark.createDataFrame([(D(2001, 6, 1), "00002")], "BusinessMonth date, LocationNo string")
    from shelfcost.operators.rollup import grid_locations, grid_months, key_grid

    grid = key_grid(grid_months(sw, xw), grid_locations(sw, xw))
    assert sorted(tuple(r) for r in grid.collect()) == [
        (D(2001, 5, 1), "00001"), (D(2001, 5, 1), "00002"), (D(2001, 6, 1), "00001"), (D(2001, 6, 1), "00002")]


def test_e18_e19_replace_by_key(spark):
    h, d = _xfer(1, "00001", "00002", 1, D(2001, 5, 10), None, item(1))
    src = make_sources(spark, xfer_header=[h], xfer_detail=[d])
    run = build_rollup(src, MAY)
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-test-"), "rollup")
    # existing table: another store in May and a row in April
    seed = run.rollup.limit(1).select(
        F.col("BusinessMonth"), F.lit("00099").alias("LocationNo"),
        *[c for c in run.rollup.columns if c not in ("BusinessMonth", "LocationNo")])
    april = seed.withColumn("BusinessMonth", F.lit(D(2001, 4, 1)))
    writer.replace_by_key(spark, path, seed.unionByName(april), seed.unionByName(april).select("BusinessMonth", "LocationNo"))
    writer.replace_by_key(spark, path, run.rollup, run.grid)
    first = sorted(tuple(r) for r in writer.read_rollup(spark, path).collect())
    writer.replace_by_key(spark, path, run.rollup, run.grid)
    second = sorted(tuple(r) for r in writer.read_rollup(spark, path).collect())
    assert first == second  # E19 / I5
    keys = [(r[0], r[1]) for r in first]
    assert (D(2001, 5, 1), "00099") in keys and (D(2001, 4, 1), "00099") in keys  # E18 / I6
    assert (D(2001, 5, 1), "00001") in keys
    assert quality.duplicate_keys(writer.read_rollup(spark, path), ["BusinessMonth", "LocationNo"]).count() == 0


def test_e20_unknown_location_type_is_empty(spark):
    src = make_sources(spark)
    sel = report.select_locations(src, "Country", "X")
    assert sel.count() == 0
    rollup = spark.createDataFrame([], writer.ROLLUP)
    assert report.report(rollup, sel, D(2001, 1, 1), D(2001, 12, 31)).count() == 0


def test_e21_region_with_repeated_district_is_one_row(spark):
    rl = [{"District": "D1", "Region": "NORTH"}, {"District": "D1", "Region": "NORTH"}]
    src = make_sources(spark, report_locations=rl)
    assert _rows(report.select_locations(src, "Region", "NORTH"), "LocationNo") == [("00001",)]
    assert _rows(report.select_locations(src, "District", "D2"), "LocationNo") == [("00002",)]


def test_e9_report_end_month_inclusive(spark):
    rows = [(D(2001, 5, 1), "00001"), (D(2001, 6, 1), "00001"), (D(2001, 7, 1), "00001")]
    base = spark.createDataFrame(rows, "BusinessMonth date, LocationNo string")
    rollup = writer.conform(base.select("*", *[F.lit(0).alias(n) for n in writer.ROLLUP.fieldNames()[2:]]))
    sel = report.select_locations(make_sources(spark), "Store", "00001")
    got = [r.BusinessMonth for r in report.report(rollup, sel, D(2001, 5, 1), D(2001, 6, 1)).collect()]
    assert got == [D(2001, 5, 1), D(2001, 6, 1)]


def test_e22_problem_status_zero(spark):
    orders = [_istore(1)]
    fh = [{"OrderID": 101, "ISISOrderID": 1, "OrderSystem": "MON"}]
    fd = [{"OrderID": 101, "ItemCode": item(1), "LocationNo": "00002", "Status": 1, "ProblemStatusID": 0}]
    src = make_sources(spark, istore_orders=orders, fulfil_header=fh, fulfil_detail=fd)
    assert sales.sales_istore_shipped(src, MAY).count() == 0
    v1 = legacy.v1_istore_shipped(src, MAY).collect()  # v1 buckets on OrderDate, May 1
    assert [(r.LocationNo, r.Qty) for r in v1] == [("00002", 3)]


def test_e24_unknown_class_is_zzz(spark):
    cat = {r.ProductType: r.PTypeCategory for r in dims.category_dim(make_sources(spark)).collect()}
    assert cat == {"HB": "dist", "TRF": "frln", "SCAN": "scan", "PGC": "gc", "UHB": "used", "ODD": "zzz"}


def test_persisted_category_table_is_used_when_configured(spark):
    """The rollup reads the category table written by the category load, when one is named."""
    cats = [{"ProductType": "HB", "PTypeCategory": "frln  ", "PTypeClass": "NEW"}]  # padded, as stored
    src = make_sources(spark, category_dim=cats,
                       sales_header=[_header(1, D(2001, 5, 2), "A")],
                       sales_item=[_line(1, D(2001, 5, 2), "A", 1, item(1), 1, 9)])
    assert _rows(sales.sales_register(src, MAY), "PrCat") == [("frln",)]


def test_source_column_read_under_its_physical_name(spark):
    from shelfcost.sources.catalog import from_frames
    from shelfcost.sources.schemas import PHYSICAL_NAMES

    physical = PHYSICAL_NAMES[("facilities", "FacilityLocationNo")]
    fac = spark.createDataFrame([(1, "00007 ")], f"FacilityID int, {physical} string")
    src = from_frames(spark, {"facilities": fac})
    assert [tuple(r) for r in src.facilities.collect()] == [(1, "00007")]


def test_k9_create_empty_table_then_replace(spark):
    h, d = _xfer(1, "00001", "00002", 1, D(2001, 5, 10), None, item(1))
    src = make_sources(spark, xfer_header=[h], xfer_detail=[d])
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-k9-"), "rollup")
    writer.create_table(spark, path)
    empty = writer.read_rollup(spark, path)
    assert empty.count() == 0
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in writer.ROLLUP]
    run = build_rollup(src, MAY)
    writer.replace_by_key(spark, path, run.rollup, run.grid)
    assert sorted(map(tuple, writer.read_rollup(spark, path).collect())) == sorted(map(tuple, run.rollup.collect()))


def test_writer_refuses_duplicate_keys(spark):
    import pytest

    from shelfcost.operators.quality import KeyViolation

    h, d = _xfer(1, "00001", "00002", 1, D(2001, 5, 10), None, item(1))
    src = make_sources(spark, xfer_header=[h], xfer_detail=[d])
    run = build_rollup(src, MAY)
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-dup-"), "rollup")
    with pytest.raises(KeyViolation):
        writer.replace_by_key(spark, path, run.rollup.unionByName(run.rollup), run.grid)
    assert not writer.table_exists(spark, path)


def test_v1_item_master_join_multiplies_duplicates(spark):
    """v1 web shipped sales inner-join the item master; a duplicated item doubles."""
    orders = [_web(ISIS_OrderID=1, MarketOrderItemID=1, OrderDate=D(2001, 5, 2))]
    once = make_sources(spark, web_orders=orders, item_master=[{"ItemCode": item(1)}])
    twice = make_sources(spark, web_orders=orders, item_master=[{"ItemCode": item(1)}, {"ItemCode": item(1)}])
    a = legacy.v1_web_shipped(once, MAY).first()
    b = legacy.v1_web_shipped(twice, MAY).first()
    assert (a.Qty, a.Cost, a.Val) == (3, money(5), money(30))
    assert (b.Qty, b.Cost, b.Val) == (6, money(10), money(60))


def test_v1_transfers_count_scan_as_dist(spark):
    """Q6: v1 transfer classes have no scan arm, so a SCAN transfer is distribution."""
    h, d = _xfer(1, "00001", "00002", 1, D(2001, 5, 10), None, item(3))   # item 3 is SCAN
    src = make_sources(spark, xfer_header=[h], xfer_detail=[d])
    assert _rows(legacy.v1_xfers_out(src, MAY), "PrCat", "Qty") == [("dist", 2)]
    assert _rows(transfers.xfers_out(src, MAY), "PrCat", "Qty") == [("scan", 2)]


def test_v1_left_join_keeps_orders_without_fulfilment(spark):
    """With no fulfilment rows, v1 still counts the order at the facility's store."""
    src = make_sources(spark, istore_orders=[_istore(1, fac=2)])
    assert sales.sales_istore_shipped(src, MAY).count() == 0          # current rules: inner joins
    rows = legacy.v1_istore_shipped(src, MAY).collect()
    assert [(r.LocationNo, r.Qty, r.Val) for r in rows] == [("00002", 3, money(20))]


def test_enforce_key_reports_nulls_and_duplicates(spark):
    import pytest

    from shelfcost.operators.quality import KeyViolation, enforce_key

    ok = spark.createDataFrame([(1, "a"), (1, "b")], "m int, s string")
    enforce_key(ok, ["m", "s"])
    with pytest.raises(KeyViolation, match="duplicate"):
        enforce_key(ok.unionByName(ok), ["m", "s"])
    with pytest.raises(KeyViolation, match="NULL"):
        enforce_key(spark.createDataFrame([(1, None)], "m int, s string"), ["m", "s"])


def _half_keyed(spark):
    """Two web orders; the second one's facility and fulfilment line name no store."""
    orders = [_web(ISIS_OrderID=1, MarketOrderItemID=1), _web(ISIS_OrderID=2, MarketOrderItemID=2, FacilityID=3)]
    fh = [{"OrderID": 100 + i, "ISISOrderID": i, "OrderSystem": "HMP", "MarketOrderID": "M1"} for i in (1, 2)]
    fd = [{"OrderID": 100 + i, "ItemCode": item(1), "LocationNo": None, "Status": 1, "MarketOrderItemID": str(i)}
          for i in (1, 2)]
    facilities = [{"FacilityID": 1, "FacilityLocationNo": "00001"}, {"FacilityID": 3, "FacilityLocationNo": None}]
    return make_sources(spark, web_orders=orders, fulfil_header=fh, fulfil_detail=fd, facilities=facilities)


def test_null_stores_fail_the_job_and_are_kept_as_rejects(spark):
    import pytest

    from shelfcost.plans.monthly import RejectedRows, run_rollup

    src = _half_keyed(spark)
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-rej-"), "rollup")
    with pytest.raises(RejectedRows):
        run_rollup(src, path, D(2001, 5, 1), D(2001, 8, 1))
    assert not writer.table_exists(spark, path) and writer.read_refused(spark, path).count() == 1
    run = run_rollup(src, path, D(2001, 5, 1), D(2001, 8, 1), allow_rejects=True)
    rejects = writer.read_rejects(spark, path).collect()
    assert writer.read_refused(spark, path).count() == 0
    assert [(r.Source, r.LocationNo, r.Qty) for r in rejects] == [("sales", None, run.tidy.where("LocationNo is null").first().Qty)]
    # nothing is lost: rollup + rejects = all tidy rows
    kept = sum(r.DistOnlineSoldVal for r in writer.read_rollup(spark, path).collect())
    total = sum(r.Val for r in run.tidy.collect())
    assert kept > 0 and kept + sum(r.Val for r in rejects) == total


def test_more_than_1200_months(spark):
    """Dirty line dates alone can spread a run over centuries; every month gets its row."""
    bins, lines = [], []
    for k in range(1300):
        year, month = 1900 + k // 12, 1 + k % 12
        bins.append({"TransferBinNo": k, "LocationNo": "00001", "ToLocationNo": "00002", "TransferType": 1, "StatusCode": 3,
                     "CreateTime": D(2001, 5, 10)})
        lines.append({"TransferBinNo": k, "DipsItemCode": item(1), "Quantity": 1, "DipsCost": money(1), "StatusCode": 1,
                      "CreateTime": D(2001, 5, 10), "UpdateTime": D(year, month, 15)})
    run = build_rollup(make_sources(spark, xfer_header=bins, xfer_detail=lines), MAY)
    months = {r.BusinessMonth for r in run.rollup.where("DistTshQty = 1").select("BusinessMonth").collect()}
    assert len(months) == 1300
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-months-"), "rollup")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    writer.replace_by_key(spark, path, run.rollup.where("BusinessMonth < '1910-01-01'"),
                          run.grid.where("BusinessMonth < '1910-01-01'"))
    assert writer.read_rollup(spark, path).select("BusinessMonth").distinct().count() == 120


def test_grid_leaves_out_months_that_do_not_occur(spark):
    from shelfcost.operators.rollup import key_grid

    months = spark.createDataFrame([(D(2001, 1, 1),), (D(2001, 4, 1),)], "BusinessMonth date")
    stores = spark.createDataFrame([("A",), (None,)], "LocationNo string")
    got = {tuple(r) for r in key_grid(months, stores).collect()}
    assert got == {(m, s) for m in (D(2001, 1, 1), D(2001, 4, 1)) for s in ("A", None)}


def test_category_load_enforces_its_key(spark):
    import pytest

    from shelfcost.operators.quality import KeyViolation
    from shelfcost.plans.monthly import run_category_load

    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-cat-"), "category")
    twice = make_sources(spark, product_types=[{"ProductType": "HB", "PTypeClass": c} for c in ("NEW", "USED")])
    with pytest.raises(KeyViolation, match="duplicate"):
        run_category_load(twice, path)
    empty = make_sources(spark, product_types=[{"ProductType": "HB", "PTypeClass": None}])
    with pytest.raises(KeyViolation, match="NULL column"):
        run_category_load(empty, path)
    assert not os.path.exists(path)
    run_category_load(make_sources(spark), path)
    assert spark.read.parquet(path).count() == 6


def test_only_a_missing_path_counts_as_no_table(spark):
    import pytest

    path = os.path.join(tempfile.mkdtemp(prefix="shelfcost-bad-"), "rollup")
    assert not writer.table_exists(spark, path)
    with pytest.raises(Exception, match="nosuchscheme"):
        writer.table_exists(spark, "nosuchscheme-://x:y")


def test_report_selectors_ignore_case(spark):
    from shelfcost.operators import report

    src = make_sources(spark)
    for kind, value in (("all locations", None), ("STORE", "00001"), ("district", "d1"), ("Region", "north")):
        got = {r.LocationNo for r in report.select_locations(src, kind, value).collect()}
        assert got == ({"00001", "00002"} if value is None else {"00001"})
    assert report.select_locations(src, "Country", "north").count() == 0
