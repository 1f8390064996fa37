"""The older (v1) rule set, built on the same operators.

Differences from the current rules, all reproduced:

* categories from the type code's suffix (scan / dist / frln), not the
  category table; sales and transfers exclude gift cards and class USED;
* online sales bucket on OrderDate; iStore joins fulfilment with LEFT joins
  whose filters sit in the ON clause and accept ProblemStatusID 0;
* online products are matched on ``right(SKU, 20)``; web shipped sales also
  require the item master (an inner join, duplicates would multiply);
* web sales stay at the facility's store (no fulfilment join);
* transfers bucket and filter on the header month, cost is ``sum(DipsCost)``
  without quantity, OUT takes types 1/2/3/7 and IN only type 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.classify import v1_sales_category, v1_transfer_category
from shelfcost.functions.columns import (
    ci_equals,
    ci_isin,
    location_fallback,
    money,
    qty,
    rightmost,
)
from shelfcost.functions.dates import Window, month_bucket
from shelfcost.operators.dims import join_products
from shelfcost.operators.pivot import SALES_MEASURES, V1_XFER_MEASURES, pivot_measures
from shelfcost.operators.rollup import combine_wide, grid_locations, grid_months, key_grid
from shelfcost.operators.sales import LINES, TIDY_COLUMNS, OnlineKind, _any_kind, _signed, _tags, _tidy, bookworm_lines, register_lines, store_sales
from shelfcost.operators.transfers import TIDY_COLUMNS as XFER_COLUMNS
from shelfcost.session import checkpoint_dir
from shelfcost.sources.catalog import Sources


def v1_products(src: Sources, classify=v1_sales_category) -> DataFrame:
    """Product master filtered by type (no gift cards) and class (not USED), with v1 category."""
    types = src.product_types.where(F.col("PTypeClass") != fixed.USED_CLASS).select("ProductType")
    products = src.product_master.where(~F.col("ProductType").isin(list(fixed.GIFT_CARD_TYPES)))
    return products.join(types, "ProductType").select("ItemCode", classify(F.col("ProductType")).alias("PrCat"), "Cost")


def v1_sales_classify(src: Sources) -> DataFrame:
    """P2 over the whole product master."""
    return src.product_master.select("ItemCode", "ProductType", v1_sales_category(F.col("ProductType")).alias("PrCat"))


def v1_xfers_classify(src: Sources) -> DataFrame:
    """P3 over the whole product master."""
    return src.product_master.select(
        "ItemCode", "ProductType", v1_transfer_category(F.col("ProductType")).alias("PrCat")
    )


def _register_measured(lines: DataFrame, store: str, store_as: str, item: str) -> DataFrame:
    """Register lines as (month, store, item, q = signed quantity, v = amount)."""
    return _signed(lines).select(
        month_bucket(F.col("BusinessDate")).alias("BusinessMonth"), F.col(store).alias(store_as),
        F.col(item).alias("ItemCode"), F.col("SignedQty").alias("q"), F.col("ExtendedAmt").alias("v"),
        F.lit(1).cast("bigint").alias(LINES),
    )


def v1_sales_register(src: Sources, window: Window) -> DataFrame:
    lines = _register_measured(register_lines(src, window), "LocationID", "LocationID", "ItemCode")
    priced = join_products(lines, ["BusinessMonth", "LocationID"], ["q", "v", LINES], v1_products(src))
    priced = priced.join(src.locations.select("LocationID", "LocationNo"), "LocationID")
    return _tidy(priced, fixed.SLD_REGISTER, F.col("q"), F.col("q") * F.col("Cost"), F.col("v"), F.lit(0))


def v1_sales_bookworm(src: Sources, window: Window) -> DataFrame:
    lines = _register_measured(bookworm_lines(src, window), "BookwormLocationNo", "LocationNo", "BookwormItemCode")
    priced = join_products(lines, ["BusinessMonth", "LocationNo"], ["q", "v", LINES], v1_products(src))
    return _tidy(priced, fixed.SLD_BOOKWORM, F.col("q"), F.col("q") * F.col("Cost"), F.col("v"), F.lit(0))


# --- online: one pass over both channels, tagged like the current rules ------------------

V1_ISTORE_KINDS = {
    "shipped": OnlineKind(
        fixed.SLD_ISTORE_SHIPPED, "OrderDate", lambda: F.col("ShippedQuantity") > 0,
        lambda: (F.col("ShippedQuantity"), 1, F.col("Price"), F.col("ShippingFee"))),
    "refund": OnlineKind(
        fixed.SLD_ISTORE_REFUND, "RefundDate", lambda: F.col("RefundAmount") > 0,
        lambda: (F.lit(0), 0, -F.col("RefundAmount"), F.lit(0))),
}

V1_WEB_KINDS = {
    "shipped": OnlineKind(
        fixed.SLD_WEB_SHIPPED, "OrderDate", lambda: F.lit(True),
        lambda: (F.col("Quantity"), 1, F.col("ExtendedAmount"), F.col("ShippingAmount"))),
    "refund": OnlineKind(
        fixed.SLD_WEB_REFUND, "SiteLastModifiedDate", lambda: F.col("ItemRefundAmount") > 0,
        lambda: (F.lit(0), 0, -F.col("ItemRefundAmount"), F.lit(0))),
}


def _v1_istore_lines(src: Sources, window: Window, kinds: list[OnlineKind]) -> DataFrame:
    """iStore orders LEFT-joined to fulfilment, filters inside the ON clause.

    Headers and details are left-joined first and the orders then join that
    once, so no order without a header ever carries a NULL join key.
    """
    orders = src.having("istore_orders", "SKU", fixed.ISTORE_SKU_PREFIX).where(
        ci_isin(F.col("OrderStatus"), fixed.ISTORE_OPEN_STATUSES)
        & F.col("SKU").startswith(fixed.ISTORE_SKU_PREFIX)
        & _any_kind(window, kinds)
    )
    heads = src.having("fulfil_header", "OrderSystem", fixed.ISTORE_ORDER_SYSTEM).where(
        F.col("OrderSystem") == fixed.ISTORE_ORDER_SYSTEM).select("OrderID", "ISISOrderID")
    details = src.fulfil_detail.where(
        F.col("Status").isin(list(fixed.FULFIL_VALID_STATUSES))
        & (F.col("ProblemStatusID").isNull() | (F.col("ProblemStatusID") == 0))
    ).select("OrderID", F.col("LocationNo").alias("FulfilLocationNo"))
    fulfilment = heads.join(details, "OrderID", "left").select("ISISOrderID", "FulfilLocationNo")
    joined = orders.join(src.facilities, "FacilityID").join(
        fulfilment, F.col("ISIS_OrderID") == F.col("ISISOrderID"), "left")
    return joined.select(
        location_fallback(F.col("FulfilLocationNo"), F.col("FacilityLocationNo")).alias("LocationNo"),
        rightmost(F.col("SKU"), fixed.ITEM_CODE_WIDTH).alias("ItemCode"), F.explode(_tags(window, kinds)).alias("t"))


def _v1_web_lines(src: Sources, window: Window, kinds: list[OnlineKind]) -> DataFrame:
    """Web orders at the facility's store."""
    orders = src.having("web_orders", "SKU", fixed.ISTORE_SKU_PREFIX).where(
        ~ci_isin(F.col("OrderStatus"), fixed.WEB_CANCELED_STATUSES)
        & ci_equals(F.col("ItemStatus"), fixed.WEB_SHIPPED_ITEM_STATUS)
        & (F.col("ShippingMethod") != fixed.WEB_PICKUP_SHIPPING_METHOD)
        & F.col("SKU").startswith(fixed.ISTORE_SKU_PREFIX)
        & (F.col("Quantity") > 0)
        & _any_kind(window, kinds)
    )
    return orders.join(src.facilities, "FacilityID").select(
        F.col("FacilityLocationNo").alias("LocationNo"),
        rightmost(F.col("SKU"), fixed.ITEM_CODE_WIDTH).alias("ItemCode"), F.explode(_tags(window, kinds)).alias("t"))


def v1_online(src: Sources, window: Window, istore=("shipped", "refund"), web=("shipped", "refund")) -> DataFrame:
    """The four v1 online branches in one pass, matched to every product by ``right(SKU, 20)``.

    Web shipped sales also require the item master (J12): an inner join, so an
    item that stands there twice counts twice and a missing one not at all.
    """
    parts = []
    if istore:
        parts.append(_v1_istore_lines(src, window, [V1_ISTORE_KINDS[k] for k in istore]))
    if web:
        parts.append(_v1_web_lines(src, window, [V1_WEB_KINDS[k] for k in web]))
    lines = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    products = src.product_master.select("ItemCode", v1_sales_category(F.col("ProductType")).alias("PrCat"), "Cost")
    sums = ["q", "n", "v", "f"]
    priced = join_products(lines.select("LocationNo", "ItemCode", "t.*"), ["BusinessMonth", "LocationNo", "SldTy"], sums,
                           products)
    if "shipped" in web:
        listed = src.item_master.groupBy("ItemCode").agg(F.count(F.lit(1)).alias("times"))
        shipped = F.col("SldTy") == fixed.SLD_WEB_SHIPPED
        times = F.when(shipped, F.col("times")).otherwise(F.lit(1))
        priced = priced.join(listed, "ItemCode", "left").where(times.isNotNull())
        priced = priced.withColumns({c: F.col(c) * times for c in sums})
    return priced.groupBy("BusinessMonth", "LocationNo", "SldTy", "PrCat").agg(
        qty(F.sum("q")).alias("Qty"), money(F.sum(F.col("n") * F.col("Cost"))).alias("Cost"),
        money(F.sum("v")).alias("Val"), money(F.sum("f")).alias("Fee"),
    ).select(*TIDY_COLUMNS)


def v1_istore_shipped(src: Sources, window: Window) -> DataFrame:
    return v1_online(src, window, istore=("shipped",), web=())


def v1_istore_refunds(src: Sources, window: Window) -> DataFrame:
    return v1_online(src, window, istore=("refund",), web=())


def v1_web_shipped(src: Sources, window: Window) -> DataFrame:
    return v1_online(src, window, istore=(), web=("shipped",))


def v1_web_refunds(src: Sources, window: Window) -> DataFrame:
    return v1_online(src, window, istore=(), web=("refund",))


def v1_sales_tidy(src: Sources, window: Window) -> DataFrame:
    """All v1 sales branches: register and Bookworm in one pass, the online ones in another."""
    return store_sales(src, window, v1_products(src)).unionByName(v1_online(src, window).select(*TIDY_COLUMNS))


def v1_transfers(src: Sources, window: Window, directions=("out", "in")) -> DataFrame:
    """Both v1 transfer branches in one pass over the joined lines, bucketed on the header's month."""
    kinds = F.col("TransferType")
    sides = {
        "out": (kinds.isin(list(fixed.V1_XFR_OUT_TYPES)), F.col("LocationNo"), kinds),
        "in": (kinds == fixed.XFR_STORE_TO_STORE, F.col("ToLocationNo"), -kinds),
    }
    keep, rows = F.lit(False), []
    for d in directions:
        counts, store, kind = sides[d]
        keep = keep | counts
        rows.append(F.when(counts, F.struct(store.alias("LocationNo"), kind.alias("XfrTy"))))
    heads = src.xfer_header.where(
        (F.col("StatusCode") == fixed.XFER_HEADER_DONE) & window.contains(F.col("CreateTime")) & keep
    ).select("TransferBinNo", month_bucket(F.col("CreateTime")).alias("BusinessMonth"),
             F.array_compact(F.array(*rows)).alias("sides"))
    lines = src.xfer_detail.where(F.col("StatusCode") == fixed.XFER_DETAIL_DONE).select(
        "TransferBinNo", F.col("DipsItemCode").alias("ItemCode"), F.col("Quantity").alias("q"), F.col("DipsCost").alias("c"))
    tagged = heads.join(lines, "TransferBinNo").select(
        "BusinessMonth", F.explode("sides").alias("side"), "ItemCode", "q", "c"
    ).select("BusinessMonth", "side.*", "ItemCode", "q", "c")
    priced = join_products(tagged, ["BusinessMonth", "LocationNo", "XfrTy"], ["q", "c"],
                           v1_products(src, v1_transfer_category))
    return (
        priced.groupBy("BusinessMonth", "LocationNo", "XfrTy", "PrCat")
        .agg(qty(F.sum("q")).alias("Qty"), money(F.sum("c")).alias("Cost"))
        .select(*XFER_COLUMNS)
    )


def v1_xfers_out(src: Sources, window: Window) -> DataFrame:
    return v1_transfers(src, window, ("out",))


def v1_xfers_in(src: Sources, window: Window) -> DataFrame:
    return v1_transfers(src, window, ("in",))


def v1_xfers_tidy(src: Sources, window: Window) -> DataFrame:
    return v1_transfers(src, window)


# --- fixed values: v1 report columns ---------------------------------------------------------
# (output column, wide column), in v1 output order after the two keys.
V1_REPORT_COLUMNS = (
    ("DistSoldCost", "sDistSoldCost"), ("DistSoldVal", "sDistSoldVal"), ("FrlnSoldCost", "sFrlnSoldCost"),
    ("FrlnSoldVal", "sFrlnSoldVal"), ("ScanSoldQty", "sScanSoldQty"), ("ScanSoldCost", "sScanSoldCost"),
    ("ScanSoldVal", "sScanSoldVal"),
    ("DistTshQty", "DistTshQty"), ("DistTshCost", "DistTshCost"), ("DistDmgQty", "DistDmgQty"),
    ("DistDmgCost", "DistDmgCost"), ("DistDntQty", "DistDntQty"), ("DistDntCost", "DistDntCost"),
    ("TotDistRfiQty", "TotDistRfiQty"), ("TotDistRfiCost", "TotDistRfiCost"),
    ("DistOnlineSoldCost", "oDistSoldCost"), ("DistOnlineSoldVal", "oDistSoldVal"),
    ("FrlnOnlineSoldCost", "oFrlnSoldCost"), ("FrlnOnlineSoldVal", "oFrlnSoldVal"),
    ("DistBookwormSoldCost", "bwDistSoldCost"), ("DistBookwormSoldVal", "bwDistSoldVal"),
    ("FrlnBookwormSoldCost", "bwFrlnSoldCost"), ("FrlnBookwormSoldVal", "bwFrlnSoldVal"),
    ("FrlnTshQty", "FrlnTshQty"), ("FrlnTshCost", "FrlnTshCost"), ("FrlnDmgQty", "FrlnDmgQty"),
    ("FrlnDmgCost", "FrlnDmgCost"), ("FrlnDntQty", "FrlnDntQty"), ("FrlnDntCost", "FrlnDntCost"),
    ("TotFrlnRfiQty", "TotFrlnRfiQty"), ("TotFrlnRfiCost", "TotFrlnRfiCost"),
    ("DistLocXfrOutQty", "DistOStSQty"), ("DistLocXfrOutCost", "DistOStSCost"),
    ("DistLocXfrInQty", "DistIStSQty"), ("DistLocXfrInCost", "DistIStSCost"),
    ("FrlnLocXfrOutQty", "FrlnOStSQty"), ("FrlnLocXfrOutCost", "FrlnOStSCost"),
    ("FrlnLocXfrInQty", "FrlnIStSQty"), ("FrlnLocXfrInCost", "FrlnIStSCost"),
)


def v1_report(src: Sources, window: Window, materialise: bool = True) -> DataFrame:
    """The v1 result set -- dense month x store grid, zero-filled, sorted."""
    wide = combine_wide(pivot_measures(v1_sales_tidy(src, window), SALES_MEASURES),
                        pivot_measures(v1_xfers_tidy(src, window), V1_XFER_MEASURES))
    if materialise:
        checkpoint_dir(src.spark)
        wide = wide.checkpoint(eager=True)
    grid = key_grid(grid_months(wide), grid_locations(wide))
    joined = grid.join(wide, ["BusinessMonth", "LocationNo"], "left")
    cols = [F.col("BusinessMonth"), F.col("LocationNo")]
    for out, w in V1_REPORT_COLUMNS:
        cast = qty if w.endswith("Qty") else money
        cols.append(cast(F.coalesce(F.col(w), F.lit(0))).alias(out))
    return joined.select(*cols).orderBy("BusinessMonth", "LocationNo")
