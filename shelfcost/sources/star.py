"""Derive the rollup's source tables from the driver's star-schema test tables.

The test data is a TPC-H-like star (``orders``, ``lineitem``, ``part``,
``nation``, ``region``); the rollup reads retail tables (register sales,
online orders, fulfilment, transfers...). This adapter maps one onto the
other with deterministic expressions, so every query's work grows with the
star tables. The same mapping is written independently as SQL in
:mod:`shelfcost.oracle` for the DuckDB check.

Only the columns each source needs are selected from the star tables, so the
parquet scans read just those columns.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.columns import money
from shelfcost.session import checkpoint_dir, shuffles_released

# --- fixed values: fixture mapping ---------------------------------------------
# Product type of a part by p_partkey % 20, residues 0 to 19 in order.
PART_TYPE_BY_RESIDUE = ("BDGF", "HBF", "TRF", "VGF", "PGC", "EGC", "SCAN", "SCAN", "HB", "TR",
                        "TOY", "PB", "UHB", "UTR", "SPC", "CALF", "MSC", "NBAF", "XF", "LPF")
# Product class of each product type.
TYPE_CLASSES = (
    ("NEW", ("BDGF", "HBF", "TRF", "VGF", "CALF", "NBAF", "LPF", "PGC", "EGC", "SCAN", "HB", "TR", "TOY",
             "PB", "XF")),
    ("USED", ("UHB", "UTR", "BWRM")),
    ("SPCL", ("SPC",)),
    ("OTHR", ("MSC",)),
)
# Product type of the Bookworm placeholder item.
PLACEHOLDER_TYPE = "BWRM"
N_STORES = 25
# Columns of a line with its order that the tables made from both use.
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
                "l_shipdate", "o_custkey", "o_orderdate", "o_orderstatus")


def pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def _d(col: Column) -> Column:
    return col.cast("date")


class StarTables:
    """Readers of the star tables under one directory, one DataFrame per table."""

    def __init__(self, spark: SparkSession, root: str, store_lines: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.store_lines = store_lines   # keep the lines with their orders in files, for runs that read them in several tables
        self._frames: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._frames[name]


def _lo(t: StarTables) -> DataFrame:
    """lineitem joined to its order (every line has one)."""
    if "_lo" not in t._frames:
        o = t.read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        t._frames["_lo"] = t.read("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return t._frames["_lo"]


def _lines(t: StarTables) -> DataFrame:
    """:func:`_lo` for tables whose next join is not on the order key; read from files, written once, where the set stores lines."""
    if not t.store_lines:
        return _lo(t)
    if "_lines" not in t._frames:
        path = os.path.join(checkpoint_dir(t.spark), f"order_lines-{uuid.uuid4().hex}")
        with shuffles_released(t.spark):
            _lo(t).select(*LINE_COLUMNS).write.option("compression", "zstd").parquet(path)
        t._frames["_lines"] = t.spark.read.parquet(path)
    return t._frames["_lines"]


def locations(t: StarTables) -> DataFrame:
    k = F.col("n_nationkey")
    return t.read("nation").select(
        k.cast("int").alias("LocationID"),
        pad(k + 1, 5).alias("LocationNo"),
        F.col("n_name").alias("Name"),
        F.when(k % 10 == 9, "N").otherwise("Y").alias("RetailStore"),
        F.when(k % 7 == 6, "I").otherwise("A").alias("Status"),
        F.concat(F.lit("D"), (k % 8).cast("string"), F.lit("  ")).alias("DistrictCode"),
    )


def report_locations(t: StarTables) -> DataFrame:
    n = t.read("nation").select("n_nationkey")
    r = t.read("region").select("r_regionkey", "r_name")
    return n.join(r, (F.col("n_nationkey") % 4) == F.col("r_regionkey")).select(
        F.concat(F.lit("D"), (F.col("n_nationkey") % 8).cast("string")).alias("District"),
        F.col("r_name").alias("Region"),
    )


def facilities(t: StarTables) -> DataFrame:
    k = F.col("n_nationkey")
    store = F.when(k % 12 != 7, pad(k + 1, 5))   # some facilities name no store
    return t.read("nation").select(k.cast("int").alias("FacilityID"), store.alias("FacilityLocationNo"))


def product_master(t: StarTables) -> DataFrame:
    types = F.array(*[F.lit(x) for x in PART_TYPE_BY_RESIDUE])
    parts = t.read("part").select(
        pad(F.col("p_partkey"), 20).alias("ItemCode"),
        F.element_at(types, (F.col("p_partkey") % 20 + 1).cast("int")).alias("ProductType"),
        money(F.col("p_retailprice")).alias("Cost"),
    )
    placeholder = t.spark.range(1).select(
        F.lit(fixed.BOOKWORM_PLACEHOLDER_ITEM).alias("ItemCode"),
        F.lit(PLACEHOLDER_TYPE).alias("ProductType"),
        money(0).alias("Cost"),
    )
    return parts.unionByName(placeholder)


def type_classes(spark: SparkSession) -> DataFrame:
    rows = [(ptype, cls) for cls, types in TYPE_CLASSES for ptype in types]
    return spark.createDataFrame(rows, "ProductType string, PTypeClass string")


def product_types(t: StarTables) -> DataFrame:
    """Product types in use by the product master, with their class."""
    used = product_master(t).select("ProductType").distinct()
    return used.join(type_classes(t.spark), "ProductType")


def sales_header(t: StarTables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.read("orders").select(
        (F.col("o_custkey") % N_STORES).cast("int").alias("LocationID"),
        _d(F.col("o_orderdate")).alias("BusinessDate"),
        F.concat(pad(k % 4 + 1, 2), pad(k, 9)).alias("SalesXactionID"),
        F.when(k % 20 == 0, "V").otherwise("A").alias("Status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "R").otherwise("S").alias("XactionType"),
    )


def _placeholder_line() -> Column:
    return ((F.col("l_orderkey") % 5) == 2) & (F.col("l_linenumber") == 1)


def sales_item(t: StarTables) -> DataFrame:
    k = F.col("l_orderkey")
    ret = F.col("l_returnflag") == "R"
    amt = money(F.col("l_extendedprice"))
    return _lines(t).select(
        (F.col("o_custkey") % N_STORES).cast("int").alias("LocationID"),
        _d(F.col("o_orderdate")).alias("BusinessDate"),
        F.concat(pad(k % 4 + 1, 2), pad(k, 9)).alias("SalesXactionId"),
        F.col("l_linenumber").cast("int").alias("LineNumber"),
        F.when(_placeholder_line(), F.lit(fixed.BOOKWORM_PLACEHOLDER_ITEM))
        .otherwise(pad(F.col("l_partkey"), 20)).alias("ItemCode"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.when(ret, "Y").otherwise("N").alias("IsReturn"),
        F.when(ret, -amt).otherwise(amt).alias("ExtendedAmt"),
    )


def bookworm(t: StarTables) -> DataFrame:
    k = F.col("l_orderkey")
    return _lines(t).select(
        (F.col("o_custkey") % N_STORES).cast("int").alias("locationId"),
        pad(k % 4 + 1, 2).alias("tillnumber"),
        k.cast("string").alias("transactionNumber"),
        F.col("l_linenumber").cast("int").alias("detailNumber"),
        F.col("l_partkey").cast("string").alias("SKU"),
        pad((F.col("o_custkey") + 3) % N_STORES + 1, 5).alias("LocationNo"),
    )


def _online_common() -> list[Column]:
    return [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ISIS_OrderID"),
        (F.col("l_suppkey") % N_STORES).cast("int").alias("FacilityID"),
        _d(F.col("o_orderdate")).alias("OrderDate"),
        _d(F.col("l_shipdate")).alias("ShipDate"),
    ]


def istore_orders(t: StarTables) -> DataFrame:
    ret = F.col("l_returnflag") == "R"
    ship = _d(F.col("l_shipdate"))
    status = (F.when(F.col("o_orderstatus") == "F", "Shipped")
              .when(F.col("o_orderstatus") == "O", "Pending")
              .when(F.col("o_orderstatus") == "P", "Cancelled"))
    return _lines(t).select(
        *_online_common(),
        F.concat(F.when(F.col("l_linenumber") == 6, "S").otherwise("D"), pad(F.col("l_partkey"), 20)).alias("SKU"),
        status.alias("OrderStatus"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int")).otherwise(0).alias("ShippedQuantity"),
        money(F.col("l_extendedprice")).alias("Price"),
        money(3.99).alias("ShippingFee"),
        F.when(ret, F.date_add(ship, 20)).alias("RefundDate"),
        F.when(ret, money(F.col("l_extendedprice"))).otherwise(money(0)).alias("RefundAmount"),
    )


def web_orders(t: StarTables) -> DataFrame:
    ret = F.col("l_returnflag") == "R"
    line = F.col("l_linenumber")
    return _lines(t).select(
        *_online_common(),
        F.concat(F.lit("D"), pad(F.col("l_partkey"), 20)).alias("SKU"),
        F.concat(F.lit("M"), F.col("l_orderkey").cast("string")).alias("MarketOrderID"),
        (F.col("l_orderkey") * 8 + line).alias("MarketOrderItemID"),
        F.when(F.col("o_orderstatus") == "P", "canceled").otherwise("open").alias("OrderStatus"),
        F.when(F.col("l_linestatus") == "F", "shipped").otherwise("pending").alias("ItemStatus"),
        F.date_add(_d(F.col("l_shipdate")), 15).alias("SiteLastModifiedDate"),
        F.when(line == 7, "222").when(line == 5, F.lit(None)).otherwise("100").alias("ShippingMethod"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        money(F.col("l_extendedprice")).alias("ExtendedAmount"),
        money(4.99).alias("ShippingAmount"),
        F.when(ret, money(F.col("l_extendedprice"))).otherwise(money(0)).alias("ItemRefundAmount"),
    )


def _fulfil_order_id() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber") + 1000000


def fulfil_header(t: StarTables) -> DataFrame:
    k = F.col("l_orderkey")
    ids = t.read("lineitem").select((k * 8 + F.col("l_linenumber")).alias("ISISOrderID"), "l_orderkey", "l_linenumber")
    # laid out by the order that a header names: neither the distinct nor a join on the order shuffles again
    return ids.repartition("ISISOrderID").distinct().select(
        _fulfil_order_id().alias("OrderID"),
        "ISISOrderID",
        F.when(k % 13 == 0, "SAS").when(k % 2 == 1, "MON").otherwise("HMP").alias("OrderSystem"),
        F.concat(F.lit("M"), k.cast("string")).alias("MarketOrderID"),
    )


def fulfil_detail(t: StarTables) -> DataFrame:
    p = F.col("l_partkey")
    s = F.col("l_suppkey") % 5
    return t.read("lineitem").select(
        _fulfil_order_id().alias("OrderID"),
        pad(p, 20).alias("ItemCode"),
        F.when(p % 4 == 0, F.lit(None)).otherwise(pad(p % N_STORES + 1, 5)).alias("LocationNo"),
        F.when(s == 0, 4).when(s == 1, 2).otherwise(1).alias("Status"),
        F.when(p % 17 == 0, 3).otherwise(F.lit(None)).cast("int").alias("ProblemStatusID"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("MarketOrderItemID"),
    )


def xfer_header(t: StarTables) -> DataFrame:
    k = F.col("o_orderkey")
    r = k % 5
    ttype = F.when(r == 0, 1).when(r == 1, 2).when(r == 2, 3).when(r == 3, 7).when(r == 4, 4)
    return t.read("orders").select(
        k.alias("TransferBinNo"),
        pad(F.col("o_custkey") % N_STORES + 1, 5).alias("LocationNo"),
        pad((F.col("o_custkey") + 11) % N_STORES + 1, 5).alias("ToLocationNo"),
        ttype.cast("int").alias("TransferType"),
        F.when(F.col("o_orderstatus") == "P", 2).otherwise(3).alias("StatusCode"),
        _d(F.col("o_orderdate")).alias("CreateTime"),
    )


def xfer_detail(t: StarTables) -> DataFrame:
    line = F.col("l_linenumber")
    part = t.read("part").select("p_partkey", "p_retailprice")
    created = _d(F.col("o_orderdate"))
    if t.store_lines:
        lines = _lines(t).join(part, F.col("l_partkey") == F.col("p_partkey"))   # the order's date is in the files
    else:
        # by the part first: the lines come out laid out by their order, which is the bin, and a join on it does not shuffle them again
        o = t.read("orders").select("o_orderkey", "o_orderdate")
        lines = t.read("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("l_orderkey").alias("TransferBinNo"),
        pad(F.col("l_partkey"), 20).alias("DipsItemCode"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        money(F.col("p_retailprice")).alias("DipsCost"),
        F.when(line == 4, 2).otherwise(1).alias("StatusCode"),
        created.alias("CreateTime"),
        F.when(line % 2 == 0, F.date_add(created, (line * 9).cast("int"))).alias("UpdateTime"),
    )


def item_master(t: StarTables) -> DataFrame:
    return t.read("part").select(pad(F.col("p_partkey"), 20).alias("ItemCode"))


BUILDERS = {
    "sales_header": sales_header,
    "sales_item": sales_item,
    "locations": locations,
    "report_locations": report_locations,
    "product_master": product_master,
    "product_types": product_types,
    "istore_orders": istore_orders,
    "web_orders": web_orders,
    "facilities": facilities,
    "fulfil_header": fulfil_header,
    "fulfil_detail": fulfil_detail,
    "bookworm": bookworm,
    "xfer_header": xfer_header,
    "xfer_detail": xfer_detail,
    "item_master": item_master,
}
