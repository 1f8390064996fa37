"""Schemas of the source tables (as used) and of the two owned tables.

Source tables are read with a typed ``select`` of only the columns named here
(column pruning reaches the parquet scan). Text columns are right-trimmed
once at load so equality behaves as in the source database, which ignores
trailing blanks (``'dist  ' = 'dist'``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(19, 4)
S, I, L, D = StringType(), IntegerType(), LongType(), DateType()


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, typ, nullable) for name, typ, nullable in fields])


# --- fixed values: source columns -------------------------------------------------
# table -> [(column, type)]
SOURCE_COLUMNS: dict[str, list[tuple[str, object]]] = {
    "sales_header": [("LocationID", I), ("BusinessDate", D), ("SalesXactionID", S), ("Status", S),
                     ("XactionType", S)],
    "sales_item": [("LocationID", I), ("BusinessDate", D), ("SalesXactionId", S), ("LineNumber", I),
                   ("ItemCode", S), ("Quantity", I), ("IsReturn", S), ("ExtendedAmt", MONEY)],
    "locations": [("LocationID", I), ("LocationNo", S), ("Name", S), ("RetailStore", S), ("Status", S),
                  ("DistrictCode", S)],
    "report_locations": [("District", S), ("Region", S)],
    "product_master": [("ItemCode", S), ("ProductType", S), ("Cost", MONEY)],
    "product_types": [("ProductType", S), ("PTypeClass", S)],
    "istore_orders": [("ISIS_OrderID", L), ("FacilityID", I), ("SKU", S), ("OrderStatus", S),
                      ("ShippedQuantity", I), ("Price", MONEY), ("ShippingFee", MONEY), ("OrderDate", D),
                      ("ShipDate", D), ("RefundDate", D), ("RefundAmount", MONEY)],
    "web_orders": [("ISIS_OrderID", L), ("MarketOrderID", S), ("MarketOrderItemID", L), ("FacilityID", I),
                   ("SKU", S), ("OrderStatus", S), ("ItemStatus", S), ("ShippingMethod", S), ("Quantity", I),
                   ("ExtendedAmount", MONEY), ("ShippingAmount", MONEY), ("ItemRefundAmount", MONEY),
                   ("OrderDate", D), ("ShipDate", D), ("SiteLastModifiedDate", D)],
    "facilities": [("FacilityID", I), ("FacilityLocationNo", S)],
    "fulfil_header": [("OrderID", L), ("ISISOrderID", L), ("OrderSystem", S), ("MarketOrderID", S)],
    "fulfil_detail": [("OrderID", L), ("ItemCode", S), ("LocationNo", S), ("Status", I),
                      ("ProblemStatusID", I), ("MarketOrderItemID", S)],
    "bookworm": [("locationId", I), ("tillnumber", S), ("transactionNumber", S), ("detailNumber", I),
                 ("SKU", S), ("LocationNo", S)],
    "xfer_header": [("TransferBinNo", L), ("LocationNo", S), ("ToLocationNo", S), ("TransferType", I),
                    ("StatusCode", I), ("CreateTime", D)],
    "xfer_detail": [("TransferBinNo", L), ("DipsItemCode", S), ("Quantity", I), ("DipsCost", MONEY),
                    ("StatusCode", I), ("CreateTime", D), ("UpdateTime", D)],
    "item_master": [("ItemCode", S)],
    # optional: the persisted output of the category load (derived from product_types when absent)
    "category_dim": [("ProductType", S), ("PTypeCategory", S), ("PTypeClass", S)],
}

# --- fixed values: physical column names ---------------------------------------
# Columns whose name in the source system differs from the name used here:
# (table, column used here) -> column name in the source table.
PHYSICAL_NAMES = {("facilities", "FacilityLocationNo"): "HPBLocationNo"}

# Sources a deployment may omit; each has a derivation from the required ones.
OPTIONAL_SOURCES = ("category_dim",)
REQUIRED_SOURCES = tuple(n for n in SOURCE_COLUMNS if n not in OPTIONAL_SOURCES)

# --- owned tables ---------------------------------------------------------------

# --- fixed values: rollup columns ------------------------------------------------
# Measures of the persisted rollup, in table order: (name, kind) where kind is
# "amt" (decimal(19,4)) or "qty" (bigint).
ROLLUP_MEASURES: list[tuple[str, str]] = [
    ("DistSoldCost", "amt"), ("DistSoldVal", "amt"), ("FrlnSoldCost", "amt"), ("FrlnSoldVal", "amt"),
    ("ScanSoldQty", "qty"), ("ScanSoldCost", "amt"), ("ScanSoldVal", "amt"),
    ("DistOnlineSoldCost", "amt"), ("DistOnlineSoldVal", "amt"), ("FrlnOnlineSoldCost", "amt"),
    ("FrlnOnlineSoldVal", "amt"),
    ("DistBookwormSoldCost", "amt"), ("DistBookwormSoldVal", "amt"), ("FrlnBookwormSoldCost", "amt"),
    ("FrlnBookwormSoldVal", "amt"),
    ("DistTshQty", "qty"), ("DistTshCost", "amt"), ("FrlnTshQty", "qty"), ("FrlnTshCost", "amt"),
    ("DistDmgQty", "qty"), ("DistDmgCost", "amt"), ("FrlnDmgQty", "qty"), ("FrlnDmgCost", "amt"),
    ("DistDntQty", "qty"), ("DistDntCost", "amt"), ("FrlnDntQty", "qty"), ("FrlnDntCost", "amt"),
    ("TotDistRfiQty", "qty"), ("TotDistRfiCost", "amt"), ("TotFrlnRfiQty", "qty"), ("TotFrlnRfiCost", "amt"),
    ("DistTotXfrOutQty", "qty"), ("DistTotXfrOutCost", "amt"), ("FrlnTotXfrOutQty", "qty"),
    ("FrlnTotXfrOutCost", "amt"),
    ("DistTotXfrInQty", "qty"), ("DistTotXfrInCost", "amt"), ("FrlnTotXfrInQty", "qty"),
    ("FrlnTotXfrInCost", "amt"),
]

ROLLUP = _schema(
    ("BusinessMonth", D, False),
    ("LocationNo", S, False),
    *[(name, MONEY if kind == "amt" else L, True) for name, kind in ROLLUP_MEASURES],
)

# --- fixed values: reject ledger columns -----------------------------------------
# Tidy rows whose month or store is NULL; RunMonth is the month of the run window that the row was read in.
REJECTS = _schema(
    ("Source", S, False), ("RunMonth", D, False), ("BusinessMonth", D, True), ("LocationNo", S, True),
    ("Ty", I, True), ("PrCat", S, True), ("Qty", L, True), ("Cost", MONEY, True), ("Val", MONEY, True), ("Fee", MONEY, True),
)

# --- fixed values: kept tidy state columns ----------------------------------------
STATE = _schema(
    *[(f.name, f.dataType, True) for f in REJECTS.fields], ("Lines", L, False),
)
