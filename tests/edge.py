"""Hand-made source tables for edge cases.

``make_sources(spark, sales_item=[{...}], ...)`` builds a :class:`Sources`
whose tables have the declared source schemas; tables not given are empty,
columns not given are NULL.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import StructField, StructType

from shelfcost.sources.catalog import from_frames
from shelfcost.sources.schemas import OPTIONAL_SOURCES, SOURCE_COLUMNS

D = dt.date


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.0001"))


# A small consistent world: two stores, a few products, one facility each.
BASE = {
    "locations": [
        {"LocationID": 1, "LocationNo": "00001", "Name": "ONE", "RetailStore": "Y", "Status": "A",
         "DistrictCode": "D1  "},
        {"LocationID": 2, "LocationNo": "00002", "Name": "TWO", "RetailStore": "Y", "Status": "A",
         "DistrictCode": "D2  "},
    ],
    "report_locations": [{"District": "D1", "Region": "NORTH"}, {"District": "D2", "Region": "SOUTH"}],
    "facilities": [{"FacilityID": 1, "FacilityLocationNo": "00001"}, {"FacilityID": 2, "FacilityLocationNo": "00002"}],
    "product_types": [
        {"ProductType": "HB", "PTypeClass": "NEW"},
        {"ProductType": "TRF", "PTypeClass": "NEW"},
        {"ProductType": "SCAN", "PTypeClass": "NEW"},
        {"ProductType": "PGC ", "PTypeClass": "NEW"},
        {"ProductType": "UHB", "PTypeClass": "USED"},
        {"ProductType": "ODD", "PTypeClass": "WEIRD"},
    ],
    "product_master": [
        {"ItemCode": "00000000000000000001", "ProductType": "HB", "Cost": money(5)},
        {"ItemCode": "00000000000000000002", "ProductType": "TRF", "Cost": money(7)},
        {"ItemCode": "00000000000000000003", "ProductType": "SCAN", "Cost": money(2)},
        {"ItemCode": "00000000000000000004", "ProductType": "PGC ", "Cost": money(10)},
        {"ItemCode": "00000000000000000005", "ProductType": "UHB", "Cost": money(1)},
        {"ItemCode": "00000000000000000006", "ProductType": "ODD", "Cost": money(1)},
    ],
}


def make_sources(spark, base: bool = True, **tables):
    data = dict(BASE) if base else {}
    data.update(tables)
    frames = {}
    for name, cols in SOURCE_COLUMNS.items():
        if name in OPTIONAL_SOURCES and name not in data:
            continue
        schema = StructType([StructField(c, t, True) for c, t in cols])
        rows = [tuple(r.get(c) for c, _ in cols) for r in data.get(name, [])]
        frames[name] = spark.createDataFrame(rows, schema)
    return from_frames(spark, frames)


def item(code: int) -> str:
    return f"{code:020d}"
