"""Report operators: location selection, the report query and its variants.

``report`` joins the rollup to the selected stores and keeps months in the
*inclusive* range ``[start, end]``; on the partitioned table the month range
prunes folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.columns import MONEY, ci_equals
from shelfcost.functions.dates import month_bucket, month_list_start
from shelfcost.sources.catalog import Sources

# --- fixed values: report columns ------------------------------------------------------
# (report column, rollup column), in report order.
REPORT_COLUMNS = (
    ("BusinessMonth", "BusinessMonth"), ("LocationNo", "LocationNo"),
    ("DistSoldCost", "DistSoldCost"), ("FrlnSoldCost", "FrlnSoldCost"), ("ScanSoldCost", "ScanSoldCost"),
    ("DistSoldAmt", "DistSoldVal"), ("FrlnSoldAmt", "FrlnSoldVal"), ("ScanSoldAmt", "ScanSoldVal"),
    ("ScanSoldQty", "ScanSoldQty"),
    ("DistOnlineSoldCost", "DistOnlineSoldCost"), ("FrlnOnlineSoldCost", "FrlnOnlineSoldCost"),
    ("DistOnlineSoldAmt", "DistOnlineSoldVal"), ("FrlnOnlineSoldAmt", "FrlnOnlineSoldVal"),
    ("DistBookwormSoldCost", "DistBookwormSoldCost"), ("FrlnBookwormSoldCost", "FrlnBookwormSoldCost"),
    ("DistBookwormSoldAmt", "DistBookwormSoldVal"), ("FrlnBookwormSoldAmt", "FrlnBookwormSoldVal"),
    ("DistTotalTransfersInCost", "DistTotXfrInCost"), ("DistTotalTransfersOutCost", "DistTotXfrOutCost"),
    ("FrlnTotalTransfersInCost", "FrlnTotXfrInCost"), ("FrlnTotalTransfersOutCost", "FrlnTotXfrOutCost"),
    ("DistTotalTransfersInQty", "DistTotXfrInQty"), ("DistTotalTransfersOutQty", "DistTotXfrOutQty"),
    ("FrlnTotalTransfersInQty", "FrlnTotXfrInQty"), ("FrlnTotalTransfersOutQty", "FrlnTotXfrOutQty"),
    ("DistTotalRfiCost", "TotDistRfiCost"), ("FrlnTotalRfiCost", "TotFrlnRfiCost"),
    ("DistTotalRfiQty", "TotDistRfiQty"), ("FrlnTotalRfiQty", "TotFrlnRfiQty"),
    ("DistTrashCost", "DistTshCost"), ("DistDamageCost", "DistDmgCost"), ("DistDonateCost", "DistDntCost"),
    ("FrlnTrashCost", "FrlnTshCost"), ("FrlnDamageCost", "FrlnDmgCost"), ("FrlnDonateCost", "FrlnDntCost"),
    ("DistTrashQty", "DistTshQty"), ("DistDamageQty", "DistDmgQty"), ("DistDonateQty", "DistDntQty"),
    ("FrlnTrashQty", "FrlnTshQty"), ("FrlnDamageQty", "FrlnDmgQty"), ("FrlnDonateQty", "FrlnDntQty"),
)
# Column bands of the report layout: (band title, number of columns after the keys).
REPORT_BANDS = (
    ("In-Store Sales", 7),
    ("Online Sales", 4),
    ("Bookworm Sales", 4),
    ("Total Transfers In/Out", 8),
    ("Total Removed from Inventory Transfers", 4),
    ("Trash/Damage/Donate Transfers", 12),
)

MEASURE_NAMES = tuple(name for name, _ in REPORT_COLUMNS[2:])


def _is_amount(name: str) -> bool:
    return name.endswith("Cost") or name.endswith("Amt")


def band_of() -> dict[str, str]:
    out, i = {}, 0
    for band, width in REPORT_BANDS:
        for name in MEASURE_NAMES[i:i + width]:
            out[name] = band
        i += width
    return out


# --- location selection (R1-R5) ---------------------------------------------------------

def _active_stores(src: Sources) -> DataFrame:
    return src.locations.where(
        (F.col("RetailStore") == fixed.RETAIL_STORE_FLAG) & (F.col("Status") == fixed.LOCATION_ACTIVE)
    )


def _label(df: DataFrame) -> DataFrame:
    return df.select("LocationNo", F.concat(F.col("LocationNo"), F.lit(" "), F.col("Name")).alias("LocationName"))


def selectors(src: Sources) -> DataFrame:
    """Every (FilterType, DynFilter) pair the report accepts, with each store it selects.

    The pair is data, so an unknown type or value matches no row and selects
    nothing: an empty report, not an error. "All Locations" takes no value.
    """
    stores = _active_stores(src).select("LocationNo", "Name", "DistrictCode")
    regions = src.report_locations.select("District", "Region").distinct()

    def pairs(df: DataFrame, kind: str, value: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("FilterType"), value.alias("DynFilter"), "LocationNo", "Name")

    return (
        pairs(stores, fixed.LOC_ALL, F.lit(None).cast("string"))
        .unionByName(pairs(stores, fixed.LOC_STORE, F.col("LocationNo")))
        .unionByName(pairs(stores, fixed.LOC_DISTRICT, F.col("DistrictCode")))
        .unionByName(pairs(stores.join(regions, F.col("DistrictCode") == F.col("District")), fixed.LOC_REGION,
                           F.col("Region")))
    )


def select_locations(src: Sources, location_type: str, location: str | None) -> DataFrame:
    """Stores chosen by the report's (LocationType, Location) pair; text is compared ignoring case."""
    every = F.col("FilterType") == fixed.LOC_ALL
    one = F.lower("DynFilter") == F.lower(F.lit(location))
    chosen = selectors(src).where(ci_equals(F.col("FilterType"), location_type) & (every | one))
    return _label(chosen).distinct()


def near_stores(rollup: DataFrame, selection: DataFrame) -> DataFrame:
    """Rollup rows between the first and the last selected store.

    Two values pass through the driver. They reach the scan, whose row groups are in store order, so those of other
    stores are skipped; the join with the selection decides.
    """
    first, last = selection.agg(F.min("LocationNo"), F.max("LocationNo")).first()
    return rollup.where(F.col("LocationNo").between(F.lit(first), F.lit(last)))


# --- report (R6) -------------------------------------------------------------------------

def report(rollup: DataFrame, selection: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rollup rows of the selected stores, months in ``[start, end]``, report names, sorted."""
    rows = rollup.where(F.col("BusinessMonth").between(F.lit(start), F.lit(end)))
    rows = rows.join(selection.select("LocationNo"), "LocationNo")
    return rows.select(*[F.col(src).alias(dst) for dst, src in REPORT_COLUMNS]).orderBy("BusinessMonth", "LocationNo")


def currency(col: Column) -> Column:
    """'$'#,0.00;('$'#,0.00): two decimals rounded half away from zero, parentheses when negative."""
    r = F.round(col, 2)
    text = F.format_number(F.abs(r), 2)
    return (F.when(r < 0, F.concat(F.lit("($"), text, F.lit(")")))
            .otherwise(F.concat(F.lit(fixed.CURRENCY_PREFIX), text)))


def report_formatted(rep: DataFrame) -> DataFrame:
    """Amounts as currency text, month as M/d/yyyy, quantities untouched."""
    cols = [F.date_format("BusinessMonth", "M/d/yyyy").alias("BusinessMonth"), F.col("LocationNo")]
    for name in MEASURE_NAMES:
        cols.append(currency(F.col(name)).alias(name) if _is_amount(name) else F.col(name))
    return rep.select(*cols)


def report_long(rep: DataFrame) -> DataFrame:
    """One row per (month, store, measure) with its column band; values as decimal(19,4)."""
    bands = band_of()
    entries = [
        F.struct(F.lit(bands[n]).alias("Band"), F.lit(n).alias("Measure"), F.col(n).cast(MONEY).alias("Value"))
        for n in MEASURE_NAMES
    ]
    return rep.select("BusinessMonth", "LocationNo", F.explode(F.array(*entries)).alias("m")).select(
        "BusinessMonth", "LocationNo", "m.Band", "m.Measure", "m.Value"
    )


# --- parameter dimensions (R8, R9) ---------------------------------------------------------

def month_dim(src: Sources, as_of: dt.date) -> DataFrame:
    """Months offered by the report: months with register history from Jan 1 three
    years back through the as-of month, with label and month end."""
    first = month_list_start(as_of)
    months = (
        src.sales_header.where((F.col("BusinessDate") >= F.lit(first)) & (F.col("BusinessDate") <= F.lit(as_of)))
        .select(month_bucket(F.col("BusinessDate")).alias("PARAMDATE"))
        .distinct()
    )
    return _labelled(months)


def month_list(months: DataFrame, as_of: dt.date) -> DataFrame:
    """:func:`month_dim` over the months that the rollup holds (``BusinessMonth``), which needs no fact table."""
    held = months.where(F.col("BusinessMonth").between(F.lit(month_list_start(as_of)), F.lit(as_of)))
    return _labelled(held.select(F.col("BusinessMonth").alias("PARAMDATE")))


def _labelled(months: DataFrame) -> DataFrame:
    return months.select(
        "PARAMDATE",
        F.date_format("PARAMDATE", "MMMM yyyy").alias("MonthYearPARAM"),
        F.last_day("PARAMDATE").alias("LastDayOfMonth"),
    )


def location_dim(src: Sources) -> DataFrame:
    """Allowed (DynFilter, DynFilterLabel) values per FilterType, inferred from the selectors."""
    stores = _active_stores(src)
    all_row = src.spark.range(1).select(
        F.lit(fixed.LOC_ALL).alias("FilterType"), F.lit(fixed.LOC_ALL).alias("DynFilter"),
        F.lit(fixed.LOC_ALL).alias("DynFilterLabel"),
    )
    store_rows = _label(stores).select(
        F.lit(fixed.LOC_STORE).alias("FilterType"), F.col("LocationNo").alias("DynFilter"),
        F.col("LocationName").alias("DynFilterLabel"),
    )
    districts = stores.select("DistrictCode").distinct()
    district_rows = districts.select(
        F.lit(fixed.LOC_DISTRICT).alias("FilterType"), F.col("DistrictCode").alias("DynFilter"),
        F.col("DistrictCode").alias("DynFilterLabel"),
    )
    regions = (src.report_locations.join(districts, F.col("District") == F.col("DistrictCode"))
               .select("Region").distinct())
    region_rows = regions.select(
        F.lit(fixed.LOC_REGION).alias("FilterType"), F.col("Region").alias("DynFilter"),
        F.col("Region").alias("DynFilterLabel"),
    )
    return all_row.unionByName(store_rows).unionByName(district_rows).unionByName(region_rows)
