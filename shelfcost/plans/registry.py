"""Registry of named queries over the star-schema test tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and runs over whole tables.
Run parameters are the fixture's: ``as_of`` 2001-08-15, so the default
window is [1998-01-01, 2001-08-01); re-run month 2000-03 for the
one-month window and the replace-by-key writer; report selections as
listed below. :mod:`shelfcost.oracle` states the same queries as SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.columns import bookworm_xaction_id, item_code_from_sku, location_fallback, signed_quantity
from shelfcost.functions.dates import report_default_end_col, report_default_start_col, resolve_window, month_bucket
from shelfcost.operators import dims, legacy, quality, report, rollup, sales, transfers, versions, writer
from shelfcost.operators.pivot import KEYS, SALES_MEASURES, XFER_MEASURES, pivot_measures
from shelfcost.plans import incremental
from shelfcost.plans.monthly import build_rollup
from shelfcost.plans.report import report_months, run_report
from shelfcost.sources.catalog import Sources, from_frames, from_star
from shelfcost.sources.schemas import REQUIRED_SOURCES

# --- fixture run parameters ----------------------------------------------------------
AS_OF = dt.date(2001, 8, 15)
WINDOW = resolve_window(None, AS_OF)                   # [1998-01-01, 2001-08-01)
RERUN_MONTH = dt.date(2000, 3, 17)
WINDOW_ONE = resolve_window(RERUN_MONTH, AS_OF)        # [2000-03-01, 2000-04-01)
REPORT_START = dt.date(1998, 1, 1)                     # every rollup month
REPORT_END = dt.date(2001, 12, 31)
RANGE_START = dt.date(2000, 1, 1)                      # inclusive month range check
RANGE_END = dt.date(2000, 6, 30)
STORE = "00003"
DISTRICT = "D2"
REGION = "ASIA"
UNKNOWN_TYPE = "Country"

SOURCE_NAMES = REQUIRED_SOURCES


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    return from_star(spark, sf_dir)


def _run(src: Sources, window=WINDOW):
    return src.memo(f"run:{window.start}:{window.end}", lambda: build_rollup(src.stored(), window))


def _rollup(spark, d):
    return _run(_src(spark, d)).rollup


def _write(src: Sources) -> str:
    path = writer.scratch_table(src.spark, "rollup")
    run = _run(src)
    writer.replace_by_key(src.spark, path, run.rollup, run.grid)
    return path


def _persisted(src: Sources) -> str:
    """The written, month-partitioned rollup that the reports read; built once per source set."""
    return src.memo("persisted rollup", lambda: _write(src))


def _report(location_type, location, start=REPORT_START, end=REPORT_END):
    """Entry point C as deployed: the report over the persisted rollup."""
    def q(spark, d):
        src = _src(spark, d)
        return run_report(src, _persisted(src), location_type, location, start, end)
    return q


def rollup_scan(spark, d):
    return writer.read_rollup(spark, _persisted(_src(spark, d)))


def rollup_replace_by_key(spark, d):
    """A table of its own (it is changed), re-run for one month."""
    src = _src(spark, d)
    path = _write(src)
    one = _run(src, WINDOW_ONE)
    writer.replace_by_key(spark, path, one.rollup, one.grid)
    return writer.read_rollup(spark, path)


def rollup_delete_keys(spark, d):
    src = _src(spark, d)
    return writer.delete_keys(_run(src).rollup, _run(src, WINDOW_ONE).grid)


def rollup_rejects(spark, d):
    return _run(_src(spark, d)).rejects.drop("RunMonth")


def rollup_rejects_rerun(spark, d):
    """K8: the reject ledger after a run of the default window and a re-run of one month."""
    src = _src(spark, d)
    path = writer.scratch_table(spark, "rollup")
    for window in (WINDOW, WINDOW_ONE):
        run = _run(src, window)
        writer.replace_by_key(spark, path, run.rollup, run.grid, run.rejects, window)
    return writer.read_rejects(spark, path)


def tidy_incremental(spark, d):
    """A1-A9 by signed deltas: the state kept before returns were keyed and bins were updated, and the changes since."""
    new = _src(spark, d).stored("xfer_detail")
    early = {
        "sales_item": new.sales_item.where(F.col("IsReturn") == "N"),
        "xfer_detail": new.xfer_detail.where(F.col("UpdateTime").isNull()),
    }
    old = from_frames(spark, {n: early.get(n, new.table(n)) for n in new.names()})
    path = writer.scratch_table(spark, "rollup")
    incremental.start(old, path, WINDOW, allow_rejects=True)
    incremental.apply_changes(new, path, incremental.between(old, new), WINDOW, allow_rejects=True)
    return incremental.read_state(new, path).drop("RunMonth", "Lines")


def rollup_rolled_back(spark, d):
    """K6: a run, a version without the re-run month, and the way back to the first."""
    src = _src(spark, d)
    path = _write(src)
    first = versions.load(spark, path)
    month = str(WINDOW_ONE.start)
    versions.commit(spark, path, first, {writer.ROLLUP_TABLE: {month: None}})
    versions.rollback(spark, path, first.number)
    return writer.read_rollup(spark, path)


def report_months_q(spark, d):
    src = _src(spark, d)
    return report_months(src, _persisted(src), AS_OF)


def dq_rollup_duplicate_keys(spark, d):
    """K7 where it can fire: the table with the re-run month's rows added, before the old ones are deleted."""
    src = _src(spark, d)
    both = writer.read_rollup(spark, _persisted(src)).unionByName(_run(src, WINDOW_ONE).rollup)
    return quality.duplicate_keys(both, ["BusinessMonth", "LocationNo"])


def dq_category_duplicate_keys(spark, d):
    """K7 of the category table: a load appended to a table that holds the earlier load's new goods."""
    cat = dims.category_dim(_src(spark, d))
    return quality.duplicate_keys(cat.unionByName(cat.where(F.col("PTypeClass") == fixed.NEW_CLASS)), ["ProductType"])


def _window_flags(window):
    def q(spark, d):
        si = _src(spark, d).sales_item
        return si.select(
            "SalesXactionId", "LineNumber", "BusinessDate",
            F.lit(window.start).alias("WindowStart"), F.lit(window.end).alias("WindowEnd"),
            window.contains(F.col("BusinessDate")).alias("InWindow"),
        )
    return q


def _branch(fn, window=WINDOW):
    return lambda spark, d: fn(_src(spark, d), window)


def join_sales_header_item(spark, d):
    src = _src(spark, d)
    h = src.sales_header.select("LocationID", "BusinessDate", F.col("SalesXactionID").alias("SalesXactionId"),
                                "Status", "XactionType")
    return src.sales_item.join(h, sales.TXN_KEYS)


def join_bookworm_items(spark, d):
    src = _src(spark, d)
    bk = sales.bookworm_keyed(src)
    return src.sales_item.join(
        bk,
        (F.col("LocationID") == F.col("BkLocationID"))
        & (F.col("SalesXactionId") == F.col("BkXactionId"))
        & (F.col("LineNumber") == F.col("BkLineNumber")),
    ).select("LocationID", "SalesXactionId", "LineNumber", "ItemCode", "BookwormItemCode",
             F.col("BookwormLocationNo").alias("BookwormLocationNo"))


def join_xfer_header_detail(spark, d):
    src = _src(spark, d)
    bins = src.xfer_header.select("TransferBinNo", "LocationNo", "ToLocationNo", "TransferType",
                                F.col("StatusCode").alias("HeaderStatus"), F.col("CreateTime").alias("HeaderTime"))
    bin_lines = src.xfer_detail.select("TransferBinNo", "DipsItemCode", "Quantity", "DipsCost",
                                F.col("StatusCode").alias("DetailStatus"), "CreateTime", "UpdateTime")
    return bins.join(bin_lines, "TransferBinNo")


def month_bucket_q(spark, d):
    si = _src(spark, d).sales_item
    return si.select("SalesXactionId", "LineNumber", "BusinessDate",
                     month_bucket(F.col("BusinessDate")).alias("BusinessMonth"))


def signed_quantity_q(spark, d):
    si = _src(spark, d).sales_item
    return si.select("SalesXactionId", "LineNumber", "Quantity", "IsReturn",
                     signed_quantity(F.col("Quantity"), F.col("IsReturn")).alias("SignedQty"))


def location_fallback_q(spark, d):
    src = _src(spark, d)
    heads = src.fulfil_header.select(F.col("OrderID").alias("HeadOrderID"), "ISISOrderID")
    fulfil = src.fulfil_detail.select(F.col("OrderID").alias("LineOrderID"),
                                      F.col("LocationNo").alias("FulfilLocationNo"))
    return (
        src.istore_orders.select("ISIS_OrderID", "FacilityID")
        .join(src.facilities, "FacilityID")
        .join(heads, F.col("ISIS_OrderID") == F.col("ISISOrderID"))
        .join(fulfil, F.col("HeadOrderID") == F.col("LineOrderID"))
        .select("ISIS_OrderID", "FulfilLocationNo", "FacilityLocationNo",
                location_fallback(F.col("FulfilLocationNo"), F.col("FacilityLocationNo")).alias("LocationNo"))
    )


def bookworm_xaction_id_q(spark, d):
    bk = _src(spark, d).bookworm
    return bk.select("locationId", "tillnumber", "transactionNumber", "detailNumber",
                     bookworm_xaction_id(F.col("tillnumber"), F.col("transactionNumber")).alias("XactionId"))


def bookworm_sku_pad_q(spark, d):
    bk = _src(spark, d).bookworm
    return bk.select("SKU", item_code_from_sku(F.col("SKU")).alias("ItemCode"))


def report_default_dates_q(spark, d):
    sh = _src(spark, d).sales_header
    days = sh.select(F.col("BusinessDate").alias("AsOf")).distinct()
    return days.select("AsOf", report_default_start_col(F.col("AsOf")).alias("StartDate"),
                       report_default_end_col(F.col("AsOf")).alias("EndDate"))


def dq_null_keys(spark, d):
    return rollup_rejects(spark, d).select("Source", "BusinessMonth", "LocationNo", "Ty", "PrCat")


def _v1_tidy_wide(kind):
    def q(spark, d):
        src = _src(spark, d).stored()
        if kind == "sales":
            return pivot_measures(legacy.v1_sales_tidy(src, WINDOW), SALES_MEASURES)
        return pivot_measures(legacy.v1_xfers_tidy(src, WINDOW), legacy.V1_XFER_MEASURES)
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources (S1-S19)
    **{f"src_{n}": (lambda n: lambda spark, d: _src(spark, d).table(n))(n) for n in SOURCE_NAMES},
    "category_dim": lambda spark, d: dims.category_dim(_src(spark, d)),
    "rollup_scan": rollup_scan,
    "month_dim": lambda spark, d: report.month_dim(_src(spark, d), AS_OF),
    "report_months": report_months_q,
    "location_dim": lambda spark, d: report.location_dim(_src(spark, d)),
    # parameters and derived columns
    "window_default": _window_flags(WINDOW),
    "window_one_month": _window_flags(WINDOW_ONE),
    "month_bucket": month_bucket_q,
    "signed_quantity": signed_quantity_q,
    "location_fallback": location_fallback_q,
    "bookworm_xaction_id": bookworm_xaction_id_q,
    "bookworm_sku_pad": bookworm_sku_pad_q,
    "report_default_dates": report_default_dates_q,
    # joins
    "join_sales_header_item": join_sales_header_item,
    "join_bookworm_items": join_bookworm_items,
    "join_xfer_header_detail": join_xfer_header_detail,
    # sales branches (A1-A6) and tidy union (K2)
    "sales_register": _branch(sales.sales_register),
    "sales_istore_shipped": _branch(sales.sales_istore_shipped),
    "sales_istore_refunds": _branch(sales.sales_istore_refunds),
    "sales_web_shipped": _branch(sales.sales_web_shipped),
    "sales_web_refunds": _branch(sales.sales_web_refunds),
    "sales_bookworm": _branch(sales.sales_bookworm),
    "sales_tidy": lambda spark, d: sales.sales_tidy(_src(spark, d).stored(), WINDOW),
    "sales_wide": lambda spark, d: pivot_measures(sales.sales_tidy(_src(spark, d).stored(), WINDOW), SALES_MEASURES),
    # transfers
    "xfers_out": _branch(transfers.xfers_out),
    "xfers_in": _branch(transfers.xfers_in),
    "xfers_tidy": _branch(transfers.xfers_tidy),
    "xfers_wide": lambda spark, d: pivot_measures(transfers.xfers_tidy(_src(spark, d), WINDOW), XFER_MEASURES),
    # grid and rollup
    "grid_months": lambda spark, d: rollup.grid_months(quality.split_null_keys(_run(_src(spark, d)).tidy, KEYS)[0]),
    "grid_locations": lambda spark, d: rollup.grid_locations(quality.split_null_keys(_run(_src(spark, d)).tidy, KEYS)[0]),
    "key_grid": lambda spark, d: _run(_src(spark, d)).grid,
    "rollup": _rollup,
    "rollup_delete_keys": rollup_delete_keys,
    "rollup_replace_by_key": rollup_replace_by_key,
    "rollup_rolled_back": rollup_rolled_back,
    "tidy_incremental": tidy_incremental,
    # quality
    "rollup_rejects": rollup_rejects,
    "rollup_rejects_rerun": rollup_rejects_rerun,
    "dq_rollup_duplicate_keys": dq_rollup_duplicate_keys,
    "dq_category_duplicate_keys": dq_category_duplicate_keys,
    "dq_null_keys": dq_null_keys,
    # location selection and report
    "loc_all": lambda spark, d: report.select_locations(_src(spark, d), fixed.LOC_ALL, None),
    "loc_store": lambda spark, d: report.select_locations(_src(spark, d), fixed.LOC_STORE, STORE),
    "loc_district": lambda spark, d: report.select_locations(_src(spark, d), fixed.LOC_DISTRICT, DISTRICT),
    "loc_region": lambda spark, d: report.select_locations(_src(spark, d), fixed.LOC_REGION, REGION),
    "loc_unknown": lambda spark, d: report.select_locations(_src(spark, d), UNKNOWN_TYPE, REGION),
    "report_all_locations": _report(fixed.LOC_ALL, None),
    "report_store": _report(fixed.LOC_STORE, STORE),
    "report_district": _report(fixed.LOC_DISTRICT, DISTRICT),
    "report_region": _report(fixed.LOC_REGION, REGION),
    "report_unknown": _report(UNKNOWN_TYPE, REGION),
    "report_date_range": _report(fixed.LOC_ALL, None, RANGE_START, RANGE_END),
    "report_persisted_region": _report(fixed.LOC_REGION, REGION, RANGE_START, RANGE_END),
    "report_formatted": lambda spark, d: report.report_formatted(_report(fixed.LOC_ALL, None)(spark, d)),
    "report_long": lambda spark, d: report.report_long(_report(fixed.LOC_ALL, None)(spark, d)),
    # v1 rule set
    "v1_sales_classify": lambda spark, d: legacy.v1_sales_classify(_src(spark, d)),
    "v1_xfers_classify": lambda spark, d: legacy.v1_xfers_classify(_src(spark, d)),
    "v1_sales_register": _branch(legacy.v1_sales_register),
    "v1_istore_shipped": _branch(legacy.v1_istore_shipped),
    "v1_istore_refunds": _branch(legacy.v1_istore_refunds),
    "v1_web_shipped": _branch(legacy.v1_web_shipped),
    "v1_web_refunds": _branch(legacy.v1_web_refunds),
    "v1_sales_bookworm": _branch(legacy.v1_sales_bookworm),
    "v1_xfers_out": _branch(legacy.v1_xfers_out),
    "v1_xfers_in": _branch(legacy.v1_xfers_in),
    "v1_sales_wide": _v1_tidy_wide("sales"),
    "v1_xfers_wide": _v1_tidy_wide("xfers"),
    "v1_report": lambda spark, d: legacy.v1_report(_src(spark, d).stored(), WINDOW),
}
