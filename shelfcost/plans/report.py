"""Entry point C: the report over the persisted rollup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from shelfcost.functions.dates import report_default_dates
from shelfcost.operators import report, writer
from shelfcost.sources.catalog import Sources


def run_report(src: Sources, rollup_path: str, location_type: str, location: str | None = None,
               start: dt.date | None = None, end: dt.date | None = None,
               as_of: dt.date | None = None) -> DataFrame:
    """Report rows for a location selection and an inclusive month range.

    Missing dates default to the previous month (first to last day) of
    ``as_of``; the month range prunes the rollup's month folders. The stores of a
    selection by store, district or region also skip row groups.
    """
    default_start, default_end = report_default_dates(as_of or dt.date.today())
    selection = report.select_locations(src, location_type, location)
    rows = writer.read_rollup(src.spark, rollup_path)
    if location is not None:
        rows = report.near_stores(rows, selection)
    return report.report(rows, selection, start or default_start, end or default_end)


def report_months(src: Sources, rollup_path: str, as_of: dt.date | None = None) -> DataFrame:
    """The month list of the report: the months that the rollup holds, from its version file alone."""
    return report.month_list(writer.rollup_months(src.spark, rollup_path), as_of or dt.date.today())
