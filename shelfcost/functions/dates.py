"""Date parameters and month buckets.

Window arithmetic is pure Python on the driver (two literal bounds per run),
so the bounds reach the parquet scans as plain ``>=`` / ``<`` comparisons on
raw date columns and are pushed down. Month buckets are ``trunc(d, 'MM')``
cast to date, which accepts both DATE and TIMESTAMP inputs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcost import fixed


@dataclass(frozen=True)
class Window:
    """Half-open run window ``[start, end)``."""

    start: dt.date
    end: dt.date

    def contains(self, col: Column) -> Column:
        """Sargable half-open range on a raw date/timestamp column."""
        return (col >= F.lit(self.start)) & (col < F.lit(self.end))

    def contains_first(self, preferred: Column, fallback: Column) -> Column:
        """``coalesce(preferred, fallback)`` in the window, stated on the raw columns.

        Exactly equivalent to ``contains(coalesce(preferred, fallback))`` but
        each arm compares a raw column, so parquet can push the disjunction
        into the scan instead of reading the whole history.
        """
        return self.contains(preferred) | (preferred.isNull() & self.contains(fallback))

    def months(self) -> list[dt.date]:
        """First days of the window's months."""
        out, month = [], first_of_month(self.start)
        while month < self.end:
            out.append(month)
            month = add_months(month, 1)
        return out


def first_of_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months(d: dt.date, months: int) -> dt.date:
    """First-of-month arithmetic that tolerates crossing a year boundary."""
    index = d.year * 12 + (d.month - 1) + months
    return dt.date(index // 12, index % 12 + 1, 1)


def resolve_window(first_day: dt.date | None, as_of: dt.date) -> Window:
    """Run window of the monthly rollup.

    A month given: ``[start of that month, start of next month)``.
    No month: ``[Jan 1 three years before as_of, first of as_of's month)``.
    """
    if first_day is not None:
        start = first_of_month(first_day)
        return Window(start, add_months(start, 1))
    return Window(dt.date(as_of.year - fixed.DEFAULT_WINDOW_YEARS_BACK, 1, 1), first_of_month(as_of))


def report_default_dates(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Report defaults: first and last day of the month before ``as_of``.

    Month arithmetic goes through :func:`add_months`, so January yields
    December of the previous year instead of an invalid month 0.
    """
    this_month = first_of_month(as_of)
    return add_months(this_month, -1), this_month - dt.timedelta(days=1)


def month_list_start(as_of: dt.date) -> dt.date:
    """First month offered by the report's month list: Jan 1, three years back."""
    return dt.date(as_of.year - fixed.MONTH_LIST_YEARS_BACK, 1, 1)


# --- Column forms -------------------------------------------------------------

def month_bucket(col: Column) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(col, "MM").cast("date")


def report_default_start_col(as_of: Column) -> Column:
    return F.add_months(F.trunc(as_of, "MM"), -1)


def report_default_end_col(as_of: Column) -> Column:
    return F.date_sub(F.trunc(as_of, "MM"), 1)

