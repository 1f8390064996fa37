"""Monthly jobs: category load and the rollup.

``build_rollup`` composes the lazily planned stages; the only materialisation
point is the *tidy* table of the run: all branches' aggregates per month,
store, type and category, sales and transfers side by side. It is tiny at
any input size and is read several times (rejects, both pivots, the key
grid), so it is checkpointed (reliably, to the shared checkpoint folder)
instead of recomputing every branch. All branches feed that one job, so
they run concurrently; everything upstream runs once.

Rows whose month or store is NULL cannot be stored under the rollup's key.
They are split off before the pivots and kept in a ledger by the month of the
run window they were read in, which is committed together with the rollup: a run
replaces its own window's rejects and leaves those of other months. A job with
rejects fails unless it is told to go on without them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcost.functions.columns import MONEY
from shelfcost.functions.dates import Window, resolve_window
from shelfcost.operators import dims, quality, rollup, sales, transfers, writer
from shelfcost.operators.pivot import KEYS, SALES_MEASURES, XFER_MEASURES, pivot_measures
from shelfcost.session import checkpoint_dir
from shelfcost.sources.catalog import Sources


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, lineage cut, survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class RejectedRows(ValueError):
    """Rows with a NULL month or store, which the rollup's key does not admit."""


@dataclass
class RollupRun:
    window: Window
    tidy: DataFrame        # every branch's rows, materialised: Source, RunMonth, keys, Ty, PrCat, Qty, Cost, Val, Fee
    rejects: DataFrame     # the tidy rows with a NULL key
    sales_wide: DataFrame  # pivots of the rows with complete keys
    xfers_wide: DataFrame
    grid: DataFrame
    rollup: DataFrame


def tidy_rows(st: DataFrame, xt: DataFrame, *extra: str) -> DataFrame:
    """Sales and transfer branches as one table, told apart by ``Source``. Sales are read in their own month."""
    s = st.select(F.lit("sales").alias("Source"), F.col("BusinessMonth").alias("RunMonth"), *KEYS, F.col("SldTy").alias("Ty"),
                  "PrCat", "Qty", "Cost", "Val", "Fee", *extra)
    none = F.lit(None).cast(MONEY)
    x = xt.select(F.lit("xfers").alias("Source"), "RunMonth", *KEYS, F.col("XfrTy").alias("Ty"), "PrCat", "Qty", "Cost",
                  none.alias("Val"), none.alias("Fee"), *extra)
    return s.unionByName(x)


def build_rollup(src: Sources, window: Window, materialise_tidy: bool = True,
                 out_window_on: str = "header") -> RollupRun:
    """Plan one run. ``out_window_on="event_time"`` is the opt-in that windows
    outbound transfers on line time (no months past the window)."""
    xfers = transfers.transfers(src, window, out_window_on=out_window_on, run_month=True)
    tidy = tidy_rows(sales.sales_tidy(src, window), xfers)
    return rollup_of(materialise(tidy) if materialise_tidy else tidy, window)


def rollup_of(tidy: DataFrame, window: Window) -> RollupRun:
    """The run that follows from a tidy table alone: rejects, pivots, grid and rollup."""
    good, rejects = quality.split_null_keys(tidy, KEYS)
    sw = pivot_measures(good.where(F.col("Source") == "sales").withColumnRenamed("Ty", "SldTy"), SALES_MEASURES)
    xw = pivot_measures(good.where(F.col("Source") == "xfers").withColumnRenamed("Ty", "XfrTy"), XFER_MEASURES)
    grid = rollup.key_grid(rollup.grid_months(good), rollup.grid_locations(good))
    return RollupRun(window, tidy, rejects, sw, xw, grid, rollup.assemble_rollup(grid, rollup.combine_wide(sw, xw)))


def run_category_load(src: Sources, path: str) -> None:
    """Entry point A: truncate-and-reload the category dimension, under its primary key."""
    cat = dims.category_dim(src)
    quality.enforce_key(cat, ("ProductType",), ("PTypeCategory", "PTypeClass"))
    cat.write.mode("overwrite").parquet(path)


def run_rollup(src: Sources, target_path: str, first_day: dt.date | None = None,
               as_of: dt.date | None = None, out_window_on: str = "header",
               allow_rejects: bool = False) -> RollupRun:
    """Entry point B: roll up one month (or the default window) and replace its keys.

    Rollup and reject ledger get one new version. If there are rejects, the run is refused:
    they are kept aside (:func:`writer.read_refused`), table and ledger stay, and
    :class:`RejectedRows` is raised, unless ``allow_rejects``.
    """
    window = resolve_window(first_day, as_of or dt.date.today())
    run = build_rollup(src, window, out_window_on=out_window_on)
    if not allow_rejects and not run.rejects.isEmpty():
        writer.refuse(src.spark, target_path, run.rejects)
        raise RejectedRows(f"rows with a NULL month or store, see writer.read_refused(spark, {target_path!r})")
    writer.replace_by_key(src.spark, target_path, run.rollup, run.grid, run.rejects, window)
    return run
