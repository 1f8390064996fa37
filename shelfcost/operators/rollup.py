"""Key grid and rollup assembly.

The grid is every (month, store) pair seen in this run's wide tables -- the
set of rollup rows a run replaces. It is built without a cross join: each
store row explodes into the calendar months between the run's first and last
month (two dates, the only values that pass through the driver), and a
semi-join keeps the months that occur. The number of months has no cap.

Rows with a NULL key (possible when neither the fulfilment nor the facility
names a store) never reach the grid: :mod:`shelfcost.plans.monthly` splits
them off before pivoting and routes them to a reject table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcost.functions.columns import money, qty
from shelfcost.operators.pivot import KEYS
from shelfcost.sources.schemas import ROLLUP_MEASURES

# --- fixed values: rollup column sources ---------------------------------------------
# Rollup sales columns and the wide-sales measure each is taken from.
ROLLUP_FROM_SALES = (
    ("DistSoldCost", "sDistSoldCost"), ("DistSoldVal", "sDistSoldVal"),
    ("FrlnSoldCost", "sFrlnSoldCost"), ("FrlnSoldVal", "sFrlnSoldVal"),
    ("ScanSoldQty", "sScanSoldQty"), ("ScanSoldCost", "sScanSoldCost"), ("ScanSoldVal", "sScanSoldVal"),
    ("DistOnlineSoldCost", "oDistSoldCost"), ("DistOnlineSoldVal", "oDistSoldVal"),
    ("FrlnOnlineSoldCost", "oFrlnSoldCost"), ("FrlnOnlineSoldVal", "oFrlnSoldVal"),
    ("DistBookwormSoldCost", "bwDistSoldCost"), ("DistBookwormSoldVal", "bwDistSoldVal"),
    ("FrlnBookwormSoldCost", "bwFrlnSoldCost"), ("FrlnBookwormSoldVal", "bwFrlnSoldVal"),
)


def grid_months(*wides: DataFrame) -> DataFrame:
    """Distinct union of the months of the wide tables."""
    out = wides[0].select("BusinessMonth")
    for w in wides[1:]:
        out = out.union(w.select("BusinessMonth"))
    return out.distinct()


def grid_locations(*wides: DataFrame) -> DataFrame:
    """Distinct union of the stores of the wide tables."""
    out = wides[0].select("LocationNo")
    for w in wides[1:]:
        out = out.union(w.select("LocationNo"))
    return out.distinct()


def combine_wide(sales_wide: DataFrame, xfers_wide: DataFrame) -> DataFrame:
    """Both wide tables side by side: full outer join on (month, store).

    Its keys are exactly the union of both tables' keys, so the grid can be
    built from it, and it is the one table the run materialises.
    """
    return sales_wide.join(xfers_wide, list(KEYS), "full")


def key_grid(months: DataFrame, locations: DataFrame) -> DataFrame:
    """Every store x every month of the run, as (BusinessMonth, LocationNo).

    ``months`` is a set of first-of-month dates; a NULL month is not a key, a NULL store is kept.
    """
    first, last = months.agg(F.min("BusinessMonth"), F.max("BusinessMonth")).first()
    if first is None:
        return locations.select(F.lit(None).cast("date").alias("BusinessMonth"), "LocationNo").where(F.lit(False))
    calendar = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    dense = locations.select(F.explode(calendar).alias("BusinessMonth"), "LocationNo")
    return dense.join(months, "BusinessMonth", "left_semi")


def assemble_rollup(grid: DataFrame, wide: DataFrame) -> DataFrame:
    """J14 + P13 + P14: grid left-joined to the combined wide table, zero-filled, in table order."""
    rename = dict(ROLLUP_FROM_SALES)
    joined = grid.join(wide, list(KEYS), "left")
    out = [F.col("BusinessMonth"), F.col("LocationNo")]
    for name, kind in ROLLUP_MEASURES:
        cast = qty if kind == "qty" else money
        out.append(cast(F.coalesce(F.col(rename.get(name, name)), F.lit(0))).alias(name))
    return joined.select(*out)
