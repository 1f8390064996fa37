"""Conditional pivots of the tidy tables, generated from a measure spec.

Each wide measure is ``sum(case when <category and type match> then <value>
else 0 end)``, one hash aggregate over (BusinessMonth, LocationNo) with
partial (map-side) aggregation. ``groupBy().pivot()`` is not used: it yields
NULL for absent combinations and cannot express overlapping scopes
(``dist`` counting ``scan``, removal totals, all-channel totals).

The spec is data, so the same list also generates the oracle SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.columns import money, qty

KEYS = ("BusinessMonth", "LocationNo")


@dataclass(frozen=True)
class Measure:
    name: str
    value: str                      # tidy column summed: Qty, Cost or Val
    cats: tuple[str, ...]           # PrCat values that count
    type_col: str                   # SldTy or XfrTy
    type_eq: tuple[int, ...] = ()   # type codes that count (empty = any)
    type_abs_gt: int | None = None  # alternatively: abs(type) > n

    @property
    def kind(self) -> str:
        return "qty" if self.value == "Qty" else "amt"

    def condition(self) -> Column:
        cond = F.col("PrCat").isin(list(self.cats))
        t = F.col(self.type_col)
        if self.type_eq:
            cond = cond & t.isin(list(self.type_eq))
        if self.type_abs_gt is not None:
            cond = cond & (F.abs(t) > F.lit(self.type_abs_gt))
        return cond

    def column(self) -> Column:
        summed = F.sum(F.when(self.condition(), F.col(self.value)).otherwise(F.lit(0)))
        return (qty(summed) if self.kind == "qty" else money(summed)).alias(self.name)


def _sales_measures() -> list[Measure]:
    scopes = [("", {}), ("s", {"type_eq": (fixed.SLD_REGISTER,)}), ("o", {"type_abs_gt": 1}),
              ("bw", {"type_eq": (fixed.SLD_BOOKWORM,)})]
    dist_like = (fixed.CAT_DIST, fixed.CAT_SCAN)
    per_scope = [
        ("DistSoldCost", "Cost", dist_like), ("DistSoldVal", "Val", dist_like),
        ("FrlnSoldCost", "Cost", (fixed.CAT_FRLN,)), ("FrlnSoldVal", "Val", (fixed.CAT_FRLN,)),
        ("ScanSoldQty", "Qty", (fixed.CAT_SCAN,)), ("ScanSoldCost", "Cost", (fixed.CAT_SCAN,)),
        ("ScanSoldVal", "Val", (fixed.CAT_SCAN,)),
    ]
    return [Measure(prefix + name, value, cats, "SldTy", **scope)
            for prefix, scope in scopes for name, value, cats in per_scope]


def _xfer_measures(out_name: str, in_name: str) -> list[Measure]:
    """Transfer measures; ``out_name``/``in_name`` name the store-to-store pair."""
    out: list[Measure] = []
    for cat, title in ((fixed.CAT_DIST, "Dist"), (fixed.CAT_FRLN, "Frln")):
        kinds = [
            (f"{title}Tsh", (fixed.XFR_TRASH,)),
            (f"{title}Dmg", (fixed.XFR_DAMAGE,)),
            (f"{title}Dnt", (fixed.XFR_DONATE,)),
            (f"Tot{title}Rfi", fixed.XFR_RFI),
            (out_name.format(c=title), (fixed.XFR_STORE_TO_STORE,)),
            (in_name.format(c=title), (-fixed.XFR_STORE_TO_STORE,)),
        ]
        for stem, types in kinds:
            for value in ("Qty", "Cost"):
                out.append(Measure(f"{stem}{value}", value, (cat,), "XfrTy", type_eq=types))
    return out


SALES_MEASURES: list[Measure] = _sales_measures()
XFER_MEASURES: list[Measure] = _xfer_measures("{c}TotXfrOut", "{c}TotXfrIn")
V1_XFER_MEASURES: list[Measure] = _xfer_measures("{c}OStS", "{c}IStS")


def pivot_measures(tidy: DataFrame, measures: list[Measure]) -> DataFrame:
    """Wide table: one row per (BusinessMonth, LocationNo), one column per measure."""
    return tidy.groupBy(*KEYS).agg(*[m.column() for m in measures])
