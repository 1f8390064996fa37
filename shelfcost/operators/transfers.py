"""Transfer branches (out / in) and their tidy union.

Tidy shape: ``(BusinessMonth, LocationNo, XfrTy, PrCat, Qty, Cost)``; the
sign of ``XfrTy`` is the direction (inbound rows carry ``-TransferType``).

Rules reproduced on purpose:

* OUT filters the window on the *header* CreateTime but buckets the month on
  the *detail* time (update, else create), so a row can land in a month after
  the window; that month then enters the key grid.
* IN has no type filter: inbound trash/donate/damage rows add keys but match
  no measure.

Headers and lines are joined once. A joined line joins its product by one
shuffle (:func:`shelfcost.operators.dims.join_products`) and then emits one row
per direction whose window it meets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.columns import event_time, money, qty
from shelfcost.functions.dates import Window, month_bucket
from shelfcost.operators.dims import join_products, products_categorised
from shelfcost.operators.sales import LINES, SIDE, net, times_lines
from shelfcost.sources.catalog import Sources

TIDY_COLUMNS = ("BusinessMonth", "LocationNo", "XfrTy", "PrCat", "Qty", "Cost")


def _lines(src: Sources, in_window: Column | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Completed transfer headers joined to their completed lines (those ``in_window``; on ``keys`` too), with the line's event time."""
    heads = src.xfer_header.where(F.col("StatusCode") == fixed.XFER_HEADER_DONE).select(
        "TransferBinNo", "LocationNo", "ToLocationNo", "TransferType", F.col("CreateTime").alias("HeaderTime"),
        *[F.col(c).alias(f"Head{c}") for c in keys],
    )
    done = src.xfer_detail.where(F.col("StatusCode") == fixed.XFER_DETAIL_DONE)
    lines = (done if in_window is None else done.where(in_window)).select(
        "TransferBinNo", "DipsItemCode", "Quantity", "DipsCost", event_time(F.col("UpdateTime"), F.col("CreateTime")).alias("EventTime"), *keys,
    )
    joined = heads.join(lines, "TransferBinNo")
    return reduce(DataFrame.where, [F.col(c).between(F.col(f"Head{c}"), F.col(f"Head{c}")) for c in keys], joined)


def transfers(src: Sources, window: Window, directions=("out", "in"), out_window_on: str = "header",
              run_month: bool = False, lines: bool = False, signed: bool = False) -> DataFrame:
    """A8 + A9 in one pass over the joined lines.

    Outbound rows are the sending store's, inbound rows the receiving store's
    with the type negated. ``out_window_on="header"`` (default, as the rule is
    written) filters outbound rows on the header's CreateTime; ``"event_time"``
    is the opt-in that filters them on the line time the month is bucketed on.
    ``run_month`` adds the month of the window that a row was read in where it
    cannot be told from ``BusinessMonth``: for rows with a NULL month or store.
    ``lines`` adds the number of joined lines behind a row. In a ``signed`` run rows join those of their own side, and lines that
    are the same on both go no further.
    """
    if out_window_on not in ("header", "event_time"):
        raise ValueError(f"out_window_on must be 'header' or 'event_time', not {out_window_on!r}")
    on_header = out_window_on == "header"
    keep = {"out": window.contains(F.col("HeaderTime" if on_header else "EventTime")), "in": window.contains(F.col("EventTime"))}
    # where no direction's window is on the header, the lines' window is stated on their stored times, which reaches the scan
    in_window = None if on_header and "out" in directions else window.contains_first(F.col("UpdateTime"), F.col("CreateTime"))
    side = [SIDE] if signed else []
    moved = _lines(src, in_window, side).where(reduce(lambda x, y: x | y, [keep[d] for d in directions])).select(
        "TransferBinNo", "HeaderTime", "EventTime", "LocationNo", "ToLocationNo", "TransferType",
        F.col("DipsItemCode").alias("ItemCode"), F.col("Quantity").alias("q"), (F.col("Quantity") * F.col("DipsCost")).alias("c"),
        *(side or [F.lit(1).cast("bigint").alias(LINES)]))
    if signed:
        moved = times_lines(net(moved), "q", "c")
    priced = join_products(moved, ["HeaderTime", "EventTime", "LocationNo", "ToLocationNo", "TransferType"], ["q", "c", LINES],
                           products_categorised(src, True))
    out_time = F.col("HeaderTime") if on_header else F.col("EventTime")
    sides = {
        "out": (out_time, F.col("LocationNo"), F.col("TransferType")),
        "in": (F.col("EventTime"), F.col("ToLocationNo"), -F.col("TransferType")),
    }
    month = month_bucket(F.col("EventTime"))
    rows = []
    for d in directions:
        read_at, store, kind = sides[d]
        side = [store.alias("LocationNo"), kind.alias("XfrTy")]
        if run_month:
            side.append(F.when(store.isNull() | month.isNull(), month_bucket(read_at)).otherwise(month).alias("RunMonth"))
        rows.append(F.when(window.contains(read_at), F.struct(*side)))
    extra = ["RunMonth"] if run_month else []
    priced = priced.select(
        month.alias("BusinessMonth"), F.explode(F.array_compact(F.array(*rows))).alias("side"), "PrCat", "q", "c", LINES,
    ).select("BusinessMonth", "side.*", "PrCat", "q", "c", LINES)
    return (
        priced.groupBy("BusinessMonth", "LocationNo", "XfrTy", "PrCat", *extra)
        .agg(qty(F.sum("q")).alias("Qty"), money(F.sum("c")).alias("Cost"), F.sum(LINES).alias(LINES))
        .select(*TIDY_COLUMNS, *extra, *([LINES] if lines else []))
    )


def xfers_out(src: Sources, window: Window, window_on: str = "header") -> DataFrame:
    """Outbound transfers by the lines' event month, at the sending store."""
    return transfers(src, window, ("out",), window_on)


def xfers_in(src: Sources, window: Window) -> DataFrame:
    """Inbound transfers by event month, at the receiving store, type negated."""
    return transfers(src, window, ("in",))


def xfers_tidy(src: Sources, window: Window, out_window_on: str = "header") -> DataFrame:
    """K3: both transfer branches."""
    return transfers(src, window, ("out", "in"), out_window_on)
