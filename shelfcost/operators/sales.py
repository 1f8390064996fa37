"""The six sales branches and their tidy union.

Every branch yields the tidy shape
``(BusinessMonth, LocationNo, SldTy, PrCat, Qty, Cost, Val, Fee)``
aggregated to month x store x category.

Plan shape (what would hold at 100 TB):

* Date windows are half-open comparisons on raw date columns, pushed to the
  parquet scans of both join sides.
* Lines join their products by one shuffle on the item
  (:func:`shelfcost.operators.dims.join_products`) and are summed per month,
  store, type and category right after it, on the map side. Nothing between
  that shuffle and the join keeps AQE from splitting the partition of an item
  that carries a third of all lines (the Bookworm placeholder, a best seller).
* No join is hinted; byte statistics and AQE choose broadcasts.
* Online orders join fulfilment header and detail at *order* level; the
  fan-out (several detail lines multiply an order's price) is the rule
  being reproduced, not a bug to dedupe.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.columns import (
    bookworm_xaction_id,
    ci_equals,
    ci_isin,
    item_code_from_sku,
    location_fallback,
    money,
    qty,
    return_sign,
)
from shelfcost.functions.dates import Window, month_bucket
from shelfcost.operators import reach
from shelfcost.operators.dims import join_products, products_categorised
from shelfcost.session import checkpoint_dir
from shelfcost.sources.catalog import Sources

TIDY_COLUMNS = ("BusinessMonth", "LocationNo", "SldTy", "PrCat", "Qty", "Cost", "Val", "Fee")
LINES = "Lines"
#: In the tables of a signed run: 1 for a row after a change, -1 for one before it. A run takes before from after.
SIDE = "Side"
TXN_KEYS = ["LocationID", "BusinessDate", "SalesXactionId"]


def _columns(lines: bool) -> list[str]:
    """Tidy columns; with ``lines`` also the number of joined lines behind a row (unused, the count is pruned from the plan)."""
    return [*TIDY_COLUMNS, *([LINES] if lines else [])]


def _tidy(df: DataFrame, sld_ty: int, q: Column, cost: Column, val: Column, fee: Column, lines: bool = False) -> DataFrame:
    """Final aggregate of a branch to month x store x category."""
    return df.groupBy("BusinessMonth", "LocationNo", "PrCat").agg(
        F.sum(LINES).alias(LINES),
        qty(F.sum(q)).alias("Qty"),
        money(F.sum(cost)).alias("Cost"),
        money(F.sum(val)).alias("Val"),
        money(F.sum(fee)).alias("Fee"),
    ).withColumn("SldTy", F.lit(sld_ty)).select(*_columns(lines))


def net(joined: DataFrame) -> DataFrame:
    """Joined lines of both sides as lines with their signed number ``LINES``, without those that are the same before and after.

    Lines of a document (the join's key, which must be among the columns) lie together, so this needs no shuffle
    of its own, and what cancels here is not shuffled to the products.
    """
    rows = [c for c in joined.columns if c != SIDE]
    return joined.groupBy(*rows).agg(F.sum(SIDE).alias(LINES)).where(F.col(LINES) != 0)


def times_lines(rows: DataFrame, *sums: str) -> DataFrame:
    """The measures ``sums`` of one line for as many as there are, with their sign."""
    return rows.withColumns({c: F.col(c) * F.col(LINES) for c in sums})


# --- register lines (J1) ----------------------------------------------------------

def register_lines(src: Sources, window: Window) -> DataFrame:
    """Active sale transactions joined to their lines, within the window.

    The window is stated on both sides; the header's copy is implied by the
    equi-join on BusinessDate and lets both scans prune.
    """
    i = src.sales_item.where(window.contains(F.col("BusinessDate")))
    return i.join(active_headers(src, window), TXN_KEYS)


def active_headers(src: Sources, window: Window, *extra: str) -> DataFrame:
    """Keys of active sale transactions (status A, type S) in the window, with the columns ``extra``."""
    return src.having("sales_header", "Status", fixed.SALE_STATUS_ACTIVE).where(
        (F.col("Status") == fixed.SALE_STATUS_ACTIVE)
        & (F.col("XactionType") == fixed.SALE_XACTION_SALE)
        & window.contains(F.col("BusinessDate"))
    ).select("LocationID", "BusinessDate", F.col("SalesXactionID").alias("SalesXactionId"), *extra)


def _signed(df: DataFrame) -> DataFrame:
    return df.withColumn("SignedQty", F.col("Quantity") * return_sign(F.col("IsReturn")))


def sales_register(src: Sources, window: Window, lines: bool = False) -> DataFrame:
    """A1: register sales of new goods (no gift cards), per store's LocationNo."""
    sold = _signed(register_lines(src, window)).select(
        month_bucket(F.col("BusinessDate")).alias("BusinessMonth"), "LocationID", "ItemCode",
        F.col("SignedQty").alias("q"), F.col("ExtendedAmt").alias("v"), F.lit(1).cast("bigint").alias(LINES),
    )
    priced = join_products(sold, ["BusinessMonth", "LocationID"], ["q", "v", LINES], products_categorised(src, True))
    priced = priced.join(src.locations.select("LocationID", "LocationNo"), "LocationID")
    return _tidy(priced, fixed.SLD_REGISTER, F.col("q"), F.col("q") * F.col("Cost"), F.col("v"), F.lit(0), lines)


def bookworm_keyed(src: Sources) -> DataFrame:
    """Bookworm orders with the derived register keys."""
    bk = src.bookworm
    return bk.select(
        F.col("locationId").alias("BkLocationID"),
        bookworm_xaction_id(F.col("tillnumber"), F.col("transactionNumber")).alias("BkXactionId"),
        F.col("detailNumber").alias("BkLineNumber"),
        item_code_from_sku(F.col("SKU")).alias("BookwormItemCode"),
        F.col("LocationNo").alias("BookwormLocationNo"),
    )


def placeholder_lines(src: Sources, window: Window) -> DataFrame:
    """Register lines of the window that stand for a Bookworm order."""
    return src.having("sales_item", "ItemCode", fixed.BOOKWORM_PLACEHOLDER_ITEM).where(
        window.contains(F.col("BusinessDate")) & (F.col("ItemCode") == fixed.BOOKWORM_PLACEHOLDER_ITEM)
    )


def _of_placeholders(src: Sources, window: Window, orders: DataFrame) -> DataFrame:
    """Bookworm orders (BkLocationID, BkXactionId, ...) of the placeholder lines' transactions: they have no date, so all would be shuffled."""
    wanted = reach.marks(placeholder_lines(src, window).select("LocationID", "SalesXactionId"))
    return reach.among(orders, ["BkLocationID", "BkXactionId"], wanted)


def bookworm_lines(src: Sources, window: Window) -> DataFrame:
    """J1 + J8: placeholder register lines matched to their Bookworm order line, of
    active sale transactions.

    The placeholder lines are matched to Bookworm orders *before* the header
    join, so the header join's other side is the small matched set rather
    than every register line (inner joins commute; the result is the same).
    """
    matched = placeholder_lines(src, window).join(
        _of_placeholders(src, window, bookworm_keyed(src)),
        (F.col("LocationID") == F.col("BkLocationID"))
        & (F.col("SalesXactionId") == F.col("BkXactionId"))
        & (F.col("LineNumber") == F.col("BkLineNumber")),
    )
    return matched.join(active_headers(src, window), TXN_KEYS)


def sales_bookworm(src: Sources, window: Window, lines: bool = False) -> DataFrame:
    """Bookworm sales, valued by the ordered item, at the Bookworm store."""
    sold = _signed(bookworm_lines(src, window)).select(
        month_bucket(F.col("BusinessDate")).alias("BusinessMonth"),
        F.col("BookwormLocationNo").alias("LocationNo"), F.col("BookwormItemCode").alias("ItemCode"),
        F.col("SignedQty").alias("q"), F.col("ExtendedAmt").alias("v"), F.lit(1).cast("bigint").alias(LINES),
    )
    priced = join_products(sold, ["BusinessMonth", "LocationNo"], ["q", "v", LINES], products_categorised(src, True))
    return _tidy(priced, fixed.SLD_BOOKWORM, F.col("q"), F.col("q") * F.col("Cost"), F.col("v"), F.lit(0), lines)


def store_sales(src: Sources, window: Window, products: DataFrame, lines: bool = False, signed: bool = False) -> DataFrame:
    """A1 + A6 in one pass: lines and headers are read once, and a line is shuffled twice: by its transaction and by its item.

    A line gives a register row, and a placeholder line one more row, which looks for its Bookworm orders. Headers and Bookworm orders
    both belong to a transaction, so both joins are on store and transaction id and share one shuffle; a transaction's
    date and line number are compared within it. Both kinds of rows then share the product join.
    In a ``signed`` run rows join those of their own side, and lines that are the same on both go no further.
    """
    side, same_side = ([SIDE], lambda other: _equal(SIDE, other)) if signed else ([], lambda other: F.lit(True))
    register, bookworm = F.lit(fixed.SLD_REGISTER), F.lit(fixed.SLD_BOOKWORM)
    kinds = F.array_compact(F.array(register, F.when(F.col("ItemCode") == fixed.BOOKWORM_PLACEHOLDER_ITEM, bookworm)))
    sold = _signed(src.sales_item.where(window.contains(F.col("BusinessDate")))).select(
        *TXN_KEYS, "LineNumber", "ItemCode", F.col("SignedQty").alias("q"), F.col("ExtendedAmt").alias("v"), *side, F.explode(kinds).alias("SldTy"))
    heads = active_headers(src, window, *side).select(*[F.col(c).alias(f"Head{c}") for c in (*TXN_KEYS, *side)])
    sold = sold.join(heads, _same_transaction("HeadLocationID", "HeadSalesXactionId") & _equal("BusinessDate", "HeadBusinessDate") & same_side(f"Head{SIDE}"))
    orders = src.bookworm.select(
        F.col("locationId").alias("BkLocationID"), bookworm_xaction_id(F.col("tillnumber"), F.col("transactionNumber")).alias("BkXactionId"),
        F.col("detailNumber").alias("BkLineNumber"), "SKU", F.col("LocationNo").alias("BookwormLocationNo"),
        *[F.col(c).alias(f"Bk{c}") for c in side])
    sold = sold.join(
        _of_placeholders(src, window, orders), _same_transaction("BkLocationID", "BkXactionId") & _equal("LineNumber", "BkLineNumber") & (F.col("SldTy") == bookworm) & same_side(f"Bk{SIDE}"), "left",
    ).where((F.col("SldTy") == register) | F.col("BkXactionId").isNotNull())
    item = F.when(F.col("SldTy") == bookworm, item_code_from_sku(F.col("SKU"))).otherwise(F.col("ItemCode"))
    sold = sold.select(month_bucket(F.col("BusinessDate")).alias("BusinessMonth"), "LocationID", "SalesXactionId", "SldTy", "BookwormLocationNo",
                       item.alias("ItemCode"), "q", "v", *(side or [F.lit(1).cast("bigint").alias(LINES)]))
    if signed:
        sold = times_lines(net(sold), "q", "v")
    keys = ["BusinessMonth", "LocationID", "SldTy", "BookwormLocationNo"]
    priced = join_products(sold, keys, ["q", "v", LINES], products).groupBy(*keys, "PrCat").agg(
        F.sum("q").alias("q"), F.sum(F.col("q") * F.col("Cost")).alias("c"), F.sum("v").alias("v"), F.sum(LINES).alias(LINES))
    stores = src.locations.select("LocationID", "LocationNo", register.alias("SldTy"), F.lit(True).alias("known"))
    priced = priced.join(stores, ["LocationID", "SldTy"], "left").where((F.col("SldTy") == bookworm) | F.col("known"))
    store = F.when(F.col("SldTy") == bookworm, F.col("BookwormLocationNo")).otherwise(F.col("LocationNo"))
    return priced.withColumn("LocationNo", store).groupBy("BusinessMonth", "LocationNo", "SldTy", "PrCat").agg(
        qty(F.sum("q")).alias("Qty"), money(F.sum("c")).alias("Cost"), money(F.sum("v")).alias("Val"),
        money(F.lit(0)).alias("Fee"), F.sum(LINES).alias(LINES),
    ).select(*_columns(lines))


def _same_transaction(location: str, xaction: str) -> Column:
    return (F.col("LocationID") == F.col(location)) & (F.col("SalesXactionId") == F.col(xaction))


def _equal(a: str, b: str) -> Column:
    """Equality that is compared on the joined rows and is no key of the shuffle."""
    return F.col(a).between(F.col(b), F.col(b))


# --- online channels ----------------------------------------------------------------
#
# All four online branches share every join (facility, fulfilment header and
# detail, product), so they are one pass. Each channel's order lines are first
# turned into tags, one per branch they belong to; orders without a tag go.
# The channels' orders are unioned, joined once to the fulfilment lines of
# their own order system, and each joined line emits its tags. Asking for one
# branch runs the same code with the other tags left out.


@dataclass(frozen=True)
class OnlineKind:
    sld_ty: int
    date_col: str                         # bucketing and window column
    condition: Callable[[], Column]       # branch-specific order filter
    # per joined line: (quantity, product costs counted, value, fee)
    measures: Callable[[], tuple[Column, int, Column, Column]]


ISTORE_KINDS = {
    "shipped": OnlineKind(
        fixed.SLD_ISTORE_SHIPPED, "ShipDate", lambda: F.col("ShippedQuantity") > 0,
        lambda: (F.col("ShippedQuantity"), 1, F.col("Price"), F.col("ShippingFee"))),
    "refund": OnlineKind(
        fixed.SLD_ISTORE_REFUND, "RefundDate", lambda: F.col("RefundAmount") > 0,
        lambda: (F.lit(0), 0, -F.col("RefundAmount"), F.lit(0))),
}

WEB_KINDS = {
    "shipped": OnlineKind(
        fixed.SLD_WEB_SHIPPED, "ShipDate", lambda: F.lit(True),
        lambda: (F.col("Quantity"), 1, F.col("ExtendedAmount"), F.col("ShippingAmount"))),
    "refund": OnlineKind(
        fixed.SLD_WEB_REFUND, "SiteLastModifiedDate", lambda: F.col("ItemRefundAmount") > 0,
        lambda: (F.lit(0), 0, -F.col("ItemRefundAmount"), F.lit(0))),
}


def _any_kind(window: Window, kinds: list[OnlineKind]) -> Column:
    """Orders in at least one requested branch: a disjunction pushed to the order scan."""
    cond = None
    for k in kinds:
        c = window.contains(F.col(k.date_col)) & k.condition()
        cond = c if cond is None else (cond | c)
    return cond


def _tags(window: Window, kinds: list[OnlineKind]) -> Column:
    """One struct per branch the order line belongs to.

    Cost is the product cost once per joined line (not x quantity): each tag
    carries ``n = 1`` (0 for refunds), which the product join multiplies.
    """
    tags = []
    for k in kinds:
        q, n, v, f = k.measures()
        tag = F.struct(
            F.lit(k.sld_ty).alias("SldTy"), month_bucket(F.col(k.date_col)).alias("BusinessMonth"),
            q.cast("bigint").alias("q"), F.lit(n).cast("bigint").alias("n"), money(v).alias("v"), money(f).alias("f"),
        )
        tags.append(F.when(window.contains(F.col(k.date_col)) & k.condition(), tag))
    return F.array_compact(F.array(*tags))


def _istore_tagged(src: Sources, window: Window, kinds: list[OnlineKind], *extra: str) -> DataFrame:
    orders = src.having("istore_orders", "SKU", fixed.ISTORE_SKU_PREFIX).where(
        ci_isin(F.col("OrderStatus"), fixed.ISTORE_OPEN_STATUSES)
        & F.col("SKU").startswith(fixed.ISTORE_SKU_PREFIX)
        & _any_kind(window, kinds)
    )
    return orders.select(
        F.lit(fixed.ISTORE_ORDER_SYSTEM).alias("System"), "FacilityID", "ISIS_OrderID",
        F.lit(None).cast("string").alias("MarketKey"), F.lit(None).cast("string").alias("MarketItemKey"),
        _tags(window, kinds).alias("tags"), *extra,
    )


def _web_tagged(src: Sources, window: Window, kinds: list[OnlineKind], *extra: str) -> DataFrame:
    orders = src.web_orders.where(
        ~ci_isin(F.col("OrderStatus"), fixed.WEB_CANCELED_STATUSES)
        & ci_equals(F.col("ItemStatus"), fixed.WEB_SHIPPED_ITEM_STATUS)
        & (F.col("ShippingMethod") != fixed.WEB_PICKUP_SHIPPING_METHOD)
        & (F.col("Quantity") > 0)
        & _any_kind(window, kinds)
    )
    return orders.select(
        F.lit(fixed.WEB_ORDER_SYSTEM).alias("System"), "FacilityID", "ISIS_OrderID",
        F.col("MarketOrderID").alias("MarketKey"), F.col("MarketOrderItemID").cast("string").alias("MarketItemKey"),
        _tags(window, kinds).alias("tags"), *extra,
    )


#: A run of at most this many months reads fulfilment rows only near its own orders' ids.
NEAR_MONTHS = 3


def between_ids(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` lies between the smallest and the largest of ``ids`` (one column) and may be one of them.

    The two bounds pass through the driver (a pass over the window's ids) and reach the scan of ``rows`` as literals, which
    then skips the files and row groups outside. Ids grow with time, so the orders of a month stand close
    together; what stands between them is kept back by the ids' bitmap, made in the same pass; the join decides.
    """
    key = ids.columns[0]
    checkpoint_dir(ids.sparkSession)
    wanted = reach.marks(ids, F.min(key).alias("first"), F.max(key).alias("last")).checkpoint(eager=True)
    first, last = wanted.agg(F.min("first"), F.max("last")).first()
    if first is None:
        return rows.where(F.lit(False))
    return reach.among(rows.where(F.col(column).between(F.lit(first), F.lit(last))), [column], wanted)


def fulfilment_heads(src: Sources, systems: list[str], order_ids: DataFrame | None = None, *extra: str) -> DataFrame:
    """Fulfilment headers of the given order systems; with ``order_ids`` only those near these orders (the tables have no date)."""
    heads = src.having("fulfil_header", "OrderSystem", *systems).where(F.col("OrderSystem").isin(systems)).select(
        F.col("OrderID").alias("HeadOrderID"), F.col("ISISOrderID"), "OrderSystem", F.col("MarketOrderID").alias("HeadMarketKey"),
        *[F.col(c).alias(f"Head{c}") for c in extra])
    return heads if order_ids is None else between_ids(heads, "ISISOrderID", order_ids)


def fulfilment_lines(src: Sources, head_ids: DataFrame | None = None, *extra: str) -> DataFrame:
    """Valid fulfilment lines; with ``head_ids`` only those near these headers."""
    lines = src.fulfil_detail.where(
        F.col("Status").isin(list(fixed.FULFIL_VALID_STATUSES)) & F.col("ProblemStatusID").isNull()
    ).select("OrderID", "ItemCode", F.col("LocationNo").alias("FulfilLocationNo"),
             F.col("MarketOrderItemID").alias("LineMarketItemKey"), *[F.col(c).alias(f"Line{c}") for c in extra])
    return lines if head_ids is None else between_ids(lines, "OrderID", head_ids)


def online_sales(src: Sources, window: Window, istore=("shipped", "refund"), web=("shipped", "refund"),
                 lines: bool = False, signed: bool = False) -> DataFrame:
    """A2-A5: online orders joined to facility and, at order level (fan-out kept), to the
    fulfilment lines (J5, J6); web orders match on two header keys and the text form of
    the item id as well (J7). Shipped by ship month, refunds by refund or last-modified month.

    The window's orders join the headers first, so that only they, not the whole history of headers, are shuffled to the lines.
    In a ``signed`` run rows join those of their own side, and lines that are the same on both go no further.
    """
    side, same_side = ([SIDE], lambda other: _equal(SIDE, other)) if signed else ([], lambda other: F.lit(True))
    channels = []
    if istore:
        channels.append(_istore_tagged(src, window, [ISTORE_KINDS[k] for k in istore], *side))
    if web:
        channels.append(_web_tagged(src, window, [WEB_KINDS[k] for k in web], *side))
    orders = channels[0] if len(channels) == 1 else channels[0].unionByName(channels[1])
    systems = [s for s, kinds in ((fixed.ISTORE_ORDER_SYSTEM, istore), (fixed.WEB_ORDER_SYSTEM, web)) if kinds]
    near = len(window.months()) <= NEAR_MONTHS
    heads = fulfilment_heads(src, systems, orders.select("ISIS_OrderID") if near else None, *side)
    fulfilment = fulfilment_lines(src, heads.select("HeadOrderID") if near else None, *side)
    of_istore = (F.col("System") == fixed.ISTORE_ORDER_SYSTEM) & (F.col("OrderSystem") == fixed.ISTORE_ORDER_SYSTEM)
    of_web = (F.col("System") == fixed.WEB_ORDER_SYSTEM) & (F.col("OrderSystem") == fixed.WEB_ORDER_SYSTEM)
    same_order = of_istore | (of_web & (F.col("MarketKey") == F.col("HeadMarketKey")))
    same_item = (F.col("System") == fixed.ISTORE_ORDER_SYSTEM) | (F.col("MarketItemKey") == F.col("LineMarketItemKey"))
    joined = orders.join(src.facilities, "FacilityID").join(
        heads, (F.col("ISIS_OrderID") == F.col("ISISOrderID")) & same_order & same_side(f"Head{SIDE}")
    ).join(fulfilment, (F.col("HeadOrderID") == F.col("OrderID")) & same_item & same_side(f"Line{SIDE}"))
    sold = joined.select(
        "OrderID", location_fallback(F.col("FulfilLocationNo"), F.col("FacilityLocationNo")).alias("LocationNo"), "ItemCode", *side,
        F.explode("tags").alias("t"),
    ).select("OrderID", "LocationNo", "ItemCode", "t.*", *(side or [F.lit(1).cast("bigint").alias(LINES)]))
    if signed:
        sold = times_lines(net(sold), "q", "n", "v", "f")
    priced = join_products(sold, ["BusinessMonth", "LocationNo", "SldTy"], ["q", "n", "v", "f", LINES],
                           products_categorised(src, False))
    return priced.groupBy("BusinessMonth", "LocationNo", "SldTy", "PrCat").agg(
        qty(F.sum("q")).alias("Qty"), money(F.sum(F.col("n") * F.col("Cost"))).alias("Cost"),
        money(F.sum("v")).alias("Val"), money(F.sum("f")).alias("Fee"), F.sum(LINES).alias(LINES),
    ).select(*_columns(lines))


def sales_istore_shipped(src: Sources, window: Window) -> DataFrame:
    """A2: shipped iStore orders by ship month; Cost is per line, not x quantity."""
    return online_sales(src, window, istore=("shipped",), web=())


def sales_istore_refunds(src: Sources, window: Window) -> DataFrame:
    """A3: iStore refunds by refund month; negated value, zero quantity and cost."""
    return online_sales(src, window, istore=("refund",), web=())


def sales_web_shipped(src: Sources, window: Window) -> DataFrame:
    """A4: shipped web-store lines by ship month."""
    return online_sales(src, window, istore=(), web=("shipped",))


def sales_web_refunds(src: Sources, window: Window) -> DataFrame:
    """A5: web-store refunds by last-modified month."""
    return online_sales(src, window, istore=(), web=("refund",))


def sales_passes(src: Sources, window: Window, lines: bool = False, signed: bool = False) -> list[DataFrame]:
    """The six branches: register and Bookworm in one pass, the four online ones in another."""
    return [store_sales(src, window, products_categorised(src, True), lines, signed), online_sales(src, window, lines=lines, signed=signed)]


def sales_tidy(src: Sources, window: Window, lines: bool = False) -> DataFrame:
    """K2: bag union of the six branches."""
    return reduce(DataFrame.unionByName, sales_passes(src, window, lines))
