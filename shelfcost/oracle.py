"""SQL statement of every registered query, for DuckDB, independent of the Spark code.

The source views state the fixture mapping (star tables -> retail source
tables), as the ``src_*`` queries are checked on them. The rules themselves
are not stated over those views join by join: ``f_line`` holds every order
line once, straight from the star tables, with the rule outcomes as boolean
columns; every product type's category is a literal table; each rule set
lists its branches as structs of one line (does it count, month, store,
type, item, measures), and one aggregate per rule set sums them. Column
lists, pivot scopes and mappings are written out here too, so an error in
the library's own lists shows as a mismatch. Only the run parameters
(windows, report selections) are shared with the registry.

``statements()`` returns, per registered key, one self-contained statement:
the CTEs the query needs (found by name, transitively) followed by its final
SELECT. The star tables are the views the checker registers (``orders``,
``lineitem``, ...).
"""

from __future__ import annotations

import re

from shelfcost.functions.dates import month_list_start
from shelfcost.plans import registry as R

DEC = "decimal(19,4)"


def _d(value) -> str:
    return f"DATE '{value.isoformat()}'"


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _pad(expr: str, n: int) -> str:
    return f"lpad(cast({expr} as varchar), {n}, '0')"


# --- fixture views ------------------------------------------------------------------------

# --- fixed values: product types ------------------------------------------------------
# By p_partkey % 20: product type, class, category, v1 sales category, v1 transfer category
# ('' where v1 excludes the type: gift cards and used goods).
PART_TYPES = """
BDGF NEW  frln frln frln
HBF  NEW  frln frln frln
TRF  NEW  frln frln frln
VGF  NEW  frln frln frln
PGC  NEW  gc   dist -
EGC  NEW  gc   dist -
SCAN NEW  scan scan dist
SCAN NEW  scan scan dist
HB   NEW  dist dist dist
TR   NEW  dist dist dist
TOY  NEW  dist dist dist
PB   NEW  dist dist dist
UHB  USED used dist -
UTR  USED used dist -
SPC  SPCL spcl dist dist
CALF NEW  frln frln frln
MSC  OTHR zzz  dist dist
NBAF NEW  frln frln frln
XF   NEW  dist frln frln
LPF  NEW  frln frln frln
"""
PLACEHOLDER = "00000000000010222778"


def _type_rows() -> str:
    rows = [r.split() for r in PART_TYPES.split("\n") if r]
    out = [f"({i}, '{t}', '{c}', '{cat}', '{v1}', nullif('{v1x}', '-'))" for i, (t, c, cat, v1, v1x) in enumerate(rows)]
    # residue -1: the Bookworm placeholder item
    return ", ".join(["(-1, 'BWRM', 'USED', 'used', 'dist', null)", *out])


VIEWS: dict[str, str] = {
    "v_lo": "select * from lineitem join orders on l_orderkey = o_orderkey",
    "v_locations": f"""
        select cast(n_nationkey as integer) as LocationID, {_pad('n_nationkey + 1', 5)} as LocationNo,
               n_name as Name, case when n_nationkey % 10 = 9 then 'N' else 'Y' end as RetailStore,
               case when n_nationkey % 7 = 6 then 'I' else 'A' end as Status,
               rtrim(concat('D', cast(n_nationkey % 8 as varchar), '  ')) as DistrictCode
        from nation""",
    "v_report_locations": """
        select concat('D', cast(n_nationkey % 8 as varchar)) as District, r_name as Region
        from nation join region on n_nationkey % 4 = r_regionkey""",
    "v_facilities": f"""
        select cast(n_nationkey as integer) as FacilityID,
               case when n_nationkey % 12 <> 7 then {_pad('n_nationkey + 1', 5)} end as FacilityLocationNo
        from nation""",
    "v_product_master": f"""
        select {_pad('p_partkey', 20)} as ItemCode, ProductType,
               cast(p_retailprice as {DEC}) as Cost
        from part join f_type on Residue = p_partkey % 20
        union all
        select '{PLACEHOLDER}', 'BWRM', cast(0 as {DEC})""",
    "v_product_types": """
        select distinct ProductType, Class as PTypeClass from f_type
        where Residue = -1 or Residue in (select p_partkey % 20 from part)""",
    "v_sales_header": f"""
        select cast(o_custkey % 25 as integer) as LocationID, cast(o_orderdate as date) as BusinessDate,
               concat({_pad('o_orderkey % 4 + 1', 2)}, {_pad('o_orderkey', 9)}) as SalesXactionID,
               case when o_orderkey % 20 = 0 then 'V' else 'A' end as Status,
               case when o_orderpriority = '5-LOW' then 'R' else 'S' end as XactionType
        from orders""",
    "v_sales_item": f"""
        select cast(o_custkey % 25 as integer) as LocationID, cast(o_orderdate as date) as BusinessDate,
               concat({_pad('l_orderkey % 4 + 1', 2)}, {_pad('l_orderkey', 9)}) as SalesXactionId,
               cast(l_linenumber as integer) as LineNumber,
               case when l_orderkey % 5 = 2 and l_linenumber = 1 then '{PLACEHOLDER}'
                    else {_pad('l_partkey', 20)} end as ItemCode,
               cast(l_quantity as integer) as Quantity,
               case when l_returnflag = 'R' then 'Y' else 'N' end as IsReturn,
               case when l_returnflag = 'R' then -cast(l_extendedprice as {DEC})
                    else cast(l_extendedprice as {DEC}) end as ExtendedAmt
        from v_lo""",
    "v_bookworm": f"""
        select cast(o_custkey % 25 as integer) as locationId, {_pad('o_orderkey % 4 + 1', 2)} as tillnumber,
               cast(o_orderkey as varchar) as transactionNumber, cast(l_linenumber as integer) as detailNumber,
               cast(l_partkey as varchar) as SKU, {_pad('(o_custkey + 3) % 25 + 1', 5)} as LocationNo
        from v_lo""",
    "v_istore_orders": f"""
        select l_orderkey * 8 + l_linenumber as ISIS_OrderID, cast(l_suppkey % 25 as integer) as FacilityID,
               concat(case when l_linenumber = 6 then 'S' else 'D' end, {_pad('l_partkey', 20)}) as SKU,
               case o_orderstatus when 'F' then 'Shipped' when 'O' then 'Pending' when 'P' then 'Cancelled' end
                   as OrderStatus,
               case when l_linestatus = 'F' then cast(l_quantity as integer) else 0 end as ShippedQuantity,
               cast(l_extendedprice as {DEC}) as Price, cast(3.99 as {DEC}) as ShippingFee,
               cast(o_orderdate as date) as OrderDate, cast(l_shipdate as date) as ShipDate,
               case when l_returnflag = 'R' then cast(l_shipdate as date) + 20 end as RefundDate,
               case when l_returnflag = 'R' then cast(l_extendedprice as {DEC}) else cast(0 as {DEC}) end
                   as RefundAmount
        from v_lo""",
    "v_web_orders": f"""
        select l_orderkey * 8 + l_linenumber as ISIS_OrderID, concat('M', cast(l_orderkey as varchar)) as MarketOrderID,
               l_orderkey * 8 + l_linenumber as MarketOrderItemID, cast(l_suppkey % 25 as integer) as FacilityID,
               concat('D', {_pad('l_partkey', 20)}) as SKU,
               case when o_orderstatus = 'P' then 'canceled' else 'open' end as OrderStatus,
               case when l_linestatus = 'F' then 'shipped' else 'pending' end as ItemStatus,
               case when l_linenumber = 7 then '222' when l_linenumber = 5 then null else '100' end as ShippingMethod,
               cast(l_quantity as integer) as Quantity, cast(l_extendedprice as {DEC}) as ExtendedAmount,
               cast(4.99 as {DEC}) as ShippingAmount,
               case when l_returnflag = 'R' then cast(l_extendedprice as {DEC}) else cast(0 as {DEC}) end
                   as ItemRefundAmount,
               cast(o_orderdate as date) as OrderDate, cast(l_shipdate as date) as ShipDate,
               cast(l_shipdate as date) + 15 as SiteLastModifiedDate
        from v_lo""",
    "v_fulfil_header": """
        select l_orderkey * 8 + l_linenumber + 1000000 as OrderID, l_orderkey * 8 + l_linenumber as ISISOrderID,
               case when l_orderkey % 13 = 0 then 'SAS' when l_orderkey % 2 = 1 then 'MON' else 'HMP' end
                   as OrderSystem,
               concat('M', cast(l_orderkey as varchar)) as MarketOrderID
        from (select distinct l_orderkey, l_linenumber from lineitem)""",
    "v_fulfil_detail": f"""
        select l_orderkey * 8 + l_linenumber + 1000000 as OrderID, {_pad('l_partkey', 20)} as ItemCode,
               case when l_partkey % 4 = 0 then null else {_pad('l_partkey % 25 + 1', 5)} end as LocationNo,
               case l_suppkey % 5 when 0 then 4 when 1 then 2 else 1 end as Status,
               case when l_partkey % 17 = 0 then 3 end as ProblemStatusID,
               cast(l_orderkey * 8 + l_linenumber as varchar) as MarketOrderItemID
        from lineitem""",
    "v_xfer_header": f"""
        select o_orderkey as TransferBinNo, {_pad('o_custkey % 25 + 1', 5)} as LocationNo,
               {_pad('(o_custkey + 11) % 25 + 1', 5)} as ToLocationNo,
               case o_orderkey % 5 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 7 when 4 then 4 end
                   as TransferType,
               case when o_orderstatus = 'P' then 2 else 3 end as StatusCode,
               cast(o_orderdate as date) as CreateTime
        from orders""",
    "v_xfer_detail": f"""
        select l_orderkey as TransferBinNo, {_pad('l_partkey', 20)} as DipsItemCode,
               cast(l_quantity as integer) as Quantity, cast(p_retailprice as {DEC}) as DipsCost,
               case when l_linenumber = 4 then 2 else 1 end as StatusCode, cast(o_orderdate as date) as CreateTime,
               case when l_linenumber % 2 = 0 then cast(o_orderdate as date) + l_linenumber * 9 end as UpdateTime
        from v_lo join part on l_partkey = p_partkey""",
    "v_item_master": f"select {_pad('p_partkey', 20)} as ItemCode from part",
}

# --- facts ----------------------------------------------------------------------------------
#
# One row per order line. Item residues index the literal type table (-1: the
# placeholder item). ``seen`` counts the lines that share (order, line
# number): the online and Bookworm joins match on that pair, so each line
# meets all of them.

FACTS: dict[str, str] = {
    "f_type": f"""
        select * from (values {_type_rows()}) t(Residue, ProductType, Class, Cat, V1Sales, V1Xfer)""",
    "f_goods": """
        select p_partkey as Part, cast(p_retailprice as decimal(19,4)) as Cost, t.* from part join f_type t on Residue = p_partkey % 20
        union all
        select -1, 0, * from f_type where Residue = -1""",
    "f_line": f"""
        select l_orderkey as ok, l_linenumber as ln, l_partkey as part,
               cast(o_orderdate as date) as ordered, cast(l_shipdate as date) as shipped,
               cast(l_shipdate as date) + 20 as refunded, cast(l_shipdate as date) + 15 as modified,
               case when l_linenumber % 2 = 0 then cast(o_orderdate as date) + l_linenumber * 9
                    else cast(o_orderdate as date) end as moved,
               cast(l_quantity as integer) as qty, cast(l_extendedprice as {DEC}) as amt,
               l_returnflag = 'R' as returned, l_linestatus = 'F' as filled,
               -- the rules' outcomes
               o_orderkey % 20 <> 0 and o_orderpriority <> '5-LOW' as active_sale,
               l_orderkey % 5 = 2 and l_linenumber = 1 as placeholder,
               o_orderstatus in ('F', 'O') and l_linenumber <> 6 as istore_open,
               o_orderstatus <> 'P' and l_linestatus = 'F' and l_linenumber not in (5, 7) and l_quantity >= 1 as web_sold,
               l_orderkey % 13 <> 0 and l_orderkey % 2 = 1 as istore_system,
               l_orderkey % 13 <> 0 and l_orderkey % 2 = 0 as web_system,
               l_suppkey % 5 <> 1 and l_partkey % 17 <> 0 as line_valid,
               o_orderstatus <> 'P' and l_linenumber <> 4 as transfer_done,
               case o_orderkey % 5 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 7 else 4 end as transfer_type,
               -- stores
               {_pad('o_custkey % 25 + 1', 5)} as sold_at, {_pad('(o_custkey + 3) % 25 + 1', 5)} as bookworm_at,
               {_pad('(o_custkey + 11) % 25 + 1', 5)} as sent_to,
               case when l_suppkey % 25 % 12 <> 7 then {_pad('l_suppkey % 25 + 1', 5)} end as facility_at,
               case when l_partkey % 4 <> 0 then {_pad('l_partkey % 25 + 1', 5)} end as fulfilled_at
        from lineitem join orders on o_orderkey = l_orderkey""",
    # an online order line beside each fulfilment line of the same (order, line number)
    "f_pair": """
        select a.*, b.part as f_part, b.line_valid as f_valid, b.fulfilled_at as f_at
        from f_line a join f_line b on b.ok = a.ok and b.ln = a.ln""",
}


def _month(expr: str) -> str:
    return f"cast(date_trunc('month', {expr}) as date)"


def _in_window(expr: str, w) -> str:
    return f"({expr} >= {_d(w.start)} and {expr} < {_d(w.end)})"


def _branches(rows: list[tuple]) -> str:
    """An unnested list of structs, one per branch: (counts, type, date, store, item, quantity, cost factor, value, fee)."""
    names = ("counts", "ty", "day", "store", "item", "q", "k", "v", "f")
    casts = {"q": "bigint", "k": "bigint", "v": DEC, "f": DEC, "item": "bigint", "store": "varchar", "day": "date", "ty": "integer"}
    structs = ["{" + ", ".join(f"'{n}': " + (f"cast({x} as {casts[n]})" if n in casts else str(x)) for n, x in zip(names, r)) + "}"
               for r in rows]
    return f"unnest([{', '.join(structs)}])"


def _sum_sales(source: str, goods: str, cat: str) -> str:
    return f"""
        select {_month('b.day')} as BusinessMonth, b.store as LocationNo, b.ty as SldTy, {cat} as PrCat,
               cast(sum(b.q) as bigint) as Qty, cast(sum(b.k * g.Cost) as {DEC}) as Cost,
               cast(sum(b.v) as {DEC}) as Val, cast(sum(b.f) as {DEC}) as Fee
        from ({source}) s join f_goods g on g.Part = b.item and {goods}
        where b.counts group by all"""


SIGNED = "case when returned then -qty else qty end"
VALUE = "case when returned then -amt else amt end"
ITEM = "case when placeholder then -1 else part end"


def _stages(w, sfx: str) -> dict[str, str]:
    """The current rules for window ``w``; CTE names carry suffix ``sfx``."""
    new = "g.Class = 'NEW' and g.Cat <> 'gc'"
    shop = _branches([
        (f"active_sale and {_in_window('ordered', w)}", 1, "ordered", "sold_at", ITEM, SIGNED, SIGNED, VALUE, 0),
    ])
    # a placeholder line meets every Bookworm row of its order and line number
    book = _branches([
        (f"placeholder and active_sale and {_in_window('ordered', w)}", 0, "ordered", "bookworm_at", "f_part", SIGNED, SIGNED, VALUE, 0),
    ])
    at = "coalesce(f_at, facility_at)"
    istore, web = "f_valid and istore_system and istore_open", "f_valid and web_system and web_sold"
    online = _branches([
        (f"{istore} and filled and qty > 0 and {_in_window('shipped', w)}", 2, "shipped", at, "f_part", "qty", 1, "amt", "3.99"),
        (f"{istore} and returned and amt > 0 and {_in_window('refunded', w)}", -2, "refunded", at, "f_part", 0, 0, "-amt", 0),
        (f"{web} and {_in_window('shipped', w)}", 3, "shipped", at, "f_part", "qty", 1, "amt", "4.99"),
        (f"{web} and returned and amt > 0 and {_in_window('modified', w)}", -3, "modified", at, "f_part", 0, 0, "-amt", 0),
    ])
    s = {
        "q_sales_tidy": " union all ".join([
            _sum_sales(f"select {shop} as b from f_line", new, "g.Cat"),
            _sum_sales(f"select {book} as b from f_pair", new, "g.Cat"),
            _sum_sales(f"select {online} as b from f_pair", "true", "g.Cat"),
        ]),
        "q_xfers_tidy": _transfers(
            [("transfer_done and " + _in_window("ordered", w), "transfer_type", "moved", "sold_at"),
             ("transfer_done and " + _in_window("moved", w), "-transfer_type", "moved", "sent_to")],
            "qty * g.Cost", new, "g.Cat"),
        "q_sales_wide": _sales_pivot(f"q_sales_tidy{sfx}"),
        "q_xfers_wide": _xfers_pivot(f"q_xfers_tidy{sfx}", "TotXfrOut", "TotXfrIn", "{c}{k}{v}"),
        "q_key_grid": f"""
            with k as (select BusinessMonth as m, LocationNo as s from q_sales_wide{sfx} union select BusinessMonth, LocationNo from q_xfers_wide{sfx})
            select a.m as BusinessMonth, b.s as LocationNo from (select distinct m from k where s is not null) a,
                   (select distinct s from k) b where a.m is not null and b.s is not null""",
        "q_rollup": f"""
            select g.BusinessMonth, g.LocationNo, {_mapped(ROLLUP_COLUMNS)}
            from q_key_grid{sfx} g
            left join q_sales_wide{sfx} sw using (BusinessMonth, LocationNo)
            left join q_xfers_wide{sfx} xw using (BusinessMonth, LocationNo)""",
    }
    return {k + sfx: v for k, v in s.items()}


def _transfers(sides: list[tuple[str, str, str, str]], cost: str, goods: str, cat: str) -> str:
    structs = [f"{{'counts': {c}, 'ty': {ty}, 'day': {day}, 'store': {store}}}" for c, ty, day, store in sides]
    return f"""
        select {_month('b.day')} as BusinessMonth, b.store as LocationNo, b.ty as XfrTy, {cat} as PrCat,
               cast(sum(qty) as bigint) as Qty, cast(sum({cost}) as {DEC}) as Cost
        from (select part, qty, unnest([{', '.join(structs)}]) as b from f_line) s join f_goods g on g.Part = s.part and {goods}
        where b.counts group by all"""


# --- fixed values: measures and column mappings ------------------------------------------------
# Sales measures: name, summed column, categories that count; prefixes by which sale types count.
SALES_PIVOT = """
DistSoldCost Cost dist,scan
DistSoldVal  Val  dist,scan
FrlnSoldCost Cost frln
FrlnSoldVal  Val  frln
ScanSoldQty  Qty  scan
ScanSoldCost Cost scan
ScanSoldVal  Val  scan
"""
SALES_SCOPES = {"": "true", "s": "SldTy = 1", "o": "abs(SldTy) > 1", "bw": "SldTy = 0"}
# Transfer measures: kind and the signed types that count.
XFER_SCOPES = {"Tsh": "1", "Dmg": "7", "Dnt": "2", "Rfi": "1, 2, 7", "Out": "3", "In": "-3"}
# Rollup column = wide column, where the names differ.
ROLLUP_COLUMNS = """
DistSoldCost=sDistSoldCost DistSoldVal=sDistSoldVal FrlnSoldCost=sFrlnSoldCost FrlnSoldVal=sFrlnSoldVal
ScanSoldQty=sScanSoldQty ScanSoldCost=sScanSoldCost ScanSoldVal=sScanSoldVal
DistOnlineSoldCost=oDistSoldCost DistOnlineSoldVal=oDistSoldVal FrlnOnlineSoldCost=oFrlnSoldCost FrlnOnlineSoldVal=oFrlnSoldVal
DistBookwormSoldCost=bwDistSoldCost DistBookwormSoldVal=bwDistSoldVal FrlnBookwormSoldCost=bwFrlnSoldCost FrlnBookwormSoldVal=bwFrlnSoldVal
DistTshQty DistTshCost FrlnTshQty FrlnTshCost DistDmgQty DistDmgCost FrlnDmgQty FrlnDmgCost DistDntQty DistDntCost FrlnDntQty FrlnDntCost
TotDistRfiQty TotDistRfiCost TotFrlnRfiQty TotFrlnRfiCost
DistTotXfrOutQty DistTotXfrOutCost FrlnTotXfrOutQty FrlnTotXfrOutCost DistTotXfrInQty DistTotXfrInCost FrlnTotXfrInQty FrlnTotXfrInCost
"""
V1_COLUMNS = """
DistSoldCost=sDistSoldCost DistSoldVal=sDistSoldVal FrlnSoldCost=sFrlnSoldCost FrlnSoldVal=sFrlnSoldVal
ScanSoldQty=sScanSoldQty ScanSoldCost=sScanSoldCost ScanSoldVal=sScanSoldVal
DistTshQty DistTshCost DistDmgQty DistDmgCost DistDntQty DistDntCost TotDistRfiQty TotDistRfiCost
DistOnlineSoldCost=oDistSoldCost DistOnlineSoldVal=oDistSoldVal FrlnOnlineSoldCost=oFrlnSoldCost FrlnOnlineSoldVal=oFrlnSoldVal
DistBookwormSoldCost=bwDistSoldCost DistBookwormSoldVal=bwDistSoldVal FrlnBookwormSoldCost=bwFrlnSoldCost FrlnBookwormSoldVal=bwFrlnSoldVal
FrlnTshQty FrlnTshCost FrlnDmgQty FrlnDmgCost FrlnDntQty FrlnDntCost TotFrlnRfiQty TotFrlnRfiCost
DistLocXfrOutQty=DistOStSQty DistLocXfrOutCost=DistOStSCost DistLocXfrInQty=DistIStSQty DistLocXfrInCost=DistIStSCost
FrlnLocXfrOutQty=FrlnOStSQty FrlnLocXfrOutCost=FrlnOStSCost FrlnLocXfrInQty=FrlnIStSQty FrlnLocXfrInCost=FrlnIStSCost
"""
# Report column = rollup column, by band of the layout.
REPORT_BANDS = {
    "In-Store Sales": "DistSoldCost FrlnSoldCost ScanSoldCost DistSoldAmt=DistSoldVal FrlnSoldAmt=FrlnSoldVal "
                      "ScanSoldAmt=ScanSoldVal ScanSoldQty",
    "Online Sales": "DistOnlineSoldCost FrlnOnlineSoldCost DistOnlineSoldAmt=DistOnlineSoldVal FrlnOnlineSoldAmt=FrlnOnlineSoldVal",
    "Bookworm Sales": "DistBookwormSoldCost FrlnBookwormSoldCost DistBookwormSoldAmt=DistBookwormSoldVal "
                      "FrlnBookwormSoldAmt=FrlnBookwormSoldVal",
    "Total Transfers In/Out": "DistTotalTransfersInCost=DistTotXfrInCost DistTotalTransfersOutCost=DistTotXfrOutCost "
                              "FrlnTotalTransfersInCost=FrlnTotXfrInCost FrlnTotalTransfersOutCost=FrlnTotXfrOutCost "
                              "DistTotalTransfersInQty=DistTotXfrInQty DistTotalTransfersOutQty=DistTotXfrOutQty "
                              "FrlnTotalTransfersInQty=FrlnTotXfrInQty FrlnTotalTransfersOutQty=FrlnTotXfrOutQty",
    "Total Removed from Inventory Transfers": "DistTotalRfiCost=TotDistRfiCost FrlnTotalRfiCost=TotFrlnRfiCost "
                                              "DistTotalRfiQty=TotDistRfiQty FrlnTotalRfiQty=TotFrlnRfiQty",
    "Trash/Damage/Donate Transfers": "DistTrashCost=DistTshCost DistDamageCost=DistDmgCost DistDonateCost=DistDntCost "
                                     "FrlnTrashCost=FrlnTshCost FrlnDamageCost=FrlnDmgCost FrlnDonateCost=FrlnDntCost "
                                     "DistTrashQty=DistTshQty DistDamageQty=DistDmgQty DistDonateQty=DistDntQty "
                                     "FrlnTrashQty=FrlnTshQty FrlnDamageQty=FrlnDmgQty FrlnDonateQty=FrlnDntQty",
}


def _type_of(name: str) -> str:
    return "bigint" if name.endswith("Qty") else DEC


def _pairs(text: str) -> list[tuple[str, str]]:
    return [(x.split("=")[0], x.split("=")[-1]) for x in text.split()]


def _mapped(text: str) -> str:
    return ", ".join(f"cast(coalesce({src}, 0) as {_type_of(out)}) as {out}" for out, src in _pairs(text))


def _case_sum(cond: str, value: str, name: str) -> str:
    return f"cast(coalesce(sum({value}) filter ({cond}), 0) as {_type_of(name)}) as {name}"


def _pivoted(columns: list[str], source: str) -> str:
    return f"select BusinessMonth, LocationNo, {', '.join(columns)} from {source} group by BusinessMonth, LocationNo"


def _sales_pivot(source: str) -> str:
    out = []
    for prefix, types in SALES_SCOPES.items():
        for row in filter(None, SALES_PIVOT.split("\n")):
            name, value, cats = row.split()
            out.append(_case_sum(f"{types} and PrCat in ({_list(cats.split(','))})", value, prefix + name))
    return _pivoted(out, source)


def _xfers_pivot(source: str, sent: str, received: str, store_name: str) -> str:
    """``store_name`` is the pattern of the store-to-store measures' names."""
    out = []
    for cat in ("Dist", "Frln"):
        for kind, types in XFER_SCOPES.items():
            for value in ("Qty", "Cost"):
                if kind in ("Out", "In"):
                    name = store_name.format(c=cat, k=sent if kind == "Out" else received, v=value)
                else:
                    name = f"Tot{cat}Rfi{value}" if kind == "Rfi" else f"{cat}{kind}{value}"
                out.append(_case_sum(f"XfrTy in ({types}) and PrCat = '{cat.lower()}'", value, name))
    return _pivoted(out, source)


# --- v1 stages ------------------------------------------------------------------------------------

def _v1_stages(w) -> dict[str, str]:
    kept = "g.V1Xfer is not null"
    shop = _branches([
        (f"active_sale and {_in_window('ordered', w)}", 1, "ordered", "sold_at", ITEM, SIGNED, SIGNED, VALUE, 0),
    ])
    book = _branches([
        (f"placeholder and active_sale and {_in_window('ordered', w)}", 0, "ordered", "bookworm_at", "f_part", SIGNED, SIGNED, VALUE, 0),
    ])
    # left join: an order line beside each valid fulfilment line, or alone when its header or valid lines are missing
    at = "coalesce(left_at, facility_at)"
    istore = _branches([
        (f"istore_open and filled and qty > 0 and {_in_window('ordered', w)}", 2, "ordered", at, "part", "qty", 1, "amt", "3.99"),
        (f"istore_open and returned and amt > 0 and {_in_window('refunded', w)}", -2, "refunded", at, "part", 0, 0, "-amt", 0),
    ])
    web = _branches([
        (f"web_sold and {_in_window('ordered', w)}", 3, "ordered", "facility_at", "part", "qty", 1, "amt", "4.99"),
        (f"web_sold and returned and amt > 0 and {_in_window('modified', w)}", -3, "modified", "facility_at", "part", 0, 0, "-amt", 0),
    ])
    fanned = """
        select f.*, case when istore_system then coalesce(n.at, [null]) else [null] end as ats
        from f_line f left join (select ok, ln, list(fulfilled_at) as at from f_line where line_valid group by ok, ln) n
          on n.ok = f.ok and n.ln = f.ln"""
    s = {
        "f_v1_left": f"select * exclude (ats), unnest(ats) as left_at from ({fanned})",
        "q_v1_sales_tidy": " union all ".join([
            _sum_sales(f"select {shop} as b from f_line", kept, "g.V1Sales"),
            _sum_sales(f"select {book} as b from f_pair", kept, "g.V1Sales"),
            _sum_sales(f"select {istore} as b from f_v1_left", "true", "g.V1Sales"),
            _sum_sales(f"select {web} as b from f_line", "true", "g.V1Sales"),
        ]),
        "q_v1_xfers_tidy": _transfers(
            [(f"transfer_done and transfer_type <> 4 and {_in_window('ordered', w)}", "transfer_type", "ordered", "sold_at"),
             (f"transfer_done and transfer_type = 3 and {_in_window('ordered', w)}", "-transfer_type", "ordered", "sent_to")],
            "g.Cost", kept, "g.V1Xfer"),
        "q_v1_sales_wide": _sales_pivot("q_v1_sales_tidy"),
        "q_v1_xfers_wide": _xfers_pivot("q_v1_xfers_tidy", "O", "I", "{c}{k}StS{v}"),
        "q_v1_report": f"""
            with k as (select BusinessMonth as m, LocationNo as s from q_v1_sales_wide
                       union select BusinessMonth, LocationNo from q_v1_xfers_wide),
                 g as (select a.m as BusinessMonth, b.s as LocationNo
                       from (select distinct m from k where m is not null) a, (select distinct s from k) b)
            select g.BusinessMonth, g.LocationNo, {_mapped(V1_COLUMNS)}
            from g left join q_v1_sales_wide sw on sw.BusinessMonth = g.BusinessMonth and sw.LocationNo = g.LocationNo
                   left join q_v1_xfers_wide xw on xw.BusinessMonth = g.BusinessMonth and xw.LocationNo = g.LocationNo""",
    }
    return s


# --- report -----------------------------------------------------------------------------------------

def _loc_sql(kind: str, value: str) -> str:
    """Active stores for which the selector (kind, value) is one of those they answer to."""
    return f"""
        select distinct s.LocationNo, s.LocationNo || ' ' || s.Name as LocationName
        from v_locations s left join v_report_locations r on r.District = s.DistrictCode
        where s.RetailStore = 'Y' and s.Status = 'A' and '{kind}:{value}' in
              ('All Locations:', 'Store:' || s.LocationNo, 'District:' || s.DistrictCode, 'Region:' || coalesce(r.Region, ''))"""


def _report_columns() -> list[tuple[str, str, str]]:
    return [(band, out, src) for band, text in REPORT_BANDS.items() for out, src in _pairs(text)]


def _report_sql(picked: str, start, end) -> str:
    cols = ", ".join(f"r.{src} as {out}" for _, out, src in _report_columns())
    return f"""select r.BusinessMonth, r.LocationNo, {cols} from q_rollup r semi join {picked} p on p.LocationNo = r.LocationNo
               where r.BusinessMonth between {_d(start)} and {_d(end)}"""


def _currency(col: str) -> str:
    r = f"round({col}, 2)"
    txt = f"format('{{:,.2f}}', cast(abs({r}) as double))"
    return f"case when {r} < 0 then '($' || {txt} || ')' else '$' || {txt} end"


def _report_stages() -> dict[str, str]:
    s = {
        "q_loc_all": _loc_sql("All Locations", ""),
        "q_loc_store": _loc_sql("Store", R.STORE),
        "q_loc_district": _loc_sql("District", R.DISTRICT),
        "q_loc_region": _loc_sql("Region", R.REGION),
        "q_loc_unknown": _loc_sql(R.UNKNOWN_TYPE, R.REGION),
    }
    for key in ("all", "store", "district", "region", "unknown"):
        s[f"q_report_{key}"] = _report_sql(f"q_loc_{key}", R.REPORT_START, R.REPORT_END)
    s["q_report_date_range"] = _report_sql("q_loc_all", R.RANGE_START, R.RANGE_END)
    s["q_report_persisted_region"] = _report_sql("q_loc_region", R.RANGE_START, R.RANGE_END)
    fmt = ["strftime(BusinessMonth, '%-m/%-d/%Y') as BusinessMonth", "LocationNo"]
    fmt += [name if name.endswith("Qty") else f"{_currency(name)} as {name}" for _, name, _ in _report_columns()]
    s["q_report_formatted"] = f"select {', '.join(fmt)} from q_report_all"
    s["q_report_long"] = " union all ".join(
        f"select BusinessMonth, LocationNo, '{band}' as Band, '{name}' as Measure, cast({name} as {DEC}) as Value from q_report_all"
        for band, name, _ in _report_columns())
    return s


# --- final statements per registered key --------------------------------------------------------------

def _finals() -> dict[str, str]:
    w, w1 = R.WINDOW, R.WINDOW_ONE
    f = {f"src_{n}": f"select * from v_{n}" for n in R.SOURCE_NAMES}
    f["category_dim"] = """
        select distinct t.ProductType, f_type.Cat as PTypeCategory, t.PTypeClass
        from v_product_types t join f_type on f_type.ProductType = t.ProductType"""
    for name in ("sales_tidy", "sales_wide", "xfers_tidy", "xfers_wide", "key_grid", "rollup"):
        f[name] = f"select * from q_{name}"
    codes = {"register": 1, "istore_shipped": 2, "istore_refunds": -2, "web_shipped": 3, "web_refunds": -3, "bookworm": 0}
    for branch, code in codes.items():
        f[f"sales_{branch}"] = f"select * from q_sales_tidy where SldTy = {code}"
        f[("v1_" if branch[0] in "iw" else "v1_sales_") + branch] = f"select * from q_v1_sales_tidy where SldTy = {code}"
    for prefix in ("", "v1_"):   # no type is zero: positive is outbound
        f[f"{prefix}xfers_out"] = f"select * from q_{prefix}xfers_tidy where XfrTy > 0"
        f[f"{prefix}xfers_in"] = f"select * from q_{prefix}xfers_tidy where XfrTy < 0"
    f["grid_months"] = "select distinct BusinessMonth from q_key_grid"
    f["grid_locations"] = "select distinct LocationNo from q_key_grid"
    f["rollup_scan"] = "select * from q_rollup"
    f["rollup_delete_keys"] = """
        select * from q_rollup r
        anti join q_key_grid_m g on g.BusinessMonth = r.BusinessMonth and g.LocationNo = r.LocationNo"""
    f["rollup_replace_by_key"] = f["rollup_delete_keys"] + " union all select * from q_rollup_m"
    f["dq_rollup_duplicate_keys"] = """
        select BusinessMonth, LocationNo, cast(2 as bigint) as n from q_rollup
        intersect select BusinessMonth, LocationNo, cast(2 as bigint) from q_rollup_m"""
    f["dq_category_duplicate_keys"] = """
        select ProductType, cast(2 as bigint) as n from v_product_types where PTypeClass = 'NEW'"""
    f["rollup_rejects"] = f"""
        select 'sales' as Source, BusinessMonth, LocationNo, SldTy as Ty, PrCat, Qty, Cost, Val, Fee from q_sales_tidy
        where BusinessMonth is null or LocationNo is null
        union all
        select 'xfers', BusinessMonth, LocationNo, XfrTy, PrCat, Qty, Cost, cast(null as {DEC}), cast(null as {DEC}) from q_xfers_tidy
        where BusinessMonth is null or LocationNo is null"""
    f["tidy_incremental"] = f"""
        select 'sales' as Source, BusinessMonth, LocationNo, SldTy as Ty, PrCat, Qty, Cost, Val, Fee from q_sales_tidy
        union all
        select 'xfers', BusinessMonth, LocationNo, XfrTy, PrCat, Qty, Cost, cast(null as {DEC}), cast(null as {DEC}) from q_xfers_tidy"""
    f["rollup_rejects_rerun"] = f"select *, BusinessMonth as RunMonth from ({f['rollup_rejects']})"   # null stores only, read in their month
    f["rollup_rolled_back"] = "select * from q_rollup"
    f["report_months"] = f"""
        select distinct BusinessMonth as PARAMDATE, strftime(BusinessMonth, '%B %Y') as MonthYearPARAM, last_day(BusinessMonth) as LastDayOfMonth
        from q_rollup where BusinessMonth between {_d(month_list_start(R.AS_OF))} and {_d(R.AS_OF)}"""
    f["dq_null_keys"] = f"select Source, BusinessMonth, LocationNo, Ty, PrCat from ({f['rollup_rejects']})"
    for win_key, win in (("window_default", w), ("window_one_month", w1)):
        f[win_key] = f"""
            select SalesXactionId, LineNumber, BusinessDate, {_d(win.start)} as WindowStart,
                   {_d(win.end)} as WindowEnd, ({_in_window('BusinessDate', win)}) as InWindow
            from v_sales_item"""
    f["month_bucket"] = f"""
        select SalesXactionId, LineNumber, BusinessDate, {_month('BusinessDate')} as BusinessMonth from v_sales_item"""
    f["signed_quantity"] = """
        select SalesXactionId, LineNumber, Quantity, IsReturn,
               Quantity * case when IsReturn = 'Y' then -1 else 1 end as SignedQty
        from v_sales_item"""
    f["location_fallback"] = """
        select o.ISIS_OrderID, d.LocationNo as FulfilLocationNo, f.FacilityLocationNo,
               coalesce(d.LocationNo, f.FacilityLocationNo) as LocationNo
        from v_istore_orders o
        join v_facilities f using (FacilityID)
        join v_fulfil_header h on h.ISISOrderID = o.ISIS_OrderID
        join v_fulfil_detail d on d.OrderID = h.OrderID"""
    f["bookworm_xaction_id"] = """
        select locationId, tillnumber, transactionNumber, detailNumber,
               tillnumber || right('000000000' || transactionNumber, 9) as XactionId
        from v_bookworm"""
    f["bookworm_sku_pad"] = "select SKU, right(repeat('0', 20) || SKU, 20) as ItemCode from v_bookworm"
    f["report_default_dates"] = """
        select distinct BusinessDate as AsOf,
               cast(date_trunc('month', BusinessDate) - interval 1 month as date) as StartDate,
               cast(date_trunc('month', BusinessDate) - interval 1 day as date) as EndDate
        from v_sales_header"""
    f["join_sales_header_item"] = """
        select ln.*, h.Status, h.XactionType
        from v_sales_item ln
        join (select LocationID, BusinessDate, SalesXactionID as SalesXactionId, Status, XactionType
              from v_sales_header) h using (LocationID, BusinessDate, SalesXactionId)"""
    f["join_bookworm_items"] = """
        select ln.LocationID, ln.SalesXactionId, ln.LineNumber, ln.ItemCode,
               right(repeat('0', 20) || b.SKU, 20) as BookwormItemCode, b.LocationNo as BookwormLocationNo
        from v_sales_item ln, v_bookworm b
        where b.locationId = ln.LocationID and b.detailNumber = ln.LineNumber
          and ln.SalesXactionId = b.tillnumber || right('000000000' || b.transactionNumber, 9)"""
    f["join_xfer_header_detail"] = """
        select TransferBinNo, h.LocationNo, h.ToLocationNo, h.TransferType, h.StatusCode as HeaderStatus,
               h.CreateTime as HeaderTime, d.DipsItemCode, d.Quantity, d.DipsCost,
               d.StatusCode as DetailStatus, d.CreateTime, d.UpdateTime
        from v_xfer_header h join v_xfer_detail d using (TransferBinNo)"""
    for key in ("all", "store", "district", "region", "unknown"):
        f[f"loc_{key}"] = f"select * from q_loc_{key}"
        f["report_all_locations" if key == "all" else f"report_{key}"] = f"select * from q_report_{key}"
    for key in ("date_range", "formatted", "long", "persisted_region"):
        f[f"report_{key}"] = f"select * from q_report_{key}"
    first = month_list_start(R.AS_OF)
    f["month_dim"] = f"""
        select PARAMDATE, strftime(PARAMDATE, '%B %Y') as MonthYearPARAM, last_day(PARAMDATE) as LastDayOfMonth
        from (select distinct {_month('BusinessDate')} as PARAMDATE from v_sales_header
              where BusinessDate >= {_d(first)} and BusinessDate <= {_d(R.AS_OF)})"""
    f["location_dim"] = """
        select 'All Locations' as FilterType, 'All Locations' as DynFilter, 'All Locations' as DynFilterLabel
        union all
        select 'Store', LocationNo, LocationNo || ' ' || Name from v_locations where RetailStore = 'Y' and Status = 'A'
        union all
        select distinct 'District', DistrictCode, DistrictCode from v_locations
        where RetailStore = 'Y' and Status = 'A'
        union all
        select distinct 'Region', rl.Region, rl.Region from v_report_locations rl
        where rl.District in (select DistrictCode from v_locations where RetailStore = 'Y' and Status = 'A')"""
    f["v1_sales_classify"] = """
        select distinct m.ItemCode, m.ProductType, t.V1Sales as PrCat
        from v_product_master m join f_type t on t.ProductType = m.ProductType"""
    f["v1_xfers_classify"] = """
        select m.ItemCode, m.ProductType, case when suffix(m.ProductType, 'F') then 'frln' else 'dist' end as PrCat
        from v_product_master m"""
    for name in ("v1_sales_wide", "v1_xfers_wide", "v1_report"):
        f[name] = f"select * from q_{name}"
    return f


def _all_ctes() -> dict[str, str]:
    ctes = {**VIEWS, **FACTS}
    ctes.update(_stages(R.WINDOW, ""))
    ctes.update(_stages(R.WINDOW_ONE, "_m"))
    ctes.update(_v1_stages(R.WINDOW))
    ctes.update(_report_stages())
    return ctes


_NAME = re.compile(r"\b([vqf]_[A-Za-z0-9_]+)\b")


def _with(final: str, ctes: dict[str, str]) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in ctes and name not in seen:
                seen.add(name)
                visit(ctes[name])
                order.append(name)

    visit(final)
    if not order:
        return final
    body = ",\n".join(f"{name} as ({ctes[name]})" for name in order)
    return f"with {body}\n{final}"


def statements() -> dict[str, str]:
    ctes = _all_ctes()
    return {key: _with(final, ctes) for key, final in _finals().items()}
