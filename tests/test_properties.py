"""Property tests: Column helpers agree with plain-Python statements of the same rules."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcost.functions.columns import bookworm_xaction_id, item_code_from_sku
from shelfcost.functions.dates import add_months, report_default_dates, resolve_window

digits = st.text(alphabet="0123456789", min_size=0, max_size=25)
days = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2200, 12, 31))


def right_fill(text, fill, width):
    """right(replicate(fill, width) + text, width), NULL-propagating."""
    return None if text is None else (fill * width + text)[-width:]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), digits), st.one_of(st.none(), digits), st.one_of(st.none(), digits)),
                min_size=1, max_size=30))
def test_ids_match_python(spark, rows):
    df = spark.createDataFrame(rows, "till string, txn string, sku string")
    got = df.select(bookworm_xaction_id(F.col("till"), F.col("txn")).alias("x"),
                    item_code_from_sku(F.col("sku")).alias("i")).collect()
    for (till, txn, sku), r in zip(rows, got):
        want_x = None if till is None or txn is None else till + right_fill(txn, "0", 9)
        assert r.x == want_x
        assert r.i == right_fill(sku, "0", 20)


@settings(max_examples=200, deadline=None)
@given(days, st.integers(min_value=-40, max_value=40))
def test_add_months_lands_on_first(day, n):
    got = add_months(day, n)
    assert got.day == 1
    assert (got.year * 12 + got.month) - (day.year * 12 + day.month) == n


@settings(max_examples=200, deadline=None)
@given(days, days)
def test_windows(day, as_of):
    w = resolve_window(day, as_of)
    assert w.start <= day < w.end and w.start.day == 1 and w.end == add_months(w.start, 1)
    d = resolve_window(None, as_of)
    assert d.start == dt.date(as_of.year - 3, 1, 1) and d.end == as_of.replace(day=1)
    start, end = report_default_dates(as_of)
    assert start.day == 1 and end == as_of.replace(day=1) - dt.timedelta(days=1) and start <= end


tidy_rows = st.lists(
    st.tuples(
        st.sampled_from([dt.date(2001, 1, 1), dt.date(2001, 2, 1)]),
        st.sampled_from(["00001", "00002"]),
        st.sampled_from([1, 2, -2, 3, -3, 0]),
        st.sampled_from(["dist", "frln", "scan", "gc", "used"]),
        st.integers(-5, 50),
        st.integers(-10_000, 100_000),
        st.integers(-10_000, 100_000),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=10, deadline=None)
@given(tidy_rows)
def test_sales_pivot_matches_scope_rules(spark, rows):
    from decimal import Decimal

    from shelfcost.operators.pivot import SALES_MEASURES, pivot_measures

    cents = [(m, s, t, c, q, Decimal(cost) / 100, Decimal(val) / 100) for m, s, t, c, q, cost, val in rows]
    df = spark.createDataFrame(
        cents, "BusinessMonth date, LocationNo string, SldTy int, PrCat string, Qty long, "
               "Cost decimal(19,4), Val decimal(19,4)")
    got = {(r.BusinessMonth, r.LocationNo): r.asDict() for r in pivot_measures(df, SALES_MEASURES).collect()}
    scopes = {"": lambda t: True, "s": lambda t: t == 1, "o": lambda t: abs(t) > 1, "bw": lambda t: t == 0}
    QTY, COST, VAL = 4, 5, 6   # positions in a row
    kinds = {"DistSoldCost": ({"dist", "scan"}, COST), "DistSoldVal": ({"dist", "scan"}, VAL),
             "FrlnSoldCost": ({"frln"}, COST), "FrlnSoldVal": ({"frln"}, VAL), "ScanSoldQty": ({"scan"}, QTY),
             "ScanSoldCost": ({"scan"}, COST), "ScanSoldVal": ({"scan"}, VAL)}
    for key in {(r[0], r[1]) for r in cents}:
        for prefix, in_scope in scopes.items():
            for name, (cats, idx) in kinds.items():
                want = sum((r[idx] for r in cents if (r[0], r[1]) == key and in_scope(r[2]) and r[3] in cats), 0)
                assert got[key][prefix + name] == want, (key, prefix + name)


xfer_rows = st.lists(
    st.tuples(
        st.sampled_from([dt.date(2001, 1, 1), dt.date(2001, 2, 1)]),
        st.sampled_from(["00001", "00002"]),
        st.sampled_from([1, 2, 3, 4, 7, -1, -2, -3, -7]),
        st.sampled_from(["dist", "frln", "scan"]),
        st.integers(0, 50),
        st.integers(0, 100_000),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=10, deadline=None)
@given(xfer_rows)
def test_transfer_pivot_matches_type_rules(spark, rows):
    from decimal import Decimal

    from shelfcost.operators.pivot import XFER_MEASURES, pivot_measures

    data = [(m, s, t, c, q, Decimal(cost) / 100) for m, s, t, c, q, cost in rows]
    df = spark.createDataFrame(data, "BusinessMonth date, LocationNo string, XfrTy int, PrCat string, "
                                     "Qty long, Cost decimal(19,4)")
    got = {(r.BusinessMonth, r.LocationNo): r.asDict() for r in pivot_measures(df, XFER_MEASURES).collect()}
    stems = {"Tsh": {1}, "Dmg": {7}, "Dnt": {2}, "Rfi": {1, 2, 7}, "TotXfrOut": {3}, "TotXfrIn": {-3}}
    for key in {(r[0], r[1]) for r in data}:
        for cat, title in (("dist", "Dist"), ("frln", "Frln")):
            for stem, types in stems.items():
                for measure, idx in (("Qty", 4), ("Cost", 5)):
                    name = f"Tot{title}Rfi{measure}" if stem == "Rfi" else f"{title}{stem}{measure}"
                    want = sum((r[idx] for r in data if (r[0], r[1]) == key and r[2] in types and r[3] == cat), 0)
                    assert got[key][name] == want, (key, name)
