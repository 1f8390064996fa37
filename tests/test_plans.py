"""Plan-shape guards: the scale properties the design relies on, read from explain()."""

from __future__ import annotations

import contextlib
import io
import os
import tempfile

import pytest

from shelfcost.operators import sales, transfers
from shelfcost.plans import registry
from shelfcost.sources.catalog import from_tables
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_register_window_reaches_both_scans(star_src):
    text = plan(sales.sales_register(star_src, registry.WINDOW))
    pushed = [ln for ln in text.splitlines() if ln.startswith("PushedFilters") and "o_orderdate" in ln]
    assert len(pushed) >= 2 and all("GreaterThanOrEqual(o_orderdate" in ln and "LessThan(o_orderdate" in ln
                                    for ln in pushed)


def test_scans_read_only_used_columns(star_src):
    text = plan(sales.sales_register(star_src, registry.WINDOW))
    schemas = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and not any("o_totalprice" in ln or "l_discount" in ln or "l_tax" in ln for ln in schemas)


@pytest.mark.parametrize("name", ["key_grid", "rollup", "v1_report", "report_all_locations"])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_windows_pushed_on_file_backed_sources(spark, star_src):
    root = tempfile.mkdtemp(prefix="shelfcost-plans-")
    names = ["xfer_header", "xfer_detail", "product_master", "product_types", "istore_orders", "fulfil_header",
             "fulfil_detail", "facilities"]
    paths = {n: os.path.join(root, n) for n in names}
    for n in names:
        star_src.table(n).write.parquet(paths[n])
    src = from_tables(spark, paths)
    inbound = plan(transfers.xfers_in(src, registry.WINDOW_ONE))
    assert "Or(And(GreaterThanOrEqual(UpdateTime" in inbound and "IsNull(UpdateTime)" in inbound
    online = plan(sales.online_sales(src, registry.WINDOW_ONE, web=()))
    assert "Or(And(And(GreaterThanOrEqual(ShipDate" in online and "GreaterThanOrEqual(RefundDate" in online
    assert "StringStartsWith(SKU,D)" in online and "StringStartsWith(OrderSystem,MON)" in online


def test_text_predicates_pushed_on_file_backed_sources(spark, star_src):
    root = tempfile.mkdtemp(prefix="shelfcost-text-")
    names = ["sales_header", "sales_item", "bookworm", "product_master", "product_types"]
    paths = {n: os.path.join(root, n) for n in names}
    for n in names:
        star_src.table(n).write.parquet(paths[n])
    text = plan(sales.sales_bookworm(from_tables(spark, paths), registry.WINDOW))
    assert "StringStartsWith(ItemCode,00000000000010222778)" in text and "StringStartsWith(Status,A)" in text


def test_report_months_prune_the_persisted_rollup(spark):
    text = plan(registry.QUERIES["report_date_range"](spark, SF_SMALL))
    pruned = [ln for ln in text.splitlines() if ln.startswith("PartitionFilters") and "BusinessMonth" in ln]
    assert pruned and "2000-01-01" in pruned[0] and "2000-06-30" in pruned[0]


@pytest.mark.parametrize("name, scans", [("sales_tidy", 11), ("xfers_tidy", 3)])
def test_branches_share_their_passes(spark, name, scans):
    text = plan(registry.QUERIES[name](spark, SF_SMALL))
    facts = sum(ln.startswith("Location: ") and ("lineitem" in ln or "orders" in ln) for ln in text.splitlines())
    assert facts <= scans, facts


def test_queries_start_few_jobs_while_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    registry.QUERIES["report_date_range"](spark, SF_SMALL)     # the persisted rollup is there from now on
    before = set(tracker.getJobIdsForGroup(None))
    for name in ("sales_tidy", "xfers_tidy", "v1_sales_wide", "report_date_range"):
        registry.QUERIES[name](spark, SF_SMALL)
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 4
