"""Bucketed headers and lines: J1 and J10 without an exchange, same results."""

from __future__ import annotations

import uuid

import pytest

from shelfcost.operators import sales, transfers
from shelfcost.plans.registry import WINDOW, WINDOW_ONE
from shelfcost.sources.bucketed import KEYS, with_bucketed, write_bucketed

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}


@pytest.fixture(scope="module")
def bucketed(spark, star_src):
    prefix = f"b{uuid.uuid4().hex}_"
    write_bucketed(star_src, prefix, 6)
    yield with_bucketed(star_src, prefix)
    for name in KEYS:
        spark.sql(f"DROP TABLE {prefix}{name}")


def _below_join(df) -> list[str]:
    """Node names below the lowest join of the executed plan."""
    todo, lowest = [df._jdf.queryExecution().executedPlan()], None
    while todo:
        node = todo.pop(0)
        if "Join" in node.nodeName():
            lowest = node
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    names, todo = [], [lowest]
    while todo:
        node = todo.pop()
        names.append(node.nodeName())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return names


@pytest.mark.parametrize("lines", [sales.register_lines, lambda src, window: transfers._lines(src)], ids=["J1", "J10"])
def test_no_exchange_below_the_join(spark, star_src, bucketed, lines):
    for key, value in OFF.items():
        spark.conf.set(key, value)
    try:
        names = _below_join(lines(bucketed, WINDOW))
        assert "SortMergeJoin" in names and not any("Exchange" in n for n in names), names
        assert any("Exchange" in n for n in _below_join(lines(star_src, WINDOW)))
    finally:
        for key in OFF:
            spark.conf.unset(key)


@pytest.mark.parametrize("window", [WINDOW, WINDOW_ONE], ids=["default", "month"])
def test_results_are_equal(star_src, bucketed, window):
    for branch in (sales.sales_tidy, transfers.xfers_tidy):
        assert sorted(map(tuple, branch(bucketed, window).collect()), key=str) == sorted(map(tuple, branch(star_src, window).collect()), key=str)
