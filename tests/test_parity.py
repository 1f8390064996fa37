"""Spark vs DuckDB oracle on the sf0.001 star tables (the full sweep is ``python tests/parity.py``)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from shelfcost import oracle
from shelfcost.plans import registry
from tests.conftest import SF_SMALL
from tests.parity import compare, duck

KEYS = sorted(registry.QUERIES)
# nothing can match an unknown selector
EMPTY = {"loc_unknown", "report_unknown"}


@pytest.fixture(scope="module")
def ctx():
    return registry.QUERIES, oracle.statements(), duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.statements())
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", KEYS)
def test_parity(spark, ctx, name):
    queries, statements, con = ctx
    res = compare(spark, con, name, SF_SMALL, queries, statements)
    assert res["ok"], res
    assert (con.execute(f"select count(*) from ({statements[name]})").fetchone()[0] == 0) == (name in EMPTY)


@pytest.mark.parametrize("what", ["pivot", "report"])
def test_an_error_in_the_library_lists_turns_rows_red(spark, ctx, what, monkeypatch):
    """The oracle states the measure scopes and column mappings itself."""
    import dataclasses

    from shelfcost.operators import pivot, report

    _, statements, con = ctx
    if what == "pivot":
        name = "sales_wide"
        wrong = [dataclasses.replace(m, cats=("dist",)) if m.name == "DistSoldVal" else m for m in pivot.SALES_MEASURES]
        monkeypatch.setattr(registry, "SALES_MEASURES", wrong)
    else:
        name = "report_region"
        swap = {"DistSoldCost": "FrlnSoldCost", "FrlnSoldCost": "DistSoldCost"}
        monkeypatch.setattr(report, "REPORT_COLUMNS", tuple((o, swap.get(c, c)) for o, c in report.REPORT_COLUMNS))
    assert not compare(spark, con, name, SF_SMALL, registry.QUERIES, statements)["ok"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["BusinessMonth", "LocationNo"] and len(df.columns) == 41


NO_BROADCAST_KEYS = ["sales_register", "sales_tidy", "xfers_tidy", "rollup", "v1_report", "report_region"]
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name", NO_BROADCAST_KEYS)
def test_parity_without_broadcasts(spark, ctx, name):
    """With every join shuffled the answers are the same."""
    queries, statements, con = ctx
    old = {k: spark.conf.get(k) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        res = compare(spark, con, name, SF_SMALL, queries, statements)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert res["ok"], res
