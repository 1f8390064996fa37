import datetime as dt

from pyspark.sql import functions as F

from shelfcost.functions.dates import (
    Window,
    add_months,
    month_bucket,
    month_list_start,
    report_default_dates,
    report_default_end_col,
    report_default_start_col,
    resolve_window,
)

D = dt.date


def test_window_month_given_e7():
    assert resolve_window(D(2024, 3, 17), D(2030, 1, 1)) == Window(D(2024, 3, 1), D(2024, 4, 1))


def test_window_december_rolls_year():
    assert resolve_window(D(2023, 12, 5), D(2030, 1, 1)) == Window(D(2023, 12, 1), D(2024, 1, 1))


def test_window_default_fixture():
    assert resolve_window(None, D(2001, 8, 15)) == Window(D(1998, 1, 1), D(2001, 8, 1))


def test_report_defaults_january_e6():
    assert report_default_dates(D(2024, 1, 17)) == (D(2023, 12, 1), D(2023, 12, 31))
    assert report_default_dates(D(2024, 3, 1)) == (D(2024, 2, 1), D(2024, 2, 29))


def test_add_months_and_month_list():
    assert add_months(D(2024, 1, 1), -1) == D(2023, 12, 1)
    assert add_months(D(2024, 11, 1), 14) == D(2026, 1, 1)
    assert month_list_start(D(2024, 6, 9)) == D(2021, 1, 1)


def test_column_forms_match_python(spark):
    days = [D(2024, 1, 17), D(2024, 3, 1), D(2023, 12, 31), D(2000, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        "d", month_bucket(F.col("d")).alias("m"), report_default_start_col(F.col("d")).alias("s"),
        report_default_end_col(F.col("d")).alias("e"),
    ).collect()
    for r in rows:
        assert r.m == r.d.replace(day=1)
        assert (r.s, r.e) == report_default_dates(r.d)


def test_month_bucket_accepts_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 5, 31, 23, 59),)], "t timestamp")
    assert df.select(month_bucket(F.col("t"))).first()[0] == D(2001, 5, 1)


def test_window_is_half_open(spark):
    w = Window(D(2001, 5, 1), D(2001, 6, 1))
    df = spark.createDataFrame([(D(2001, 5, 1),), (D(2001, 6, 1),), (D(2001, 5, 31),)], "d date")
    got = sorted(r.d for r in df.where(w.contains(F.col("d"))).collect())
    assert got == [D(2001, 5, 1), D(2001, 5, 31)]


def test_contains_first_equals_coalesce_window(spark):
    w = Window(D(2001, 5, 1), D(2001, 6, 1))
    vals = [None, D(2001, 4, 30), D(2001, 5, 1), D(2001, 5, 31), D(2001, 6, 1)]
    rows = [(u, c) for u in vals for c in vals]
    df = spark.createDataFrame(rows, "u date, c date")
    got = df.select(
        w.contains_first(F.col("u"), F.col("c")).alias("a"),
        w.contains(F.coalesce(F.col("u"), F.col("c"))).alias("b"),
    ).collect()
    assert all((r.a is True) == (r.b is True) for r in got)
