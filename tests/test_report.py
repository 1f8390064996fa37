from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from shelfcost.operators import report
from shelfcost.sources.schemas import ROLLUP_MEASURES


def test_currency_format(spark):
    vals = ["1234.5", "-1234.567", "-0.004", "0.005", "1000000", "0", "-0.005"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "x decimal(19,4)")
    got = [r[0] for r in df.select(report.currency(F.col("x"))).collect()]
    assert got == ["$1,234.50", "($1,234.57)", "$0.00", "$0.01", "$1,000,000.00", "$0.00", "($0.01)"]


def test_report_columns_cover_the_rollup():
    sources = [src for _, src in report.REPORT_COLUMNS[2:]]
    assert sorted(sources) == sorted(name for name, _ in ROLLUP_MEASURES)
    assert len(report.REPORT_COLUMNS) == 41


def test_bands_partition_the_measures():
    bands = report.band_of()
    assert list(bands) == list(report.MEASURE_NAMES)
    widths = {}
    for b in bands.values():
        widths[b] = widths.get(b, 0) + 1
    assert widths == dict(report.REPORT_BANDS)
    assert bands["ScanSoldQty"] == "In-Store Sales" and bands["FrlnDonateQty"] == "Trash/Damage/Donate Transfers"



def test_reports_are_sorted(spark):
    """By month, then store."""
    from shelfcost.plans import registry
    from tests.conftest import SF_SMALL

    for name in ("report_all_locations", "report_date_range", "report_persisted_region", "v1_report"):
        rows = [(r.BusinessMonth, r.LocationNo or "") for r in registry.QUERIES[name](spark, SF_SMALL).collect()]
        assert rows and rows == sorted(rows)
