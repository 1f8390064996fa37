"""shelfcost: monthly new-goods cost rollups per store, as Spark DataFrame jobs.

Layout
------
sources/    typed readers for the source tables, plus the adapter that derives
            them from the driver's star-schema test tables
functions/  Column-level building blocks (month buckets, signs, ids, classes)
operators/  DataFrame -> DataFrame operators (branches, pivots, grid, writer,
            report, quality checks, the older v1 rule set)
plans/      end-to-end jobs and the registry of named queries
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
