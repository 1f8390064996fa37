"""Headers and lines laid out together: joins on the transaction and on the bin without a shuffle.

The two joins that read the most, register header with lines and bin header with lines, are on the same keys in every run. Where the
tables are loaded by us they can be kept as bucketed tables: both sides hashed by the join key into the same number of buckets and
sorted there, so Spark joins bucket by bucket. A key may hold many lines but only as many as one transaction or bin has,
so buckets are even; their number is chosen so that a bucket of the lines fits a task.

Text is stored right-trimmed, as :func:`~shelfcost.sources.catalog.normalise` would give it, because a trimmed column is no longer the one
that was hashed.
"""

from __future__ import annotations

from shelfcost.sources.catalog import Sources

#: Join key of each table, in the order of the other side's.
KEYS = {
    "sales_header": ("LocationID", "BusinessDate", "SalesXactionID"),
    "sales_item": ("LocationID", "BusinessDate", "SalesXactionId"),
    "xfer_header": ("TransferBinNo",),
    "xfer_detail": ("TransferBinNo",),
}


def write_bucketed(src: Sources, prefix: str, buckets: int) -> None:
    """Write the four tables of ``src`` as bucketed tables ``<prefix><name>`` of the catalog."""
    for name, keys in KEYS.items():
        rows = src.table(name).repartition(buckets, *keys)      # one file a bucket
        rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{prefix}{name}")


def with_bucketed(src: Sources, prefix: str) -> Sources:
    """``src`` with the four tables read from the bucketed ones."""
    def reader(name: str):
        if name in KEYS:
            return lambda: src.spark.table(f"{prefix}{name}")
        return lambda: src.raw(name)

    return Sources(src.spark, {name: reader(name) for name in src.names()}, {*src.trimmed, *KEYS})
