"""Data-quality checks standing in for the database's key constraints.

Spark tables have no primary keys; these return the violating rows so a job
can fail, or route them aside, before writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7: keys occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K8: rows with a NULL in any key column."""
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with complete keys, rejected rows with a NULL key)."""
    good = df
    for k in keys:
        good = good.where(F.col(k).isNotNull())
    return good, null_keys(df, keys)


class KeyViolation(ValueError):
    """Rows would break the table's key: duplicate or NULL key values."""


def enforce_key(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = ()) -> None:
    """Raise :class:`KeyViolation` if ``df`` has a NULL or repeated key, or a NULL in ``not_null`` (one grouped pass)."""
    bad = F.col("n") > 1
    for k in keys:
        bad = bad | F.col(k).isNull()
    empty = F.lit(0)
    for c in not_null:
        empty = empty + F.count_if(F.col(c).isNull())
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), empty.alias("empty")).where(bad | (F.col("empty") > 0)).limit(1).collect()
    if rows:
        key = [rows[0][k] for k in keys]
        if any(v is None for v in key):
            raise KeyViolation(f"NULL in key {key}")
        raise KeyViolation(f"duplicate key {key}" if rows[0]["n"] > 1 else f"NULL column at key {key}")
