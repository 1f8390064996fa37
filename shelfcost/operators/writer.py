"""Replace-by-key writer of the rollup table.

The table and the reject ledger are versioned together (:mod:`shelfcost.operators.versions`), both Parquet: the
rollup by ``BusinessMonth``, so report month ranges prune folders, with the rows of a month in store order and small row groups,
so that a report on some stores skips the others; the ledger by ``RunMonth``, the month of the run window that a rejected
row was read in.

A run replaces exactly the (month, store) keys of its grid, and the ledger of exactly its window's months:

1. read the affected months of the table (only these folders),
2. drop rows whose key is in the grid (left anti join on both columns, so a
   store missing from this run keeps its row -- never a whole-month replace),
3. add the run's rows and write the affected months to a new folder,
4. check the written rows against the table's key (no NULL, no repeat),
5. write the run's rejects to a new folder,
6. commit both as one new version.

No file is overwritten, so nothing is recomputed from files that are half replaced, and a job that dies at any step before 6
leaves the table, the ledger and their readers as they were.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcost.functions.dates import Window
from shelfcost.operators import quality, versions
from shelfcost.operators.pivot import KEYS
from shelfcost.session import checkpoint_dir
from shelfcost.sources.schemas import REJECTS, ROLLUP


def conform(df: DataFrame) -> DataFrame:
    """K9: columns in table order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ROLLUP.fields])


ROLLUP_TABLE, REJECT_TABLE, REFUSED_TABLE = "rollup", "rejects", "refused"
MONTH, RUN_MONTH = "BusinessMonth", "RunMonth"
#: Size of the table's row groups, which are what a store filter skips.
ROW_GROUP_BYTES = 1 << 20


def create_table(spark: SparkSession, path: str) -> None:
    """K9: (re)create the rollup table at ``path``, empty, with the declared schema."""
    base = versions.load(spark, path)
    versions.commit(spark, path, base, {ROLLUP_TABLE: dict.fromkeys(base.tables.get(ROLLUP_TABLE, {}))})


def delete_keys(target: DataFrame, keys: DataFrame) -> DataFrame:
    """K5: target rows whose (month, store) key is not in ``keys``."""
    return target.join(keys.select(*KEYS), list(KEYS), "left_anti")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a version with the rollup was committed at ``path``."""
    return ROLLUP_TABLE in versions.load(spark, path).tables


def read_rollup(spark: SparkSession, path: str, version: versions.Version | None = None) -> DataFrame:
    """The persisted rollup with its declared schema, at the newest version or a given one."""
    return versions.read(spark, path, ROLLUP_TABLE, ROLLUP, MONTH, version)


def read_rejects(spark: SparkSession, path: str, version: versions.Version | None = None) -> DataFrame:
    """K8: the reject ledger: the tidy rows with a NULL month or store of each month's last run."""
    return versions.read(spark, path, REJECT_TABLE, REJECTS, RUN_MONTH, version)


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    """The rejects for which the last run was refused; empty once a run went through."""
    return versions.read(spark, path, REFUSED_TABLE, REJECTS, RUN_MONTH)


def rollup_months(spark: SparkSession, path: str) -> DataFrame:
    """The months that the persisted rollup holds, from its version file alone."""
    return versions.partition_values(spark, path, ROLLUP_TABLE, ROLLUP[MONTH])


def _stage_rejects(rejects: DataFrame, path: str, table: str) -> dict[str, str]:
    rows = rejects.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REJECTS.fields])
    return versions.stage(rows, path, table, RUN_MONTH)


def refuse(spark: SparkSession, path: str, rejects: DataFrame) -> None:
    """Keep the rejects of a run that is refused, beside the table and its ledger, which stay as they are."""
    base = versions.load(spark, path)
    runs = _stage_rejects(rejects, path, REFUSED_TABLE)
    versions.commit(spark, path, base, {REFUSED_TABLE: dict.fromkeys(base.tables.get(REFUSED_TABLE, {})) | runs})


def replace_by_key(spark: SparkSession, path: str, new_rows: DataFrame, grid: DataFrame,
                   rejects: DataFrame | None = None, window: Window | None = None,
                   base: versions.Version | None = None, also: Mapping[str, Mapping[str, str | None]] | None = None) -> versions.Version:
    """K5 + K6 + K8: replace the grid's keys by ``new_rows`` and the ledger of ``window`` by ``rejects``, in one commit.

    ``base`` is the version that the caller read (the newest by default), ``also`` are staged changes of other tables of it.
    """
    base = base or versions.load(spark, path)
    months = grid.select(MONTH).distinct()
    affected = {str(r[0]) for r in months.collect()}                          # months of the run, one value each
    held = {m: run for m, run in base.tables.get(ROLLUP_TABLE, {}).items() if m in affected}
    existing = read_rollup(spark, path, versions.Version(base.number, {ROLLUP_TABLE: held}))
    merged = delete_keys(existing, grid).select(*ROLLUP.fieldNames()).unionByName(conform(new_rows))
    runs = versions.stage(
        merged.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS),         # a large month spreads over tasks
        path, ROLLUP_TABLE, MONTH, {"parquet.block.size": str(ROW_GROUP_BYTES)},
    )
    changes = {**(also or {}), ROLLUP_TABLE: dict.fromkeys(held) | runs}
    quality.enforce_key(versions.read(spark, path, ROLLUP_TABLE, ROLLUP, MONTH, versions.Version(0, {ROLLUP_TABLE: runs})), KEYS)
    if rejects is not None:
        changes[REJECT_TABLE] = dict.fromkeys(str(m) for m in window.months()) | _stage_rejects(rejects, path, REJECT_TABLE)
        changes[REFUSED_TABLE] = dict.fromkeys(base.tables.get(REFUSED_TABLE, {}))
    return versions.commit(spark, path, base, changes)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh table folder under the shared checkpoint folder."""
    import uuid

    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
