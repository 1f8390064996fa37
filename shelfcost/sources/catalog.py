"""Name -> DataFrame registry of the source tables.

Operators never read files themselves; they take a :class:`Sources` and ask
for tables by name. Two constructors:

* :func:`from_star` -- the driver's star-schema test tables, mapped onto the
  retail tables by :mod:`shelfcost.sources.star`.
* :func:`from_tables` -- real source tables (parquet paths or catalog
  names), read with a typed select of only the used columns; text is
  right-trimmed once here, so no operator repeats ``rtrim``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcost.session import checkpoint_dir, shuffles_released
from shelfcost.sources import star
from pyspark.sql.types import StringType

from shelfcost.sources.schemas import PHYSICAL_NAMES, SOURCE_COLUMNS


def normalise(name: str, df: DataFrame, trimmed: bool = False, extra: Collection[str] = ()) -> DataFrame:
    """Typed select of the used columns and of ``extra``; text right-trimmed, unless it is stored that way (``trimmed``).

    The source system compares text ignoring trailing blanks (fixed-width
    columns are stored blank-padded), so every text column is trimmed once
    here and operators compare plain values. Date and number columns are
    untouched, so the run windows still reach the parquet scans; selective text
    predicates reach them through :meth:`Sources.having`.
    """
    cols = []
    for col, typ in SOURCE_COLUMNS[name]:
        physical = PHYSICAL_NAMES.get((name, col))
        c = F.col(physical if physical in df.columns else col).cast(typ)
        if isinstance(typ, StringType) and not trimmed:
            c = F.rtrim(c)
        cols.append(c.alias(col))
    return df.select(*cols, *extra)


class Sources:
    """Lazily built, memoised source DataFrames."""

    def __init__(self, spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]], trimmed: Collection[str] = (),
                 store: Callable[[], Sources] | None = None, extra: Mapping[str, Collection[str]] | None = None):
        self.spark = spark
        self._store = store
        self._extra = dict(extra or {})     # further columns of some tables, by table
        self.trimmed = frozenset(trimmed)   # tables stored normalised, whose key columns are read as they are
        self._builders = dict(builders)
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._builders:
                raise KeyError(f"unknown source table {name!r}")
            self._cache[name] = self._normalised(name, self._builders[name]())
        return self._cache[name]

    def _normalised(self, name: str, df: DataFrame) -> DataFrame:
        return normalise(name, df, name in self.trimmed, self._extra.get(name, ()))

    def raw(self, name: str) -> DataFrame:
        """The table as it is stored."""
        return self._builders[name]()

    def having(self, name: str, column: str, *prefixes: str) -> DataFrame:
        """The table, cut at the scan to rows whose *stored* text in ``column`` starts with one of ``prefixes``.

        A superset of the rows that equal (or start with) a prefix after trimming, stated on the stored
        column so that it reaches the parquet scan, which a predicate on ``rtrim`` does not.
        """
        raw = self._builders[name]()
        physical = PHYSICAL_NAMES.get((name, column))
        stored = F.col(physical if physical in raw.columns else column)
        any_prefix = stored.startswith(prefixes[0])
        for p in prefixes[1:]:
            any_prefix = any_prefix | stored.startswith(p)
        return self._normalised(name, raw.where(any_prefix))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self.table(name)
        except KeyError as exc:
            raise AttributeError(name) from exc

    def stored(self, *again: str) -> Sources:
        """These tables for a run that reads most of them: what several are derived from is computed once and kept in files.

        So are the tables named in ``again``, which the run reads several times. Real tables are files already; only the star
        mapping derives them.
        """
        if self._store is None:
            return self
        once = self.memo("stored", self._store)
        return self.memo(f"stored {sorted(again)}", lambda: once._written(again)) if again else once

    def _written(self, names: Collection[str]) -> Sources:
        def read(name: str) -> DataFrame:
            path = os.path.join(checkpoint_dir(self.spark), f"{name}-{uuid.uuid4().hex}")
            with shuffles_released(self.spark):
                self.table(name).select("*").write.option("compression", "zstd").parquet(path)
            return self.spark.read.parquet(path)

        kept: dict[str, DataFrame] = {}
        builders = {n: (lambda n=n: kept[n] if n in kept else kept.setdefault(n, read(n))) for n in names}
        return Sources(self.spark, {**self._builders, **builders}, self.trimmed | set(names), extra=self._extra)

    def names(self) -> list[str]:
        return sorted(self._builders)

    def has(self, name: str) -> bool:
        return name in self._builders

    def memo(self, key: str, build: Callable[[], object]):
        """Memoise a derived object (a run, a written table) per source set."""
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]


# Source sets per (session, directory): the test tables are immutable, so their file listing and
# schema, and what is memoised on them, are made once per session, like registering views.
_STAR_SOURCES: dict[tuple[int, str], Sources] = {}


def from_star(spark: SparkSession, root: str) -> Sources:
    key = (id(spark), root.rstrip("/"))
    src = _STAR_SOURCES.get(key)
    if src is None or src.spark is not spark:
        def build(store_lines: bool, store: Callable[[], Sources] | None = None) -> Sources:
            tables = star.StarTables(spark, root, store_lines)
            return Sources(spark, {name: (lambda fn=fn: fn(tables)) for name, fn in star.BUILDERS.items()}, store=store)

        src = build(False, lambda: build(True))
        _STAR_SOURCES[key] = src
    return src


def from_tables(spark: SparkSession, locations: Mapping[str, str]) -> Sources:
    """Sources from real tables: ``{source name: parquet path or table name}``."""

    def reader(loc: str) -> Callable[[], DataFrame]:
        if "/" in loc or loc.endswith(".parquet"):
            return lambda: spark.read.parquet(loc)
        return lambda: spark.table(loc)

    return Sources(spark, {name: reader(loc) for name, loc in locations.items()})


def from_frames(spark: SparkSession, frames: Mapping[str, DataFrame], extra: Mapping[str, Collection[str]] | None = None) -> Sources:
    """Sources from DataFrames, with further columns ``extra`` of some tables."""
    return Sources(spark, {name: (lambda df=df: df) for name, df in frames.items()}, extra=extra)
