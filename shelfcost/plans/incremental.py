"""Signed-delta maintenance: late or corrected source lines without reading the history again.

Every branch is a sum over joined lines, and a joined line lies within one *document*: a register transaction (with its special
orders), an online order (with its fulfilment), a transfer bin. So if a document changed, the difference it makes is the tidy rows of
its new lines less those of its old ones, and nothing outside the documents that changed matters:

    delta = tidy(after images) - tidy(before images)        signed rows per (source, month, store, type, category)

The kept state is the tidy table with the number of lines behind each row (a row without lines is gone, so keys that only lost lines
held also leave the grid). :func:`apply_changes` adds the delta to the months it touches, builds rollup and rejects
from the state, which is months x stores x types x categories rows at any input size, and commits all three as one
version. The facts that are read are the images of the changed documents.

Images come from the source system's change feed (:class:`Changes`), or from two snapshots of its tables
(:func:`between`): the documents whose rows differ are found by a hash per document, and all their rows are taken
from both sides, so that a changed fulfilment header moves every line that joins it. Documents are compared in ``BUCKETS`` buckets first
and one by one only in buckets that differ, and rows are taken by the bitmap of the changed documents (:mod:`shelfcost.operators.reach`), which needs no
shuffle. A document that only shares a bit with a changed one is taken whole from both sides, so it takes from a key what it adds. Changes of the dimensions (products,
categories, stores, facilities) revalue history and need a full run (:func:`start`).

Both images of a document are joined in one run, each row to those of its own side, and joined lines that are the same on both cancel before
they are shuffled to their products. The steps' results are small and checkpointed one after the other, and a step's shuffle files go as
it ends, so the disk holds one step at a time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost.functions.columns import MONEY, bookworm_xaction_id
from shelfcost.functions.dates import Window
from shelfcost.operators import reach, sales, transfers, versions, writer
from shelfcost.operators.sales import LINES, SIDE
from shelfcost.plans import monthly
from shelfcost.plans.monthly import RejectedRows, RollupRun, rollup_of, tidy_rows
from shelfcost.session import shuffles_released
from shelfcost.sources.catalog import Sources, from_frames, normalise
from shelfcost.sources.schemas import STATE

FACTS = ("sales_header", "sales_item", "bookworm", "istore_orders", "web_orders", "fulfil_header", "fulfil_detail", "xfer_header", "xfer_detail")
KEYS = ("Source", "RunMonth", "BusinessMonth", "LocationNo", "Ty", "PrCat")
SUMS = ("Qty", "Cost", "Val", "Fee", LINES)
STATE_TABLE, MONTH = "tidy", "BusinessMonth"
#: Buckets of documents that two snapshots are compared in first.
BUCKETS = 1 << 14


@dataclass(frozen=True)
class Changes:
    """All rows of the changed documents before and after the change, by fact table (only tables with rows need be there).

    Unchanged documents may be among them if they are whole on both sides.
    """

    before: Mapping[str, DataFrame]
    after: Mapping[str, DataFrame]


def materialise(df: DataFrame) -> DataFrame:
    """A checkpoint whose shuffle files go as soon as it is written."""
    with shuffles_released(df.sparkSession):
        return monthly.materialise(df.select("*"))


# --- documents that differ between two snapshots ----------------------------------------

def _hashed(df: DataFrame, key: dict) -> DataFrame:
    """(key, number of rows, sums of the row hashes' halves) per document: what a document is, in any row order."""
    row = F.xxhash64(*df.columns)
    halves = [row.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(row, 32)]
    keyed = df.select(*[c.alias(k) for k, c in key.items()], *[h.alias(f"h{i}") for i, h in enumerate(halves)])
    return keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))


def _differing(old: DataFrame, new: DataFrame, key: dict) -> DataFrame:
    """The documents whose rows are not the same in both; only those in buckets that differ are shuffled to be compared."""
    bucket = F.xxhash64(*key.values()).bitwiseAND(F.lit(BUCKETS - 1))
    changed = materialise(_unequal(old, new, {"__bucket": bucket}))
    if changed.isEmpty():
        return old.select(*[c.alias(k) for k, c in key.items()]).limit(0)
    return _unequal(*[df.join(F.broadcast(changed), bucket == F.col("__bucket"), "left_semi") for df in (old, new)], key)


def _unequal(old: DataFrame, new: DataFrame, key: dict) -> DataFrame:
    """The keys whose rows are not the same in both; a NULL key joins nothing, so no branch reads it."""
    a, b = _hashed(old, key), _hashed(new, key).select(*key, *[F.col(c).alias(f"{c}_new") for c in ("n", "h0", "h1")])
    same = (F.col("n") == F.col("n_new")) & (F.col("h0") == F.col("h0_new")) & (F.col("h1") == F.col("h1_new"))
    return a.join(b, list(key), "full").where(~F.coalesce(same, F.lit(False))).select(*key).dropna()


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _marked(keys: DataFrame) -> DataFrame:
    """The bitmap of changed documents."""
    return materialise(reach.marks(keys))


def _rows_of(rows: DataFrame, key: dict, marked: DataFrame) -> DataFrame:
    named = rows.withColumns({f"__{k}": c for k, c in key.items()})
    return reach.among(named, [f"__{k}" for k in key], marked).select(*rows.columns)


def between(old: Sources, new: Sources) -> Changes:
    """The images of the documents that differ between two snapshots of the fact tables."""
    def differing(table: str, **key) -> DataFrame:
        return _differing(old.table(table), new.table(table), key)

    def transaction(location: str, xaction: Column) -> dict[str, Column]:
        """A register transaction by one number, which is narrower to shuffle; transactions of one number are taken together."""
        return {"Txn": F.when(F.col(location).isNotNull() & xaction.isNotNull(), F.xxhash64(F.col(location), xaction))}

    register = {
        "sales_header": transaction("LocationID", F.col("SalesXactionID")),
        "sales_item": transaction("LocationID", F.col("SalesXactionId")),
        "bookworm": transaction("locationId", bookworm_xaction_id(F.col("tillnumber"), F.col("transactionNumber"))),
    }
    transactions = _marked(_union([differing(t, **key) for t, key in register.items()]))
    bins = _marked(_union([differing(t, Bin=F.col("TransferBinNo")) for t in ("xfer_header", "xfer_detail")]))

    # an order's lines change with its fulfilment: details name headers, headers name orders
    details = _marked(differing("fulfil_detail", Head=F.col("OrderID")))
    named = _union([_rows_of(s.fulfil_header, {"Head": F.col("OrderID")}, details).select(F.col("ISISOrderID").alias("Isis")) for s in (old, new)])
    orders = _marked(_union([
        differing("istore_orders", Isis=F.col("ISIS_OrderID")), differing("web_orders", Isis=F.col("ISIS_OrderID")),
        differing("fulfil_header", Isis=F.col("ISISOrderID")), named.dropna(),
    ]))

    def images(src: Sources) -> dict[str, DataFrame]:
        def of(table: str, key: dict, marked: DataFrame) -> DataFrame:
            return _rows_of(src.table(table), key, marked)

        out = {t: of(t, key, transactions) for t, key in register.items()}
        out |= {t: of(t, {"Isis": F.col("ISIS_OrderID")}, orders) for t in ("istore_orders", "web_orders")}
        out["fulfil_header"] = of("fulfil_header", {"Isis": F.col("ISISOrderID")}, orders)
        heads = _marked(out["fulfil_header"].select(F.col("OrderID").alias("Head")))
        out["fulfil_detail"] = of("fulfil_detail", {"Head": F.col("OrderID")}, heads)
        out |= {t: of(t, {"Bin": F.col("TransferBinNo")}, bins) for t in ("xfer_header", "xfer_detail")}
        return out

    return Changes(images(old), images(new))


# --- deltas and the kept state ------------------------------------------------------------

def counted_tidy(src: Sources, window: Window, out_window_on: str = "header", signed: bool = False) -> DataFrame:
    """The tidy rows of a run with the number of joined lines behind each; one pass over the facts is computed after the other."""
    with shuffles_released(src.spark):   # also of the bitmaps that a short run makes while it is planned
        sold = _union([materialise(p) for p in sales.sales_passes(src, window, lines=True, signed=signed)])
        moved = materialise(transfers.transfers(src, window, out_window_on=out_window_on, run_month=True, lines=True, signed=signed))
    return tidy_rows(sold, moved, LINES)


def _both_sides(src: Sources, changes: Changes) -> Sources:
    """``src`` with only the rows of ``changes`` in the fact tables, marked by their side."""
    def marked(name: str) -> DataFrame:
        sides = [normalise(name, facts[name]).withColumn(SIDE, F.lit(side).cast("bigint"))
                 for facts, side in ((changes.after, 1), (changes.before, -1)) if name in facts]
        return _union(sides or [src.table(name).limit(0).withColumn(SIDE, F.lit(1).cast("bigint"))])

    frames = {n: src.table(n) for n in src.names() if n not in FACTS}
    return from_frames(src.spark, {**frames, **{n: marked(n) for n in FACTS}}, dict.fromkeys(FACTS, (SIDE,)))


def _summed(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(MONEY if c in ("Cost", "Val", "Fee") else "bigint").alias(c) for c in SUMS]
    return rows.groupBy(*KEYS).agg(*sums).select(*STATE.fieldNames())


def delta(src: Sources, changes: Changes, window: Window, out_window_on: str = "header") -> DataFrame:
    """Signed tidy rows: what ``changes`` add to and take from each key. Dimensions are those of ``src``."""
    rows = _summed(counted_tidy(_both_sides(src, changes), window, out_window_on, signed=True))
    changed = reduce(lambda x, y: x | y, [F.coalesce(F.col(c), F.lit(0)) != 0 for c in SUMS])
    return rows.where(changed)


def merged(state: DataFrame, signed: DataFrame) -> DataFrame:
    """The state after a delta: sums per key, without the keys that have no line left."""
    return _summed(state.unionByName(signed.select(*state.columns))).where(F.col(LINES) > 0)


def read_state(src: Sources, path: str, version: versions.Version | None = None) -> DataFrame:
    return versions.read(src.spark, path, STATE_TABLE, STATE, MONTH, version)


def _write(src: Sources, path: str, state: DataFrame, base: versions.Version, months: dict[str, None], window: Window,
           allow_rejects: bool) -> RollupRun:
    """Write the state's rows of ``months`` (every month of ``state`` that the caller replaces), then the rollup of the whole state."""
    rows = state.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    runs = months | versions.stage(rows, path, STATE_TABLE, MONTH)
    held = dict(base.tables.get(STATE_TABLE, {}))
    after = {m: run for m, run in (held | runs).items() if run is not None}
    tidy = materialise(read_state(src, path, versions.Version(base.number, {STATE_TABLE: after})).drop(LINES))
    run = rollup_of(tidy, window)
    if not allow_rejects and not run.rejects.isEmpty():
        writer.refuse(src.spark, path, run.rejects)
        raise RejectedRows(f"rows with a NULL month or store, see writer.read_refused(spark, {path!r})")
    writer.replace_by_key(src.spark, path, run.rollup, run.grid, run.rejects, window, base, {STATE_TABLE: runs})
    return run


def start(src: Sources, path: str, window: Window, out_window_on: str = "header", allow_rejects: bool = False) -> RollupRun:
    """A full run that also keeps the state: one version with state, rollup and rejects."""
    base = versions.load(src.spark, path)
    state = materialise(_summed(counted_tidy(src, window, out_window_on)))
    return _write(src, path, state, base, dict.fromkeys(base.tables.get(STATE_TABLE, {})), window, allow_rejects)


def apply_changes(src: Sources, path: str, changes: Changes, window: Window, out_window_on: str = "header",
                  allow_rejects: bool = False) -> RollupRun:
    """Merge ``changes`` into the state at ``path`` and commit state, rollup and rejects as one version.

    ``window`` is that of the state; only the state's months with changes are read and rewritten.
    """
    base = versions.load(src.spark, path)
    if STATE_TABLE not in base.tables:
        raise ValueError(f"no state at {path}: run incremental.start first")
    signed = materialise(delta(src, changes, window, out_window_on))
    touched = {versions.NULL_VALUE if r[0] is None else str(r[0]) for r in signed.select(MONTH).distinct().collect()}  # months
    held = {m: run for m, run in base.tables[STATE_TABLE].items() if m in touched}
    state = merged(read_state(src, path, versions.Version(base.number, {STATE_TABLE: held})), signed)
    return _write(src, path, state, base, dict.fromkeys(held), window, allow_rejects)
