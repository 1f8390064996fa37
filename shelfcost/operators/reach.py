"""Rows that may meet a join's other side, kept before they are shuffled to it.

A join on equal keys shuffles both sides whole, also where few rows of the large one meet any of the small one. Here the small
side's keys are hashed to bits of a bitmap of fixed size (``BITS``, in words of 64), which is broadcast; rows of the large side without their bit meet
nothing and stay behind. Rows that share a bit by chance go on, so the join itself still decides: the result is the same, only the
shuffle is smaller. The more keys, the less is kept back, and the bitmap never grows beyond ``BITS / 64`` words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def _place(columns: list[str]) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit(BITS - 1))


def _word(columns: list[str]) -> Column:
    return F.shiftright(_place(columns), 6).cast("int")


def _bit(columns: list[str]) -> Column:
    return _place(columns).bitwiseAND(F.lit(63)).cast("int")


def marks(keys: DataFrame, *extra: Column) -> DataFrame:
    """(__word, __bits, *extra): the bitmap of the rows of ``keys``, of all its columns, with further aggregates per word."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(keys.columns))
    return keys.groupBy(_word(keys.columns).alias("__word")).agg(F.bit_or(bit).alias("__bits"), *extra)


def among(rows: DataFrame, columns: list[str], marked: DataFrame) -> DataFrame:
    """The ``rows`` whose ``columns`` (of the marked keys' types, in their order) have their bit in ``marked``."""
    bitmap = F.broadcast(marked.select("__word", "__bits"))
    held = F.call_function("getbit", F.col("__bits"), _bit(columns)) == 1
    return rows.join(bitmap, (_word(columns) == F.col("__word")) & held, "left_semi")
