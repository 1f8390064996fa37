"""Column expressions shared by the branches.

All built-in functions, so every expression stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfcost import fixed

MONEY = DecimalType(19, 4)


def money(col: Column | int | float) -> Column:
    """Cast to the persisted amount type, decimal(19,4)."""
    if not isinstance(col, Column):
        col = F.lit(col)
    return col.cast(MONEY)


def qty(col: Column | int) -> Column:
    """Cast to the persisted quantity type, bigint."""
    if not isinstance(col, Column):
        col = F.lit(col)
    return col.cast("bigint")


def return_sign(is_return: Column) -> Column:
    """-1 for return lines (``IsReturn = 'Y'``), else 1."""
    return F.when(is_return == F.lit("Y"), F.lit(-1)).otherwise(F.lit(1))


def signed_quantity(quantity: Column, is_return: Column) -> Column:
    return quantity * return_sign(is_return)


def location_fallback(fulfil_location: Column, facility_location: Column) -> Column:
    """Fulfilment location when present, else the facility's store."""
    return F.coalesce(fulfil_location, facility_location)


def event_time(update_time: Column, create_time: Column) -> Column:
    """Transfer line time: last update, else creation."""
    return F.coalesce(update_time, create_time)


def right_pad_keep(text: Column, fill: str, width: int) -> Column:
    """Left-fill ``text`` with ``fill`` and keep the rightmost ``width`` chars.

    Equivalent of ``right(replicate(fill, width) + text, width)``: unlike
    ``lpad``, an over-long value keeps its *rightmost* characters. NULL in,
    NULL out.
    """
    return F.substring(F.concat(F.lit(fill * width), text), -width, width)


def bookworm_xaction_id(tillnumber: Column, transaction_number: Column) -> Column:
    """Register transaction id of a Bookworm order: till + 9-digit number."""
    return F.concat(tillnumber, right_pad_keep(transaction_number, "0", fixed.XACTION_NUMBER_WIDTH))


def item_code_from_sku(sku: Column) -> Column:
    """Zero-padded 20-character item code of an unpadded SKU."""
    return right_pad_keep(sku, "0", fixed.ITEM_CODE_WIDTH)


def rightmost(text: Column, n: int) -> Column:
    """``right(text, n)``."""
    return F.substring(text, -n, n)


def ci_equals(col: Column, value: str) -> Column:
    """Case-insensitive equality (text comparisons of the source system ignore case)."""
    return F.lower(col) == F.lit(value.lower())


def ci_isin(col: Column, values) -> Column:
    return F.lower(col).isin([v.lower() for v in values])
