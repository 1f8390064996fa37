"""Product category expressions.

Current rule set: an ordered CASE over product type and class (first match
wins). The v1 rule set classified by the type code's suffix instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcost import fixed


def category(product_type: Column, type_class: Column) -> Column:
    """Category of a product type: frln, gc, scan, spcl/used, dist or zzz."""
    return (
        F.when(product_type.isin(list(fixed.FRONTLINE_TYPES)), F.lit(fixed.CAT_FRLN))
        .when(product_type.isin(list(fixed.GIFT_CARD_TYPES)), F.lit(fixed.CAT_GC))
        .when(product_type.isin(list(fixed.SCAN_TYPES)), F.lower(product_type))
        .when(type_class.isin(list(fixed.LOWERED_CLASSES)), F.lower(type_class))
        .when(type_class == F.lit(fixed.NEW_CLASS), F.lit(fixed.CAT_DIST))
        .otherwise(F.lit(fixed.CAT_OTHER))
    )


def v1_sales_category(product_type: Column) -> Column:
    """v1 sales: SCAN -> scan; a type not ending in F -> dist; else frln."""
    return (
        F.when(product_type == F.lit("SCAN"), F.lit(fixed.CAT_SCAN))
        .when(~F.rtrim(product_type).endswith("F"), F.lit(fixed.CAT_DIST))
        .otherwise(F.lit(fixed.CAT_FRLN))
    )


def v1_transfer_category(product_type: Column) -> Column:
    """v1 transfers: a type not ending in F -> dist, else frln (no scan arm)."""
    return F.when(~F.rtrim(product_type).endswith("F"), F.lit(fixed.CAT_DIST)).otherwise(F.lit(fixed.CAT_FRLN))
