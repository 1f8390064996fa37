"""Dimensions: product categories, product lookups, stores.

No dimension is counted, cached or hinted: a join side is broadcast only
where the planner's byte statistics or AQE's measured bytes allow it, and the
plan is the same at every size.

The categorised product dimension is the one lookup that grows with the
business (the catalogue). :func:`join_products` shuffles lines to their item
once. They are not summed per item before: months x stores x items is about
as many rows as there are lines, so that would be a second shuffle of the same
size. A hot item's partition is split by AQE, whose skew handling takes a join of
two plain shuffles like this one; the callers sum per category after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcost import fixed
from shelfcost.functions.classify import category
from shelfcost.sources.catalog import Sources


def join_products(lines: DataFrame, keys: list[str], sums: list[str], products: DataFrame) -> DataFrame:
    """Attach product columns to lines measured by the additive columns ``sums``.

    ``lines`` carries ``keys``, ``ItemCode`` and ``sums``; the result carries
    the same plus the product columns, one row per line and product row.
    """
    return lines.select(*keys, "ItemCode", *sums).join(products, "ItemCode")


def category_dim(src: Sources) -> DataFrame:
    """Category of every product type (ordered CASE, first match wins)."""
    types = src.product_types
    return types.select(
        F.col("ProductType"),
        category(F.col("ProductType"), F.col("PTypeClass")).alias("PTypeCategory"),
        F.col("PTypeClass"),
    )


def categories(src: Sources) -> DataFrame:
    """The persisted category table when the source set names one (the monthly
    flow: load categories, then roll up), else derived from the product types."""
    return src.category_dim if src.has("category_dim") else category_dim(src)


def products_categorised(src: Sources, new_goods_only: bool) -> DataFrame:
    """Product master with category: (ItemCode, PrCat, Cost).

    ``new_goods_only`` applies the register/Bookworm/transfer filter: class
    NEW and not a gift card. Online branches take every category.
    """
    cat = categories(src).select("ProductType", F.col("PTypeCategory").alias("PrCat"), "PTypeClass")
    products = src.product_master.join(cat, "ProductType")
    if new_goods_only:
        products = products.where((F.col("PTypeClass") == fixed.NEW_CLASS) & (F.col("PrCat") != fixed.CAT_GC))
    return products.select("ItemCode", "PrCat", "Cost")
