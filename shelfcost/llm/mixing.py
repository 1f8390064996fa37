"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: its weight's share of the whole mix, never above
``max_repeat`` times its own size; what a capped source cannot take is shared by weight among the
others until none is above its cap. Every document of a source is expected
``target / source size`` times. The documents of a source stand in a fixed order (by size, then by a
hash of the id, then by one of the whole row, so that reruns agree also where rows share an id), the expected copies are summed along it, one offset in [0, 1) is added, and a
document is emitted once for each whole number its interval crosses. As equal sizes stand
together, the words taken come near the target, and no document is taken more often than its
expectation rounded up.

Only DataFrame functions are used. No window spans a whole source's rows: a document's place is the
sum of three prefixes, of the sizes within the source, of the hash prefixes within the size, and of
its rows within (source, size, hash prefix).

Defined cases: a null text has size 0; a null source is a source of its own, sorted last; a
source without words has target 0 and its documents are not taken; an empty table gives
an empty result; repeated rows are documents of their own; carried columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcost.llm.text import words

WEIGHTS = (3, 1, 2)


def unit(value: Column) -> Column:
    """A number in [0, 1) from the first 8 hex digits of the MD5 of ``value``."""
    return F.conv(F.substring(F.md5(value.cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def targets(sizes: DataFrame, share: float, max_repeat: int, weights: tuple[int, ...]) -> DataFrame:
    """(key, source_size) -> with ``target``; one row per source, so a small table.

    With t the words per unit of weight, a source takes min(cap, t * weight). Sources are capped in
    ascending order of cap / weight; ``t`` follows from the number of capped sources, which is the first
    place in that order where the remaining words fit.
    """
    last = F.col("key") == ""  # the null source
    by_name = Window.orderBy(last, "key")
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.select("key", "source_size", w.cast("long").alias("w"), (F.lit(max_repeat) * F.col("source_size")).alias("cap"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), last, "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("rest_w"),
    )
    t = t.withColumn("level", (F.lit(share) * F.col("total") - F.col("caps")) / F.col("rest_w"))
    # the first uncapped place: all before it are capped, and from it on the level stays below cap / weight
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("k"), last.alias("n"), "key", "level"))
    t = t.withColumn("t", F.min(fits).over(every)["level"])
    target = F.when(F.col("t").isNull(), F.col("cap")).otherwise(F.least(F.col("cap").cast("double"), F.col("t") * F.col("w")))
    return t.select("key", "source_size", target.cast("double").alias("target"))


def sampled(docs: DataFrame, share: float = 1.5, max_repeat: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``docs`` with ``__mix_size``, ``__mix_source_size``, ``__mix_target`` and ``__mix_copies``."""
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null has a key of its own
    content = F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"))  # rows equal in all of it are interchangeable
    d = docs.withColumns({"__mix_size": F.size(words(F.col("text"))).cast("long"), "__mix_hash": hashed, "__mix_key": key, "__mix_row": content})
    d = d.withColumn("__mix_part", F.substring("__mix_hash", 1, 2))

    keys = d.select(F.col("__mix_key").alias("key"), F.col("__mix_size").alias("size"), F.col("__mix_part").alias("part"))
    cells = keys.groupBy("key", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy("key", "size").agg(F.sum("n").alias("n"))
    by_size = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("key", "size", F.coalesce(F.sum("n").over(by_size), F.lit(0)).alias("size_start"), (F.col("n") * F.col("size")).alias("words"))
    goal = targets(sizes.groupBy("key").agg(F.sum("words").alias("source_size")), share, max_repeat, weights)
    by_part = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = cells.select("key", "size", "part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("part_start"))
    places = places.join(sizes.select("key", "size", "size_start"), ["key", "size"]).join(goal, "key")
    p = places.select(
        F.col("key").alias("__mix_key"), F.col("size").alias("__mix_size"), F.col("part").alias("__mix_part"),
        (F.col("part_start") + F.col("size_start")).alias("__mix_start"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target"),
    )
    d = d.join(p, ["__mix_key", "__mix_size", "__mix_part"])
    rows = Window.partitionBy("__mix_key", "__mix_size", "__mix_part").orderBy("__mix_hash", F.col("doc_id").asc_nulls_first(), "__mix_row")
    place = F.row_number().over(rows) + F.col("__mix_start")
    rate = F.when(F.col("__mix_source_size") > 0, F.col("__mix_target") / F.col("__mix_source_size")).otherwise(F.lit(0.0))
    offset = unit(F.coalesce(F.col("source"), F.lit("")))
    copies = F.floor(offset + place * rate) - F.floor(offset + (place - 1) * rate)
    return d.withColumn("__mix_copies", copies.cast("long")).drop("__mix_key", "__mix_hash", "__mix_part", "__mix_start", "__mix_row")


def mix(docs: DataFrame, share: float = 1.5, max_repeat: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    s = sampled(docs, share, max_repeat, weights).where(F.col("__mix_copies") > 0)
    return s.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col("__mix_copies").cast("int"))).alias("__mix_copy")).drop("__mix_copy")


def report(docs: DataFrame, share: float = 1.5, max_repeat: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, words taken."""
    s = sampled(docs.select("doc_id", "source", "text"), share, max_repeat, weights)
    return s.select(
        "doc_id", F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"), (F.col("__mix_size") * F.col("__mix_copies")).alias("taken"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(doc_id::VARCHAR) AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s
), lambda_try AS (
  SELECT a.source, (1.5::DOUBLE * (SELECT sum(source_size) FROM w)::DOUBLE - coalesce(sum(2 * b.source_size) FILTER (2 * b.source_size / b.w < 2 * a.source_size / a.w OR (2 * b.source_size / b.w = 2 * a.source_size / a.w AND b.source < a.source)), 0)::DOUBLE)
    / (sum(b.w) FILTER (NOT (2 * b.source_size / b.w < 2 * a.source_size / a.w OR (2 * b.source_size / b.w = 2 * a.source_size / a.w AND b.source < a.source))))::DOUBLE AS level
  FROM w a CROSS JOIN w b GROUP BY a.source
), fit AS (
  SELECT arg_min(level, 2 * source_size / w) AS t FROM lambda_try JOIN w USING (source) WHERE level * w <= 2 * source_size
), goal AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, t * w) AS target FROM w CROSS JOIN fit
), r AS (
  SELECT d.*, source_size, target, row_number() OVER (PARTITION BY d.source ORDER BY size, h) AS k,
    target / source_size AS rate, ('0x' || substr(md5(d.source), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN goal ON d.source = goal.source
)
SELECT doc_id, size, source_size, target, size * (floor(u + k * rate) - floor(u + (k - 1) * rate))::BIGINT AS taken FROM r
"""
