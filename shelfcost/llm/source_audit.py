"""Source divergence audit: how far the vocabulary of each source is from the others of its language, and by which terms.

1. One pass counts, per language, the documents of every term; terms in at least ``MIN_DOCS`` are kept.
2. The kept terms are sorted over tasks. Each task builds minimal acyclic transducers of ``SHARD`` terms from its range and
   writes them to the shared folder (:mod:`~shelfcost.llm.transducer`); a term's ordinal is its place in the language's sorted vocabulary. The driver
   sees one row per shard (a thousandth of a percent of the terms).
3. A second pass streams the texts through the transducers and counts ordinals by source, so that terms are not shuffled again and terms
   that are not kept do not leave the task. A task looks up its terms in sorted order, so a vocabulary of any size passes through it
   shard by shard.
4. Counts meet by blocks of ``BLOCK`` ordinals, with the totals of all sources of the language; a block gives its share of every
   pair's divergence and its ``top`` terms by source. Blocks have at most ``BLOCK`` counts a source, so a hot source or language is
   many blocks. Ranks break ties by ordinals, and only the ranked ordinals are spelled again.

Probabilities are integers out of 10**9; every sum and product is exact (the long division by the total is done in three steps, which holds
for totals up to 9 * 10**14 terms).

Defined cases: null text, lang and source are empty strings; a language without kept terms has value 0 for its pairs and no term rows; a
language's only source has no pairs; repeated rows count each time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcost.llm import transducer
from shelfcost.llm.store import new_path, save

MIN_DOCS = 3
TOP = 200
SHARD = 1 << 16
BLOCK = 1024
SCALE = 1_000_000_000
HELD = 300_000  # different terms that a task counts before it passes them on
DENSE = 1 << 18  # cells of the matrices that a task works on
MATRIX = 1024  # sources up to which a task adds up its blocks before it passes them on
#: Bytes outside terms become spaces, A-Z become a-z. Bytes over 127 stand in characters over 127 only, so terms can be cut as bytes.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_LETTERS).split()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of the language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Counter] = {}

        def frames() -> Iterator[pd.DataFrame]:
            for lang, c in found.items():
                yield pd.DataFrame({"lang": lang, "term": list(c), "docs": np.fromiter(c.values(), np.int64, len(c))})
            found.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                c = found.setdefault(lang, Counter())
                c.update(set(terms(text)))
                if len(c) > HELD:
                    yield from frames()
        yield from frames()

    counts = texts.select("lang", "text").mapInPandas(count, "lang string, term binary, docs long")
    return counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


def build_vocabulary(kept: DataFrame, folder: str, shard: int = SHARD) -> transducer.Vocabulary:
    """Transducers of the kept terms, written to ``folder``."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang, held = "", []

        def row() -> pd.DataFrame:
            name = transducer.write(folder, transducer.Transducer.build(held))
            return pd.DataFrame({"lang": [lang], "first": [held[0]], "n": [len(held)], "file": [name]})

        for batch in batches:
            for of, term in zip(batch["lang"], batch["term"]):
                if held and (of != lang or len(held) == shard):
                    yield row()
                    held = []
                lang = of
                held.append(bytes(term))
        if held:
            yield row()

    ranges = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    shards = ranges.mapInPandas(build, "lang string, first binary, n long, file string")
    return transducer.Vocabulary(folder, [tuple(r) for r in shards.collect()])  # one row per shard of SHARD terms


def recount(texts: DataFrame, vocabulary: transducer.Vocabulary) -> DataFrame:
    """(lang, source, ordinal, n): the occurrences of the kept terms."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, dict[str, Counter]] = {}

        def frames() -> Iterator[pd.DataFrame]:
            for lang, sources in found.items():
                different = sorted(set().union(*sources.values()))
                ordinals = vocabulary.ordinals(lang, different)
                place = {t: o for t, o in zip(different, ordinals.tolist()) if o >= 0}
                for source, c in sources.items():
                    pairs = [(place[t], n) for t, n in c.items() if t in place]
                    if pairs:
                        yield pd.DataFrame({"lang": lang, "source": source, "ordinal": [o for o, _ in pairs], "n": [n for _, n in pairs]})
            found.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
                c = found.setdefault(lang, {}).setdefault(source, Counter())
                before = len(c)
                c.update(terms(text))
                size += len(c) - before
                if size > HELD:
                    yield from frames()
                    size = 0
        yield from frames()

    counts = texts.mapInPandas(count, "lang string, source string, ordinal long, n long")
    return counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total), exactly, for 0 < count + 1 <= total."""
    out, rest = np.zeros_like(count), count + 1
    for step in (10_000, 10_000, 10):
        rest = rest * step
        out = out * step + rest // total
        rest = rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _blocks(top: int):
    """Rows (lang, block, ordinal, source, n, v) sorted by lang, block and ordinal; at ordinal -1 stand all sources of the language with their totals.

    Out come rows of two kinds: with ``other``, a share of a pair's divergence; without, one of a source's top terms.
    """
    columns = ["lang", "source", "other", "ordinal", "value"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang: str | None = None
        pairs: np.ndarray | None = None  # of the current language, by source
        best: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        names: np.ndarray = np.array([], object)

        def pair_rows(a: int, values: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"lang": lang, "source": names[a], "other": names, "ordinal": np.int64(-1), "value": values})

        def rows() -> Iterator[pd.DataFrame]:
            if pairs is not None:
                for a in range(len(names)):
                    yield pair_rows(a, pairs[a])
            for source, (value, ordinal) in best.items():
                yield pd.DataFrame({"lang": lang, "source": source, "other": None, "ordinal": ordinal, "value": value})

        def block(df: pd.DataFrame) -> Iterator[pd.DataFrame]:
            nonlocal pairs, names
            mark = df["ordinal"].to_numpy() < 0
            names = df["source"].to_numpy()[mark]
            v = int(df["v"].to_numpy()[mark][0])
            total = df["n"].to_numpy()[mark] + v
            df = df[~mark]
            term, ordinal_of = np.unique(df["ordinal"].to_numpy(), return_inverse=True)
            source_of = pd.Index(names).get_indexer(df["source"].to_numpy())
            n = df["n"].to_numpy()
            order = np.argsort(ordinal_of, kind="stable")
            width = max(1, DENSE // len(names))
            if pairs is None and len(names) <= MATRIX:
                pairs = np.zeros((len(names), len(names)), np.int64)
            for at in range(0, len(term), width):
                lo, hi = np.searchsorted(ordinal_of[order], (at, at + width))
                part = order[lo:hi]
                count = np.zeros((len(names), min(width, len(term) - at)), np.int64)
                count[source_of[part], ordinal_of[part] - at] = n[part]
                p = shares(count, total[:, None])
                q = shares(count.sum(axis=0), (total - v).sum() + v)
                for a in range(len(names)):
                    value = divergence(p[a], p).sum(axis=1)
                    if pairs is None:
                        yield pair_rows(a, value)
                    else:
                        pairs[a] += value
                    up = np.flatnonzero((count[a] > 0) & (p[a] > q))
                    if len(up):
                        value, ordinal = divergence(p[a][up], q[up]), term[at + up]
                        if names[a] in best:
                            value, ordinal = np.r_[best[names[a]][0], value], np.r_[best[names[a]][1], ordinal]
                        first = np.lexsort((ordinal, -value))[:top]
                        best[names[a]] = value[first], ordinal[first]

        def flush(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            nonlocal lang, pairs
            df = pd.concat(held)
            if df["lang"].iloc[0] != lang or len(best) * top > 4 * DENSE:
                yield from rows()
                best.clear()
                pairs, lang = None, df["lang"].iloc[0]
            yield from block(df)

        held: list[pd.DataFrame] = []
        key = None
        for batch in batches:
            if batch.empty:
                continue
            of, number = batch["lang"].to_numpy(), batch["block"].to_numpy()
            cut = np.flatnonzero((of[1:] != of[:-1]) | (number[1:] != number[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(batch)]):
                if held and (of[a], number[a]) != key:
                    yield from flush(held)
                    held = []
                key = of[a], number[a]
                held.append(batch.iloc[a:b])
        if held:
            yield from flush(held)
        yield from rows()

    return lambda batches: (df[columns] for df in run(batches))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """Per (lang, source): every other source of the language by divergence, and the ``top`` terms that the source has more of than the language."""
    spark = docs.sparkSession
    texts = _texts(docs)
    kept = save(kept_terms(texts, min_docs), "kept")
    vocabulary = build_vocabulary(kept, new_path(spark, "transducers"), shard)
    counts = save(recount(texts, vocabulary), "recount")

    group = ["lang", "source"]
    totals = counts.groupBy(*group).agg(F.sum("n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = texts.select(*group).distinct().join(totals, group, "left").join(sizes, "lang", "left")
    groups = save(groups.select(*group, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v"))), "groups")

    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("v") - 1) / BLOCK))).alias("block")
    marks = groups.where(F.col("v") > 0).select("lang", block, F.lit(-1).cast("long").alias("ordinal"), "source", "n", "v")
    rows = marks.unionByName(counts.select("lang", F.floor(F.col("ordinal") / BLOCK).alias("block"), "ordinal", "source", "n", F.lit(0).cast("long").alias("v")))
    rows = rows.repartition("lang", "block").sortWithinPartitions("lang", "block", "ordinal", "source")
    found = save(rows.mapInPandas(_blocks(top), "lang string, source string, other string, ordinal long, value long"), "blocks")

    summed = found.where(F.col("ordinal") < 0).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("other"))
    pairs = groups.select(*group).join(others, "lang").where(F.col("source") != F.col("other"))  # the result itself
    pairs = pairs.join(summed, [*group, "other"], "left").select(*group, F.col("other").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item")))

    terms_ = found.where(F.col("ordinal") >= 0).select(*group, "ordinal", "value")
    best = [F.desc("value"), F.col("ordinal")]
    salted = Window.partitionBy(*group, F.pmod("ordinal", F.lit(64))).orderBy(*best)
    terms_ = terms_.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = terms_.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*best))).where(F.col("rank") <= top)

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            items = [next(vocabulary.spell(lang, [o])).decode() for lang, o in zip(batch["lang"], batch["ordinal"])]
            yield batch.assign(item=pd.Series(items, index=batch.index, dtype=object)).drop(columns="ordinal")[["lang", "source", "item", "value", "rank"]]

    spelled = ranked.mapInPandas(spell, "lang string, source string, item string, value long, rank int")
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*out).unionByName(spelled.withColumn("part", F.lit("term")).select(*out))


report = audit


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), t AS (
  SELECT id, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT g.lang, g.source, coalesce(n.n, 0) AS n, v FROM (SELECT DISTINCT lang, source FROM d) g JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) n ON n.lang = g.lang AND n.source = g.source
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v))::HUGEINT AS p
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
  SELECT c.lang, term, (1 + 1000000000::HUGEINT * (sum(c.n) + 1) // (any_value(l.n) + any_value(l.v)))::HUGEINT AS q
  FROM c JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang) l ON l.lang = c.lang GROUP BY c.lang, term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT p.lang, source, p.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE n > 0 AND p > q
), r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms QUALIFY rank <= 200
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r
"""
