"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some stretch of it can be turned into the item by at most ``budget``
character edits (a share of the item's length). Items and documents are compared after lower-casing and after
every run of characters other than letters and digits has become one space.

An item with k allowed edits is split into k + 1 pieces. If a stretch is within k edits, at least one piece stands
in it unchanged, so an exact search for all pieces (one Aho-Corasick pass over the whole text) finds every
candidate place; around each, Myers' bit-parallel algorithm computes the distance. Chance hits of a piece are
dismissed early by the same argument on 2, 4, 8, ... neighbouring pieces: of m pieces with fewer than m edits
together, one half has fewer edits than pieces again, so a true place has a piece all of whose enclosing groups match.

The items are taken in blocks of at most ``BLOCK_CHARS`` characters, so what each executor holds has a fixed
bound; a benchmark beyond it is searched block by block, each against all documents, and only the hits are kept between blocks.

An item too short for a single edit (and shorter than ``MIN_CHARS``) must stand by itself: the character before and after it is
none, a space, or of a script that is written without spaces.

Defined cases: items that are null, or empty when normalised, hold nothing to search for; a null or empty text matches nothing; repeated items and rows are each
reported; an empty table on either side gives no match; other columns are carried.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost.llm.store import new_path, save, small

BUDGET = 0.1
MIN_CHARS = 32
BLOCK_CHARS = 1_000_000
_GAP = re.compile(r"[\W_]+")
# Thai to Burmese, Khmer, kana, Han, and the planes of rarer Han: words follow each other without a space
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normalised(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``item`` cut into k + 1 pieces of nearly equal length: (offset, piece)."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _masks(pattern: str) -> tuple[int, dict[str, int]]:
    """Length, and the places of each character as a bit mask."""
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    return len(pattern), at


def _distance(masks: tuple[int, dict[str, int]], text: str, enough: int) -> int:
    """The smallest edit distance between the pattern and any stretch of ``text``; the first one of at most ``enough`` ends the search."""
    m, at = masks
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        x = at.get(c, 0) | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        plus = down | (full ^ (d0 | up))
        minus = up & d0
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best = score
                if best <= enough:
                    return best
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | (full ^ (d0 | plus))
        down = plus & d0
    return best


def myers(pattern: str, text: str, k: int) -> int | None:
    """The smallest edit distance, if at most ``k``, between ``pattern`` and any stretch of ``text``."""
    best = _distance(_masks(pattern), text, 0)
    return best if best <= k else None


def _half_stands(piece: str, text: str, at: int, before: bool) -> bool:
    """A quick necessary test that ``piece`` stands at ``at`` with one edit at most, its other end (``before``: its right end) being fixed: one half is unchanged."""
    half = len(piece) // 2
    left, right, mid = piece[:half], piece[half:], at + half
    if before:
        return text.startswith(right, mid) and mid >= 0 or any(text.startswith(left, at + d) for d in (-1, 0, 1) if at + d >= 0)
    return text.startswith(left, at) or any(text.startswith(right, mid + d) for d in (-1, 0, 1))


def _ends_word(left: str, right: str) -> bool:
    """Whether a word may end between two neighbouring characters of a normalised text (either may be missing)."""
    return left in ("", " ") or right in ("", " ") or bool(_UNSPACED.match(left) or _UNSPACED.match(right))


def _stands_alone(text: str, a: int, b: int) -> bool:
    """Whether ``text[a:b]`` begins and ends at word boundaries."""
    return _ends_word(text[a - 1 : a], text[a]) and _ends_word(text[b - 1], text[b : b + 1])


class Matcher:
    """Searches texts for a block of items."""

    def __init__(self, items: list[tuple[int, str]], budget: float):
        import ahocorasick

        self.items: list[tuple[int, str, int, list[int]]] = []  # id, text, allowed edits, where the pieces start
        self.groups: dict[tuple[int, int, int], tuple[int, dict[str, int]]] = {}
        self.alone: set[int] = set()  # the places of the items that must stand by themselves
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            k = int(len(text) * budget)
            if not k and len(text) < MIN_CHARS:
                self.alone.add(len(self.items))
            cut = pieces(text, k)
            for number, (_, piece) in enumerate(cut):
                by_piece.setdefault(piece, []).append((len(self.items), number))
            self.items.append((item_id, text, k, [offset for offset, _ in cut] + [len(text)]))
        self.automaton = ahocorasick.Automaton()
        for piece, places in by_piece.items():
            self.automaton.add_word(piece, (len(piece), places))
        if by_piece:
            self.automaton.make_automaton()

    def _plausible(self, item: int, number: int, start: int, text: str) -> bool:
        """Whether the groups of 2, 4, ... pieces around the piece found at ``start`` match within their share of edits."""
        _, pattern, k, cuts = self.items[item]
        other = number ^ 1
        if other <= k and not _half_stands(pattern[cuts[other] : cuts[other + 1]], text, start - cuts[number] + cuts[other], other < number):
            return False
        width = 2
        while width <= k:
            a = number // width * width
            b = min(a + width, k + 1)
            if b - a > 1:
                masks = self.groups.get((item, a, b))
                if masks is None:
                    masks = self.groups[item, a, b] = _masks(pattern[cuts[a] : cuts[b]])
                edits = b - a - 1
                first = start - (cuts[number] - cuts[a])
                if _distance(masks, text[max(0, first - edits) : first + masks[0] + edits], edits) > edits:
                    return False
            width *= 2
        return True

    def search(self, text: str) -> list[tuple[int, int]]:
        """(item_id, distance) of each item found in a normalised text, with its smallest distance."""
        if not self.items or not text:
            return []
        spans: dict[int, list[list[int]]] = {}
        words: set[int] = set()  # the items found that must stand by themselves
        for end, (n, places) in self.automaton.iter(text):
            for item, number in places:
                if item in self.alone:
                    if item not in words and _stands_alone(text, end + 1 - n, end + 1):
                        words.add(item)
                    continue
                if not self._plausible(item, number, end + 1 - n, text):
                    continue
                _, pattern, k, cuts = self.items[item]
                start = end + 1 - n - cuts[number]
                a, b = max(0, start - k), start + len(pattern) + k
                found = spans.setdefault(item, [])
                if found and a <= found[-1][1]:  # windows come nearly in order; those that overlap are verified at once
                    found[-1][0], found[-1][1] = min(a, found[-1][0]), max(b, found[-1][1])
                else:
                    found.append([a, b])
        out = [(self.items[item][0], 0) for item in words]
        for item, found in spans.items():
            item_id, pattern, k, _ = self.items[item]
            if pattern in text:
                out.append((item_id, 0))
                continue
            best = [d for a, b in found if (d := myers(pattern, text[a:b], k)) is not None]
            if best:
                out.append((item_id, min(best)))
        return out


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The normalised items in blocks of bounded size; only one block is in the driver at a time."""
    block: list[tuple[int, str]] = []
    held = 0
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        text = normalised(text)
        if not text:
            continue
        if block and held + len(text) > BLOCK_CHARS:
            yield block
            block, held = [], 0
        block.append((item_id, text))
        held += len(text)
    if block:
        yield block


def _search(kind: str, block: list[tuple[int, str]], budget: float, docs: DataFrame) -> Column:
    held = docs.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_CHARS characters

    @F.pandas_udf(kind)
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(held.value, budget)
        for batch in texts:
            yield pd.Series([[{"item_id": i, "distance": d} for i, d in matcher.search(normalised(t))] for t in batch])

    return search(F.col("text"))


def _hits(block: list[tuple[int, str]], budget: float, docs: DataFrame, item: str) -> DataFrame:
    """(__dec_text, item_id, distance): what each text, named by its hash, holds of a block; texts without a hit give no row."""
    held = docs.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(held.value, budget)
        for batch in batches:
            rows = [(name, i, d) for name, t in zip(batch["__dec_text"], batch["text"]) for i, d in matcher.search(normalised(t))]
            yield pd.DataFrame(rows, columns=["__dec_text", "item_id", "distance"], dtype=object)

    texts = docs.where("text is not null").select(F.md5("text").alias("__dec_text"), "text")
    return texts.mapInPandas(search, f"__dec_text string, item_id {item}, distance int")


def matches(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``docs`` with ``__dec_hits``, the list of (item_id, distance) found in each text.

    One block is one narrow pass without a shuffle. Of several blocks each is a pass of its own that writes only its hits, by
    the text's hash, to the shared folder, so that no task holds two blocks; the documents then meet their hits in one join.
    """
    spark = docs.sparkSession
    item = benchmark.schema["item_id"].dataType.simpleString()
    kind = f"array<struct<item_id:{item},distance:int>>"
    todo = blocks(benchmark)
    first, second = next(todo, []), next(todo, None)
    if second is None:
        return docs.withColumn("__dec_hits", _search(kind, first, budget, docs))
    paths = []
    for block in itertools.chain((first, second), todo):
        hits = _hits(block, budget, docs, item)
        paths.append(new_path(spark, "hits"))
        hits.distinct().write.parquet(paths[-1])  # copies of a text have the same hits
    found = spark.read.schema(hits.schema).parquet(*paths).groupBy("__dec_text").agg(F.array_sort(F.collect_set(F.struct("item_id", "distance"))).alias("__dec_found"))
    found = save(found, "found")
    out = docs.withColumn("__dec_text", F.md5("text")).join(small(found), "__dec_text", "left")
    return out.select(*docs.columns, F.coalesce(F.col("__dec_found").cast(kind), F.array().cast(kind)).alias("__dec_hits"))


def report(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Per document: doc_id, contaminated, n_items found, item_ids (ascending, each once) and the smallest distance."""
    m = matches(docs.select("doc_id", "text"), benchmark, budget)
    ids = F.array_sort(F.array_distinct(F.col("__dec_hits.item_id")))
    return m.select("doc_id", (F.size("__dec_hits") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), F.array_min("__dec_hits.distance").alias("distance"))


def clean(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    return matches(docs, benchmark, budget).where(F.size("__dec_hits") == 0).select(*docs.columns)
