"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has 64 bits: bit j is set if more than half of the shingle hashes have it. Two
fingerprints are linked if they differ in at most ``distance`` bits.

The anchors are the words of a covering code of length 64, the product of four perfect codes: two Golay codes
[23, 12] of covering radius 3 and two Hamming codes [15, 11] and [3, 1] of radius 1. In a perfect
code each word lies within the radius of exactly one code word, its home. A fingerprint is sent
to its home anchor and, as a visitor, to every anchor within radius plus distance: block by block, to each anchor
whose cell it can reach by changing at most ``distance`` bits (about 170 of 2^36 anchors for distance 2). If two
fingerprints are near enough, each visits the other's home; per anchor, the residents are compared with the
visitors. As there are 2^36 anchors, the lists stay short when the table grows.

Equal fingerprints are merged before anything is replicated, so exact copies cost one row.

Defined cases: a null or empty text, or one without words, has fingerprint zero, which links like any other; repeated
rows share their fingerprint; a null id is never the smallest id of a component unless all its ids are null (``keep_one`` then
keeps one row of the component); rows of one id with different texts are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcost.llm.components import components
from shelfcost.llm.store import save
from shelfcost.llm.text import WORD_RE, lower_ascii

SHINGLE = 3
DISTANCE = 2
SEED = 42
_CHUNK = 1 << 16  # shingles counted at once, which bounds memory for very long texts

# Length, generator polynomial and covering radius of the perfect cyclic codes
CODES = ((23, 0b110001110101, 3), (23, 0b110001110101, 3), (15, 0b10011, 1), (3, 0b111, 1))


def fingerprint(lowered: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text whose A-Z are in lower case already, as a signed long."""
    words = WORD_RE.findall(lowered or "")
    if not words:
        return 0
    raw = [w.encode("utf-8", "replace") for w in words]
    joined = b" ".join(raw)
    ends = np.cumsum([len(w) + 1 for w in raw]) - 1
    k = min(shingle, len(raw))
    starts = np.concatenate(([0], ends[: len(raw) - k] + 1)).tolist()
    stops = ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more: Column) -> DataFrame:
    """(doc_id, fp) and the columns ``more``: one narrow pass over the texts."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return docs.select("doc_id", fp(lower_ascii(F.col("text"))).alias("fp"), *more)


class _Code:
    """A perfect cyclic code on the bits from ``shift`` on."""

    def __init__(self, n: int, poly: int, radius: int, shift: int, distance: int):
        self.n, self.shift = n, shift
        degree = poly.bit_length() - 1
        self.unit = []
        s = 1
        for _ in range(n):
            self.unit.append(s)
            s <<= 1
            if s >> degree:
                s ^= poly
        self.leader = [0] * (1 << degree)  # the lightest change that leads from a syndrome to a code word
        for w in range(1, radius + 1):
            for bits in combinations(range(n), w):
                self.leader[self._sum(bits)] = sum(1 << b for b in bits)
        # by syndrome: how the home anchor changes at each number of changed bits, without what fewer bits reach
        self.moves: list[list[np.ndarray]] = []
        for s, lead in enumerate(self.leader):
            seen, per = {0}, []
            for w in range(1, distance + 1):
                found = set()
                if w <= n:
                    for bits in combinations(range(n), w):
                        to = lead ^ self.leader[s ^ self._sum(bits)] ^ sum(1 << b for b in bits)
                        if to not in seen:
                            found.add(to)
                seen |= found
                per.append(np.array(sorted(found), np.uint64) << np.uint64(shift))
            self.moves.append(per)

    def _sum(self, bits: tuple[int, ...]) -> int:
        s = 0
        for b in bits:
            s ^= self.unit[b]
        return s

    def syndrome(self, fps: np.ndarray) -> np.ndarray:
        s = np.zeros(len(fps), np.int64)
        for b, u in enumerate(self.unit):
            s ^= ((fps >> np.uint64(self.shift + b)) & np.uint64(1)).astype(np.int64) * u
        return s

    def home(self, fps: np.ndarray, syndromes: np.ndarray) -> np.ndarray:
        """The change that takes this block of each fingerprint to its home."""
        return np.array(self.leader, np.uint64)[syndromes] << np.uint64(self.shift)


@cache
def _codes(distance: int) -> tuple[_Code, ...]:
    out, shift = [], 0
    for n, poly, radius in CODES:
        out.append(_Code(n, poly, radius, shift, distance))
        shift += n
    return tuple(out)


def homes(fps: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """The home anchor of each fingerprint (uint64)."""
    out = fps.copy()
    for code in _codes(distance):
        out ^= code.home(fps, code.syndrome(fps))
    return out


def visited(fps: np.ndarray, distance: int = DISTANCE) -> list[np.ndarray]:
    """For each fingerprint all anchors whose cell is at most ``distance`` changed bits away, its home included."""
    codes = _codes(distance)
    syndromes = [c.syndrome(fps).tolist() for c in codes]
    out = []
    for k, home in enumerate(homes(fps, distance)):
        by_cost = [np.array([home], np.uint64)] + [np.empty(0, np.uint64)] * distance
        for code, s in zip(codes, syndromes):
            moves = code.moves[s[k]]
            by_cost = [
                np.concatenate([by_cost[cost]] + [(by_cost[cost - w][:, None] ^ moves[w - 1][None, :]).ravel() for w in range(1, cost + 1)])
                for cost in range(distance + 1)
            ]
        out.append(np.concatenate(by_cost))
    return out


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) with a < b: the pairs of different fingerprints of ``fps`` (fp, distinct) that are near enough."""

    @F.pandas_udf("long")
    def home(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for fp in batches:
            yield pd.Series(homes(fp.to_numpy(np.int64).view(np.uint64), distance).view(np.int64))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            all_fps = batch["fp"].to_numpy(np.int64)
            for at in range(0, len(all_fps), 2000):
                fp = all_fps[at : at + 2000]
                to = visited(fp.view(np.uint64), distance)
                yield pd.DataFrame({"anchor": np.concatenate(to).view(np.int64), "b": np.repeat(fp, [len(x) for x in to])})

    residents = fps.select(home("fp").alias("anchor"), F.col("fp").alias("a"))
    visitors = fps.mapInPandas(visits, "anchor long, b long")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # a merge join at every size: the visitors are many whether or not the residents would fit a broadcast
    return residents.hint("merge").join(visitors, "anchor").where((F.col("a") < F.col("b")) & near).select("a", "b")


def _named(table: DataFrame, least: Column, distance: int) -> DataFrame:
    """(fp, component_id): the smallest ``least`` of the rows of ``table`` whose fingerprints are linked with this one."""
    classes = save(table.groupBy("fp").agg(F.min(least).alias("least")), "classes")
    member = components(links(classes.select("fp"), distance))
    rooted = classes.join(member, classes.fp == member.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(of_root, "root").select("fp", "component_id")


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id of the documents linked with this one."""
    table = save(fingerprints(docs, shingle), "fingerprints")
    return table.join(_named(table, F.col("doc_id"), distance), "fp").select("doc_id", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    return grouped(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with the first document of each component only: the one of the smallest id, then of the smallest hash of its text.

    A document's name is its id and its text's hash; rows repeated under one name stay together if they have an id, else one of them stays.
    """
    named = docs.withColumns({"__sim_id": F.col("doc_id"), "__sim_hash": F.xxhash64("text")})
    key = ["__sim_id", "__sim_hash"]
    table = save(fingerprints(docs.select("doc_id", "text"), shingle, F.xxhash64("text").alias("th")), "fingerprints")
    me = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")  # null ids come last
    g = table.join(_named(table, me, distance), "fp").withColumn("first", me.eqNullSafe(F.col("component_id")))
    names = g.groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_hash")).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"))
    several = F.col("first") & F.col("g_id").isNull() & (F.col("n") > 1)
    names = save(names.where(~F.col("first") | several), "names")
    same = named["__sim_id"].eqNullSafe(names["g_id"]) & (named["__sim_hash"] == names["g_hash"])
    out = named.join(names, same, "left_anti").select(*docs.columns)
    twins = named.where(F.col("__sim_id").isNull()).join(names.where("first").select("g_hash"), F.col("__sim_hash") == F.col("g_hash"))
    row = F.struct(*docs.columns)
    one = twins.groupBy("g_hash").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("__sim_row"))
    return out.unionByName(one.select("__sim_row.*"))
