"""Suffix-array dedup of byte strings that occur more than once in the corpus.

A window is a string of ``length`` bytes at one place of one document. The operator finds the windows whose string also
starts elsewhere, and removes the bytes they cover: with ``keep="none"`` every occurrence, with ``keep="first"`` the later
ones, so that the first stays.

A corpus has no suffix array that fits one task, so windows are first dealt to groups that can only
match within themselves. A window's anchor is its leftmost smallest hash of ``GRAM`` bytes; equal windows have equal anchors at equal
offsets. A maximal run of windows with one anchor is a segment. Segments with equal bytes are merged to a class: a
class of several occurrences needs no search. Classes that share an anchor but differ (the
ends of repeated passages) are searched with a suffix array over their bytes: with the suffixes in order, the previous and
next smaller positions of each give its longest previous factor (and what that repeats), and a window is
repeated if it reaches ``length``. Anchors with more than ``GROUP`` classes are searched by
counting their windows' 128-bit hashes, which needs no group in one place. Both ways are exact up to collisions: segments are one class if the 64-bit
hash of the anchor's bytes and another of the whole segment agree, windows are counted as equal if two 64-bit hashes of them agree.

Anchors, classes and windows that are very common (more than ``ROWS`` rows, and one in ``SHARE`` of all) are at most ``SHARE`` many; their rows are dealt
over several tasks in the joins, and their few rows on the other side are repeated for each.

Defined cases: a null text is empty, and texts shorter than ``length`` lose nothing; matches never cross documents;
repeated rows are documents of their own, so each repeats the other; documents are ordered by id (null first); an
empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcost.llm.store import save

LENGTH = 400
GRAM = 48
GROUP = 2000  # classes of one anchor that one task takes together
ROWS = 1000  # rows of one key that one task of a join takes, at least
SHARE = 16384
PIECE = 1 << 19  # windows hashed at once
CHUNK = 1 << 20  # bytes under one suffix array, beyond one group

_rng = np.random.default_rng(20240607)
_TABLES = _rng.integers(0, 1 << 64, (2, 256), np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _grow(n: int) -> None:
    """Powers of both bases and of their inverses modulo 2^64, for at least n places."""
    if _powers and len(_powers[0][0]) >= n:
        return
    _powers.clear()
    for base in _BASES:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x))
        _powers.append((both[0], both[1]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Polynomial hashes of all substrings of ``buf``, by one of two bases."""

    def __init__(self, buf: np.ndarray, which: int):
        n = len(buf)
        _grow(n + 1)
        up, self.down = _powers[which]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLES[which][buf] * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.down[: len(self.sums)][start])


def anchors(grams: np.ndarray, w: int) -> np.ndarray:
    """For each run of ``w`` values the place of its leftmost smallest (block-wise prefix and suffix minima)."""
    n = len(grams)
    full = -(-n // w) * w
    g = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    g[:n] = grams
    blocks = g.reshape(-1, w)
    at = np.arange(full)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = np.where(g == after, at, full)
    after_at = np.minimum.accumulate(place[::-1])[::-1]
    before = np.minimum.accumulate(blocks, axis=1)
    new = np.ones(blocks.shape, bool)
    new[:, 1:] = before[:, 1:] < before[:, :-1]
    before_at = np.maximum.accumulate(np.where(new.ravel(), at, -1))
    before = before.ravel()
    i = np.arange(n - w + 1)
    return np.where(after[i] <= before[i + w - 1], after_at[i], before_at[i + w - 1])


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first window, windows, anchor hash, class hash) of the segments of each piece of the texts.

    Texts are laid end to end; a text of more than ``PIECE`` windows is cut into pieces that overlap by a window, so memory is bounded.
    """
    part: list[tuple[int, int, bytes]] = []
    held = 0
    for number, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), PIECE):
            part.append((number, at, text[at : at + PIECE + length - 1]))
            held += len(part[-1][2])
            if held >= PIECE:
                yield _segments(part, length, gram)
                part, held = [], 0
    if part:
        yield _segments(part, length, gram)


def _segments(part: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    buf = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
    sizes = np.array([len(p[2]) for p in part])
    base = np.cumsum(sizes) - sizes
    first, second = Hashes(buf, 0), Hashes(buf, 1)
    n = len(buf)
    grams = first.of(slice(0, n - gram + 1), slice(gram, n + 1))
    anchor = anchors(grams, length - gram + 1)
    owner = np.repeat(np.arange(len(part)), sizes)[: len(anchor)]
    valid = np.arange(len(anchor)) + length <= (base + sizes)[owner]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(anchor)))
    good = valid[starts]
    starts, counts = starts[good], counts[good]
    whole = second.of(starts, starts + counts + length - 1)
    offset = (anchor[starts] - starts).astype(np.uint64)
    cls = _mixed(whole ^ _mixed(offset * np.uint64(1 << 32) + counts.astype(np.uint64)))
    who = owner[starts]
    number = np.array([p[0] for p in part])[who]
    place = starts - base[who] + np.array([p[1] for p in part])[who]
    return number, place, counts, grams[anchor[starts]].view(np.int64), cls.view(np.int64)


def suffix_order(buf: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``buf`` (symbols up to 510) in the order of their first ``length`` symbols; and each one's rank.

    Prefix doubling from 7 symbols on; suffixes that nothing ties with any more are not sorted again. Equal prefixes have equal ranks.
    """
    n = len(buf)
    width = 7
    key = np.zeros(n, np.int64)
    for k in range(min(width, n)):
        key[: n - k] += (buf[k:] + 1) << (9 * (width - 1 - k))
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    members, key = order, key[order]
    while True:
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[members] = np.maximum.accumulate(np.where(new, slots, 0))
        alone = new & np.append(new[1:], True)
        slots, members = slots[~alone], members[~alone]
        if width >= length or not len(slots):
            return order, rank
        step = min(width, length - width)
        ahead = members + step
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[members] * (n + 1) + follow
        by = np.argsort(key)
        members, key = members[by], key[by]
        order[slots] = members
        width += step


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place with a smaller value, or -1."""
    n = len(values)
    v = np.append(values, np.iinfo(np.int64).min)  # stands for place -1
    near = np.arange(-1, n - 1)
    todo = np.flatnonzero(v[near] >= values)
    while len(todo):
        near[todo] = near[near[todo]]
        todo = todo[v[near[todo]] >= values[todo]]
    return near


def repeated(texts: list[bytes], length: int, later_only: bool) -> list[np.ndarray]:
    """For each text and each window of it, whether its string starts elsewhere in the texts (earlier, if ``later_only``).

    One suffix array over all texts. Each text is followed by a symbol that no byte equals; windows never reach it.
    """
    sizes = np.array([len(t) for t in texts])
    buf = np.empty(int(sizes.sum()) + len(texts), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(buf), bool)
    inside[ends] = False
    buf[inside] = np.frombuffer(b"".join(texts), np.uint8)
    buf[ends] = 256
    starts = ends - sizes
    order, rank = suffix_order(buf, length)
    left = np.repeat(ends, sizes + 1) - np.arange(len(buf))  # bytes up to the end of the text
    # only suffixes that tie with another in the full length can reach it; the others are left out of the order
    order = order[left[order] >= length]
    same = rank[order[1:]] == rank[order[:-1]]
    order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) > 1 else order[:0]
    found = np.zeros(len(buf), bool)
    # the longest previous factor starts at the previous or next smaller position in suffix order
    before = _nearest_smaller(order)
    after = len(order) - 1 - _nearest_smaller(order[::-1])[::-1]
    for near, ok in ((before, before >= 0), (after, after < len(order))):
        at = np.flatnonzero(ok)
        at = at[rank[order[near[at]]] == rank[order[at]]]
        found[order[at]] = True
        if not later_only:
            found[order[near[at]]] = True  # what it repeats
    return [found[s : s + max(0, n - length + 1)] for s, n in zip(starts, sizes)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal [from, to) runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_ID = ("nid", "th")  # a row's name: its id (null: the least number) and a hash of its text
_NULL = -(1 << 63)


def _dealt(many: DataFrame, one: DataFrame, keys: list[str], counts: DataFrame, how: str = "inner") -> DataFrame:
    """``many`` joined with ``one`` (a row per key) on ``keys``; ``counts`` (keys, rows) says how many rows ``many`` has of a key, those of few rows may be missing.

    A key of more than ``ROWS`` rows and of one in ``SHARE`` of all rows is dealt over tasks by the row's name. There are ``SHARE`` such keys at most, so they are broadcast.
    """
    total = counts.agg(F.sum("rows")).first()[0] or 0
    limit = max(ROWS, total // SHARE)
    common = F.broadcast(counts.where(F.col("rows") > limit).select(*keys, F.ceil(F.col("rows") / limit).cast("int").alias("ways")))
    way = F.coalesce(F.pmod(F.hash(*(c for c in many.columns if c not in keys)), F.col("ways")), F.lit(0))
    left = many.join(common, keys, "left").withColumn("way", way).drop("ways")
    ways = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("ways"), F.lit(1)) - 1))
    right = one.join(common, keys, "left").withColumn("way", ways).drop("ways")
    return left.join(right, [*keys, "way"], how).drop("way")


def _segment_table(d: DataFrame, length: int) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch[at : at + 1000]
                nid, th = some["nid"].to_numpy(), some["th"].to_numpy()
                for number, place, count, key, cls in segments([bytes(r) for r in some["raw"]], length):
                    yield pd.DataFrame({"nid": nid[number], "th": th[number], "start": place.astype(np.int32), "n": count.astype(np.int32), "key": key, "cls": cls})

    return save(d.mapInPandas(cut, "nid long, th int, start int, n int, key long, cls long"), "segments")


def _fetched(d: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (nid, th, start, n, key, lone, k) with the segments' bytes."""
    lists = wanted.groupBy(*_ID).agg(F.collect_list(F.struct("start", "n", "key", "lone", "k")).alias("parts"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["nid", "th", "start", "key", "lone", "k", "seg"]
        out: list[tuple] = []
        for batch in batches:
            for nid, th, raw, parts in zip(batch["nid"], batch["th"], batch["raw"], batch["parts"]):
                raw = bytes(raw)
                for p in parts:
                    out.append((nid, th, p["start"], p["key"], p["lone"], p["k"], raw[p["start"] : p["start"] + p["n"] + length - 1]))
                    if len(out) >= 5000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return save(d.join(lists, list(_ID)).select(*_ID, "raw", "parts").mapInPandas(cut, "nid long, th int, start int, key long, lone boolean, k long, seg binary"), "parts")


def _searched(parts: DataFrame, length: int, later_only: bool) -> DataFrame:
    """(nid, th, a, b): runs of repeated windows, by suffix arrays over whole groups of an anchor."""

    def flush(rows: list[tuple]) -> pd.DataFrame:
        out = []
        for (nid, th, start, _, lone, _), flags in zip(rows, repeated([r[5] for r in rows], length, later_only)):
            if lone or later_only:
                out += [(nid, th, start + a, start + b) for a, b in _runs(flags)]
        return pd.DataFrame(out, columns=["nid", "th", "a", "b"], dtype="int64")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(batch["nid"], batch["th"], batch["start"], batch["key"], batch["lone"], batch["seg"]):
                if rows and row[:4] == rows[-1][:4]:
                    continue  # a row repeated under one id
                if held >= CHUNK and row[3] != rows[-1][3]:
                    yield flush(rows)
                    rows, held = [], 0
                rows.append((*row[:5], bytes(row[5])))
                held += len(row[5])
        if rows:
            yield flush(rows)

    ordered = parts.select(*_ID, "start", "key", "lone", "seg").repartition("key").sortWithinPartitions("key", *_ID, "start")
    return ordered.mapInPandas(search, "nid long, th int, a int, b int")


def _counted(parts: DataFrame, length: int, later_only: bool) -> DataFrame:
    """As :func:`_searched`, for anchors of many classes: every window's hash is counted."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for nid, th, start, lone, seg in zip(batch["nid"], batch["th"], batch["start"], batch["lone"], batch["seg"]):
                buf = np.frombuffer(bytes(seg), np.uint8)
                n = len(buf) - length + 1
                h = [Hashes(buf, k).of(slice(0, n), slice(length, length + n)).view(np.int64) for k in (0, 1)]
                yield pd.DataFrame({"nid": nid, "th": np.int32(th), "a": np.arange(n, dtype=np.int32) + start, "lone": lone, "h1": h[0], "h2": h[1]})

    windows = parts.select(*_ID, "start", "lone", "seg").mapInPandas(hashed, "nid long, th int, a int, lone boolean, h1 long, h2 long")
    at = F.struct(*_ID, "a")
    groups = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c"), F.min(at).alias("first")).where("c > 1")
    groups = save(groups, "groups")
    found = _dealt(windows, groups.drop("c"), ["h1", "h2"], groups.select("h1", "h2", F.col("c").alias("rows")))
    found = found.where(at != F.col("first")) if later_only else found.where("lone")
    return found.select(*_ID, "a", (F.col("a") + 1).alias("b"))


def repeated_windows(d: DataFrame, length: int = LENGTH, keep: str = "none", group: int = GROUP) -> DataFrame:
    """(nid, th, a, b): runs [a, b) of window starts to remove, for documents (nid, th, raw)."""
    later_only = keep == "first"
    seg = _segment_table(d, length)
    at = F.struct(*_ID, "start", "n")
    classes = save(seg.groupBy("key", "cls").agg(F.count(F.lit(1)).alias("c"), F.min(at).alias("at")), "classes")
    keys = save(classes.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("least")).where("k > 1"), "keys")  # anchors whose classes differ
    classes = _dealt(classes, keys, ["key"], keys.select("key", F.col("k").alias("rows")), "left")
    differ = F.col("k").isNotNull() & (F.lit(later_only) | (F.col("least") == 1))
    hits = save(classes.where((F.col("c") > 1) | differ), "hits")

    again = hits.where("c > 1")
    whole = _dealt(seg, again.select("key", "cls", "at"), ["key", "cls"], again.select("key", "cls", F.col("c").alias("rows")))
    if later_only:
        whole = whole.where(at != F.col("at"))
    whole = whole.select(*_ID, F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))

    parts = _fetched(d, hits.where(differ).select("at.*", "key", (F.col("c") == 1).alias("lone"), "k"), length)
    found = _searched(parts.where(F.col("k") <= group), length, later_only).unionByName(_counted(parts.where(F.col("k") > group), length, later_only))
    return whole.unionByName(found)


def _rows(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("nid"), F.hash(raw).alias("th"), raw.cast("binary").alias("raw"))


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs [from, to) in order, those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def cleaned(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """``docs`` with ``__sub_spans``, the removed byte runs in order, and ``__sub_kept``, the bytes that stay.

    A document that starts or ends inside a character after the removal keeps those bytes; decode with replacement where text is wanted.
    """
    packed = _rows(docs.select("doc_id", "text", F.struct(*docs.columns).alias("__sub_row"))).select(*_ID, "raw", "__sub_row")
    windows = repeated_windows(packed.select(*_ID, "raw"), length, keep)
    runs = windows.groupBy(*_ID).agg(F.collect_list(F.struct("a", (F.col("b") + length - 1).alias("b"))).alias("runs"))
    rows = packed.join(runs, list(_ID), "left").select("__sub_row", "raw", "runs")

    @F.pandas_udf("struct<spans:array<struct<a:int,b:int>>,kept:binary>")
    def cut(raws: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for raw, found in zip(raws, runs):
            raw = bytes(raw)
            gone = merged([(r["a"], r["b"]) for r in found]) if found is not None else []
            edges = [0, *(x for run in gone for x in run), len(raw)]
            out.append(([{"a": a, "b": b} for a, b in gone], b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))))
        return pd.DataFrame(out, columns=["spans", "kept"])

    done = rows.select("__sub_row", cut("raw", "runs").alias("c"))
    return done.select("__sub_row.*", F.col("c.spans").alias("__sub_spans"), F.col("c.kept").alias("__sub_kept"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (every occurrence of a repeated string is removed)."""
    c = cleaned(docs.select("doc_id", "text"))
    n = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    return c.select(
        "doc_id", n.alias("n_bytes"), (n - F.octet_length("__sub_kept")).cast("long").alias("n_removed"),
        F.size("__sub_spans").cast("long").alias("n_spans"), F.sha2("__sub_kept", 256).alias("kept_sha256"),
    )
