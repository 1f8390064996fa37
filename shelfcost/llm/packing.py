"""Packing documents into sequences of a fixed number of tokens.

A task reads its documents once: it turns them into token ids, cuts full windows off long ones, and collects the rests. As soon as
the rests of a group fill ``GROUP`` windows they are packed, by Karmarkar-Karp multiway differencing: every rest begins as a partial
partition into m windows of which one is used; the two partial partitions with the largest imbalance are merged again and
again, the fullest windows of one with the emptiest of the other, so that imbalances oppose each other. What comes out is m nearly
equal windows. Documents may be cut, so the group's ids beyond m full windows are taken off the largest rests beforehand and raise the
number of windows by some whose lengths are powers of two, which need no padding; and what exceeds the capacity of a window is cut
off its largest piece and fills those with room. ``cut=False`` leaves documents whole: then the number of windows rises until
the fullest fits, which pads about 3 % on the given texts (windows of about three rests are 40 to 100 tokens apart).

Nothing is shuffled and a task holds the ids of one group (some MB) and one slice of texts, whatever the size of the input;
groups follow the order of the rows in a partition, so a task that is run again gives the same sequences.

Token ids: text is cut at spaces and line feeds, which the tokenizer never joins, and each different piece is encoded once
and taken from a bounded cache of pieces already encoded. Ids are those of the whole text (tested).

Defined cases: a null or empty text has only the id 1; special tokens' strings in a text are ordinary text; repeated rows, and rows with
a null id, are documents of their own; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
GROUP = 512  # windows that the rests of a group fill
END = 1
ID_BYTES = 4
SLICE = 4 << 20  # bytes of text whose pieces are looked up together
CACHED = 1 << 20  # pieces, about 200 bytes each
JOINED = 1000
LONG_PIECE = 1 << 16
_WORD_AND_POINTS = re.compile(rb"(.*[a-z])([.,!?;:]+)", re.DOTALL)  # the tokenizer always cuts here
_LONG_CUT = re.compile(r"(?<=[^\W\d_])(?=[.,;:!?])")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Ids:
    """Texts to token ids, packed as little-endian unsigned 32-bit numbers."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = bool(suffix) and token.endswith(suffix)

    def _learn_each(self, pieces: list[bytes]) -> None:
        cuts = [_LONG_CUT.split(p.decode()) if len(p) > LONG_PIECE else [p.decode()] for p in pieces]
        found = iter(self.tokenizer.encode_batch_fast([t for c in cuts for t in c], add_special_tokens=False))
        for p, c in zip(pieces, cuts):
            ids = [i for _ in c for i in next(found).ids]
            self.known[p] = struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode ``pieces``. Words of lower-case letters are encoded many at a time: each ends with the only one of its tokens that ends a word."""
        words, others = [], []
        for p in pieces:
            t = p.decode()
            (words if t.isalpha() and t.islower() and len(p) <= LONG_PIECE else others).append(p)
        blocks = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        for block, found in zip(blocks, self.tokenizer.encode_batch_fast([b" ".join(b).decode() for b in blocks], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = ID_BYTES * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) != len(block):
                others.extend(block)
                continue
            data = ids.tobytes()
            self.known.update(zip(block, (data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist()))))
        self._learn_each(others)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [t.encode("utf-8", "replace").lower().replace(b"\n", b" ").split(b" ") for t in texts]  # only A-Z here, the tokenizer does the rest
        found = [list(map(self.known.get, s)) for s in split]
        open_ = [k for k, f in enumerate(found) if None in f]
        new = {p for k in open_ for p, ids in zip(split[k], found[k]) if ids is None}
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
        known = self.known
        parts = {p: m.groups() for p in new if (m := _WORD_AND_POINTS.fullmatch(p))}
        whole = {p for p in new if p not in parts}.union(*parts.values())
        self._learn([p for p in whole if p not in known])
        known.update((p, known[a] + known[b]) for p, (a, b) in parts.items())
        for k in open_:
            found[k] = [known[p] if ids is None else ids for p, ids in zip(split[k], found[k])]
        return [b"".join(f) for f in found]


_encoders: dict[str, Ids] = {}


def encoder(tokenizer: str) -> Ids:
    """The worker's encoder for a tokenizer file."""
    if tokenizer not in _encoders:
        _encoders[tokenizer] = Ids(tokenizer)
    return _encoders[tokenizer]


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """A partition of the numbers of ``sizes`` into ``m`` windows (lists of places) of nearly equal sums.

    A partial partition is its sums in descending order, without the unused windows, and a node for each; a merge makes a node of two.
    """
    ties = count()
    heap = [(-s if m > 1 else 0, next(ties), np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    kids: list[tuple[int, int]] = []
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        if len(a) < len(b):
            a, an, b, bn = b, bn, a, an
        free = min(m - len(a), len(b))  # the fullest of b go to unused windows, the others, fullest last, to the emptiest of a
        both = len(b) - free
        keep = len(a) - both
        merged = np.arange(len(sizes) + len(kids), len(sizes) + len(kids) + both)
        kids.extend(zip(an[keep:].tolist(), bn[free:][::-1].tolist()))
        sums = np.concatenate([a[:keep], a[keep:] + b[free:][::-1], b[:free]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], np.concatenate([an[:keep], merged, bn[:free]])[order]
        gap = int(sums[0] - sums[-1]) if len(sums) == m else int(sums[0])
        heapq.heappush(heap, (-gap, next(ties), sums, nodes))
    out = []
    for top in heap[0][3].tolist() if heap else []:
        items, open_nodes = [], [top]
        while open_nodes:
            x = open_nodes.pop()
            if x < len(sizes):
                items.append(x)
            else:
                open_nodes.extend(kids[x - len(sizes)])
        out.append(sorted(items))
    return out


def powers(n: int, window: int) -> list[int]:
    """Lengths that add up to ``n``: full windows, then falling powers of two."""
    return [window] * (n // window) + [1 << b for b in reversed(range(window.bit_length())) if n % window >> b & 1]


def _cut_off(parts: list[list[int]], n: int) -> list[tuple[int, int, int]]:
    """Take the last ``n`` ids off the largest of ``parts`` ([item, start, length], changed here), and from the next when it is used up."""
    out = []
    for part in sorted(parts, key=lambda p: (-p[2], p[0])):
        if not n:
            break
        cut = min(part[2], n)
        part[2] -= cut
        n -= cut
        out.append((part[0], part[1] + part[2], cut))
    return out


def _lay(pieces: list[tuple[int, int, int]], rooms: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """Lay ``pieces``, cut where a room ends, into ``rooms`` one after the other."""
    open_pieces = iter(pieces)
    i, start, n = 0, 0, 0
    for room in rooms:
        laid = []
        while room:
            if not n:
                i, start, n = next(open_pieces)
            part = min(n, room)
            laid.append((i, start, part))
            start, n, room = start + part, n - part, room - part
        yield laid


def pack(sizes: list[int], window: int = WINDOW, cut: bool = True) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (item, start in the item, length) that hold every item of ``sizes`` (each at most ``window``) once.

    With ``cut``, what the items have beyond full windows is taken off the largest ones first, and the windows are levelled after the
    differencing. Without it no item is cut, and the number of windows rises until the fullest fits.
    """
    total = sum(sizes)
    m = total // window if cut else -(-total // window)
    parts = [[i, 0, n] for i, n in enumerate(sizes)]
    if cut:
        yield from _lay(_cut_off(parts, total - m * window), powers(total - m * window, window))
    parts = [p for p in parts if p[2]]
    if not parts:
        return
    windows = differencing([p[2] for p in parts], m)
    while not cut and any(sum(parts[x][2] for x in w) > window for w in windows):
        m += 1
        windows = differencing([p[2] for p in parts], m)
    windows += [[] for _ in range(m - len(windows))]
    sums = [sum(parts[x][2] for x in w) for w in windows]
    above = [piece for w, s in zip(windows, sums) if s > window for piece in _cut_off([parts[x] for x in w], s - window)]
    below = [window - s for s in sums if s < window] if above else []
    fill = _lay(above, below)
    for w, s in zip(windows, sums):
        yield [tuple(parts[x]) for x in w if parts[x][2]] + (next(fill) if above and s < window else [])


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, group: int = GROUP, cut: bool = True, with_ids: bool = False) -> DataFrame:
    """The pieces of the documents (doc_id, text), one row each: its document, place there, sequence and place in the sequence.

    ``cut`` allows cutting documents shorter than a window; longer ones are cut at full windows in any case. ``with_ids`` adds the ids of the piece (``ids``, an array) for writing the sequences out.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(tokenizer)
        numbers = count(TaskContext.get().partitionId() << 32)
        out: list[tuple] = []
        held: list[tuple] = []  # doc_id, place of the rest, its ids, the document's tokens
        size = 0

        def piece(doc, start: int, length: int, ids: bytes, tokens: int, sequence: int, offset: int) -> None:
            row = (doc, start, length, zlib.crc32(ids), tokens, sequence, offset)
            out.append((*row, np.frombuffer(ids, "<u4").astype(np.int64)) if with_ids else row)

        def flush() -> None:
            for sequence in pack([len(ids) // ID_BYTES for _, _, ids, _ in held], window, cut):
                number, offset = next(numbers), 0
                for i, start, n in sequence:
                    doc, at, ids, tokens = held[i]
                    piece(doc, at + start, n, ids[ID_BYTES * start : ID_BYTES * (start + n)], tokens, number, offset)
                    offset += n
            held.clear()

        def frame() -> pd.DataFrame:
            columns = list(zip(*out)) if out else [()] * (8 if with_ids else 7)
            df = pd.DataFrame({name.split()[0]: (pd.array(c, "Int64") if k == 0 else list(c)) for k, (name, c) in enumerate(zip(schema.split(", "), columns))})
            out.clear()
            return df

        for batch in batches:
            doc_ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            texts = [t or "" for t in batch["text"]]
            at = 0
            while at < len(texts):
                to, n = at, 0
                while to < len(texts) and n < SLICE:
                    n += len(texts[to])
                    to += 1
                for doc, ids in zip(doc_ids[at:to], ids_of(texts[at:to])):
                    ids += struct.pack("<I", END)
                    tokens = len(ids) // ID_BYTES
                    full = tokens // window
                    for k in range(full):
                        piece(doc, k * window, window, ids[ID_BYTES * window * k : ID_BYTES * window * (k + 1)], tokens, next(numbers), 0)
                    if tokens > full * window:
                        held.append((doc, full * window, ids[ID_BYTES * window * full :], tokens))
                        size += tokens - full * window
                    if size >= group * window:
                        flush()
                        size = 0
                if len(out) >= 20_000:
                    yield frame()
                at = to
        flush()
        if out:
            yield frame()

    schema = PIECES + (", ids array<long>" if with_ids else "")
    return rows.mapInPandas(run, schema)


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packed(docs, tokenizer)
