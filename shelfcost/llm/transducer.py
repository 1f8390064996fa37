"""Minimal acyclic transducers from terms to ordinals, in shards of bounded size.

A transducer is built incrementally from sorted terms: the last path is open, everything left of it is minimal, and a state that
leaves the path is replaced by an equal one from the register if there is one. A transition's weight is the number of terms that come
before the ones behind it, so the sum along a term's path is the term's place in UTF-8 order, and a place can be spelled again.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np

from shelfcost.llm.store import open_fs

CACHE_BYTES = 64 << 20


class Transducer:
    """``keys``: state * 256 + byte, ascending; ``targets`` and ``weights`` of these transitions; ``final`` by state. State 0 is the start."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, weights: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.weights, self.final = keys, targets, weights, final

    @classmethod
    def build(cls, terms: Sequence[bytes]) -> Transducer:
        """The minimal transducer of distinct ``terms`` in ascending order."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((byte, target), ...))
        below: list[int] = []  # terms that can be read from each state

        def minimal(final: bool, arcs: list[tuple[int, int]]) -> int:
            state = (final, tuple(arcs))
            number = register.get(state)
            if number is None:
                number = register[state] = len(states)
                states.append(state)
                below.append(final + sum(below[t] for _, t in arcs))
            return number

        path: list[list] = [[False, []]]  # the open states: final, arcs to minimal states
        last = b""
        for term in terms:
            same, most = 0, min(len(last), len(term))
            while same < most and last[same] == term[same]:
                same += 1
            for at in range(len(last), same, -1):
                path[at - 1][1].append((last[at - 1], minimal(*path[at])))
            del path[same + 1 :]
            path.extend([False, []] for _ in range(len(term) - same))
            path[-1][0] = True
            last = term
        for at in range(len(last), 0, -1):
            path[at - 1][1].append((last[at - 1], minimal(*path[at])))
        start = minimal(*path[0])
        place = lambda s: 0 if s == start else s + 1  # noqa: E731  the start comes first
        keys, targets, weights = [], [], []
        for number in [start, *range(start)]:
            final, arcs = states[number]
            before = int(final)
            for byte, target in arcs:
                keys.append(place(number) * 256 + byte)
                targets.append(place(target))
                weights.append(before)
                before += below[target]
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(weights, np.int32), np.array([states[s][0] for s in [start, *range(start)]], np.uint8))

    def ordinals(self, terms: Sequence[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 for those that are not in the transducer; all terms advance a byte at a time together."""
        lengths = np.fromiter(map(len, terms), np.int64, len(terms))
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(terms), np.uint8)
        out = np.full(len(terms), -1, np.int64)
        alive = np.arange(len(terms))
        state, total = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = 0
        while len(alive):
            done = lengths[alive] == at
            if done.any():
                ended = done & (self.final[state] > 0)
                out[alive[ended]] = total[ended]
                alive, state, total = alive[~done], state[~done], total[~done]
            key = state * 256 + text[starts[alive] + at]
            arc = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            known = self.keys[arc] == key if len(self.keys) else np.zeros(len(alive), bool)
            alive, arc = alive[known], arc[known]
            state, total = self.targets[arc].astype(np.int64), total[known] + self.weights[arc]
            at += 1
        return out

    def spell(self, ordinal: int) -> bytes:
        """The term of an ordinal."""
        out, state = bytearray(), 0
        while True:
            lo, hi = np.searchsorted(self.keys, (state * 256, state * 256 + 256))
            if self.final[state]:
                if ordinal == 0:
                    return bytes(out)
            arc = lo + int(np.searchsorted(self.weights[lo:hi], ordinal, "right")) - 1
            ordinal -= int(self.weights[arc])
            out.append(int(self.keys[arc]) & 255)
            state = int(self.targets[arc])

    def dumps(self) -> bytes:
        head = np.array([len(self.keys), len(self.final)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.keys, self.targets, self.weights, self.final))

    @classmethod
    def loads(cls, data: bytes) -> Transducer:
        n, states = np.frombuffer(data, np.int64, 2).tolist()
        at = 16
        out = []
        for kind, size in ((np.int64, n), (np.int32, n), (np.int32, n), (np.uint8, states)):
            out.append(np.frombuffer(data, kind, size, at))
            at += out[-1].nbytes
        return cls(*out)


def write(folder: str, transducer: Transducer) -> str:
    """Write a shard to the shared folder under a name of its own; the name."""
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    name = uuid.uuid4().hex
    with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(transducer.dumps())
    return name


_cache: OrderedDict[str, Transducer] = OrderedDict()


def _read(folder: str, name: str) -> Transducer:
    """A shard, from the worker's cache of the shards used last (``CACHE_BYTES`` at most)."""
    key = f"{folder}/{name}"
    if key not in _cache:
        fs, path = open_fs(folder)
        with fs.open_input_file(f"{path}/{name}") as f:
            _cache[key] = Transducer.loads(f.readall())
        while len(_cache) > 1 and sum(t.keys.nbytes * 2 + t.final.nbytes for t in _cache.values()) > CACHE_BYTES:
            _cache.popitem(last=False)
    _cache.move_to_end(key)
    return _cache[key]


class Vocabulary:
    """The shards of each language in order: first term, first ordinal and file. A search loads only the shards that its terms fall into."""

    def __init__(self, folder: str, shards: Sequence[tuple[str, bytes, int, str]]):
        """``shards``: (lang, first term, number of terms, file), in any order."""
        self.folder = folder
        self.of: dict[str, tuple[list[bytes], list[int], list[str]]] = {}
        for lang, first, n, name in sorted((s[0], bytes(s[1]), s[2], s[3]) for s in shards):
            firsts, bases, names = self.of.setdefault(lang, ([], [0], []))
            firsts.append(first)
            bases.append(bases[-1] + n)
            names.append(name)

    def ordinals(self, lang: str, terms: Sequence[bytes]) -> np.ndarray:
        """The ordinals of ascending ``terms`` in the language's vocabulary, -1 for those not kept."""
        out = np.full(len(terms), -1, np.int64)
        if lang not in self.of:
            return out
        firsts, bases, names = self.of[lang]
        at = 0
        while at < len(terms):
            k = bisect_right(firsts, terms[at]) - 1
            to = bisect_left(terms, firsts[k + 1], at) if k + 1 < len(firsts) else len(terms)
            if k >= 0:
                found = _read(self.folder, names[k]).ordinals(terms[at:to])
                out[at:to] = np.where(found >= 0, found + bases[k], -1)
            at = to
        return out

    def spell(self, lang: str, ordinals: Sequence[int]) -> Iterator[bytes]:
        """The terms of ``ordinals``."""
        _, bases, names = self.of[lang]
        for ordinal in ordinals:
            k = bisect_right(bases, ordinal) - 1
            yield _read(self.folder, names[k]).spell(ordinal - bases[k])
