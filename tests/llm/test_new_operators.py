"""Source audit, packing and conversation trie: brute force, edge cases, and the transducers on their own."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcost.llm import conversation_trie, packing, source_audit
from shelfcost.llm.transducer import Transducer

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, ordinal string, block string"
TURNS = "conv_id long, turn long, role string, text string, pos string, owner string"


@given(st.sets(st.binary(max_size=6), max_size=60))
@settings(max_examples=200, deadline=None)
def test_transducer_is_a_minimal_map_to_places(words):
    terms = sorted(words)
    t = Transducer.loads(Transducer.build(terms).dumps())
    assert t.ordinals(terms).tolist() == list(range(len(terms)))
    assert [t.spell(i) for i in range(len(terms))] == terms
    strange = [w + b"\0x" for w in terms if w + b"\0x" not in words]
    assert set(t.ordinals(strange).tolist()) <= {-1}
    suffixes = {frozenset(w[len(p) :] for w in terms if w.startswith(p)) for w in terms for p in (w[:i] for i in range(len(w) + 1))}
    assert len(t.final) == max(len(suffixes), 1)  # one state per different set of continuations


def _audit(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in r[1:4]) for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t, _, _ in rows]
    docs, n = defaultdict(Counter), defaultdict(Counter)
    for (_, lang, _), t in zip(rows, terms):
        docs[lang].update(set(t))
    kept = {lang: {t for t, k in c.items() if k >= min_docs} for lang, c in docs.items()}
    for (_, lang, source), t in zip(rows, terms):
        n[lang, source].update(x for x in t if x in kept[lang])
    out = set()
    for lang, source in n:
        v = len(kept[lang])
        group = {s: c for (x, s), c in n.items() if x == lang}
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + v)
        f = lambda p, q: (p - q) * (p - q) // q
        pairs = [(sum(f(share(group[source], t), share(c, t)) for t in kept[lang]), s) for s, c in group.items() if s != source]
        whole = sum(group.values(), Counter())
        best = [(f(share(group[source], t), share(whole, t)), t) for t in kept[lang] if group[source][t] and share(group[source], t) > share(whole, t)]
        for part, found in (("pair", pairs), ("term", best)):
            for k, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[: top if part == "term" else None], 1):
                out.add((lang, source, part, item, value, k))
    return out


def test_source_audit_equals_brute_force(spark, monkeypatch):
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abÄé-Zß漢") for _ in range(r.randint(1, 5))) for _ in range(300)]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 60))), r.choice(["en", "de", None]), r.choice(["x", "y", "z", None, "é"]), "a", "b") for i in range(150)]
    rows += [(500, None, "fr", "x", "a", "b"), (501, "once", "fr", "y", "a", "b"), (None, "", "fr", None, "a", "b"), (None, "", "it", "x", "a", "b"), rows[0], (7, "word " * 50_000, "en", "hot", "a", "b")]
    docs = spark.createDataFrame(rows, DOCS)
    want = _audit(rows)
    assert {tuple(x) for x in source_audit.report(docs).collect()} == want
    monkeypatch.setattr(source_audit, "BLOCK", 7)
    monkeypatch.setattr(source_audit, "DENSE", 16)
    monkeypatch.setattr(source_audit, "MATRIX", 2)
    got = source_audit.audit(docs, top=5, shard=9).collect()
    assert {tuple(x) for x in got} == _audit(rows, top=5) and len(got) == len({tuple(x) for x in got})


def test_source_audit_of_nothing(spark):
    assert source_audit.report(spark.createDataFrame([], DOCS)).collect() == []


def test_shares_are_exact_for_large_totals():
    r = random.Random(5)
    total = [r.randint(1, 9 * 10**14) for _ in range(2000)]
    count = [r.randrange(t) for t in total]
    got = source_audit.shares(np.array(count), np.array(total)).tolist()
    assert got == [1 + 10**9 * (c + 1) // t for c, t in zip(count, total)]


def test_token_ids_equal_those_of_whole_texts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    r = random.Random(7)
    odd = ["don't", "it's,", "ΣΑΣ", "İi", "é", "x<|endoftext|>y", "a.b,c", "##!!,", "…,", " x", "\t", "12a3", "漢字、", "ﬁn", "ͅa", "À."]
    texts = [" ".join(r.choices([*odd, "Plain", "words", "here,\n"], k=r.randint(0, 40))) for _ in range(300)] + ["", "x" * 200_000, "word,other." * 20_000]
    ids = packing.Ids(TOKENIZER)
    for _ in range(2):  # learned, then known
        for text, found in zip(texts, ids(texts)):
            assert np.frombuffer(found, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 64), max_size=120), st.booleans())
@settings(max_examples=150, deadline=None)
def test_pack_holds_every_id_once(sizes, cut):
    held = defaultdict(list)
    short = 0
    for sequence in packing.pack(sizes, 64, cut):
        n = sum(k for _, _, k in sequence)
        assert 0 < n <= 64
        short += 64 - n if n & (n - 1) else 0
        for i, start, k in sequence:
            held[i].append((start, k))
    for i, n in enumerate(sizes):
        at = 0
        for start, k in sorted(held[i]):
            assert start == at and k > 0
            at += k
        assert at == n and (cut or len(held[i]) == 1)
    assert not cut or short == 0


def test_differencing_is_nearly_equal():
    r = random.Random(9)
    sizes = [r.randint(1, 300) for _ in range(2000)]
    sums = [sum(sizes[i] for i in w) for w in packing.differencing(sizes, 100)]
    assert sum(sums) == sum(sizes) and max(sums) - min(sums) <= 60


def test_packing_covers_documents(spark):
    r = random.Random(11)
    rows = [(i, " ".join(r.choices(["alpha", "beta,", "gamma", "δ"], k=r.choice([0, 3, 500, 5000]))), "en", "s", "a", "b") for i in range(120)]
    rows += [(None, None, "en", "s", "a", "b"), (3000, "", "en", "s", "a", "b"), (3001, "long " * 100_000, "en", "s", "a", "b"), rows[5]]
    got = packing.packed(spark.createDataFrame(rows, DOCS), TOKENIZER, group=16, with_ids=True).collect()
    ids = packing.Ids(TOKENIZER)
    want = Counter((i, (*np.frombuffer(b, "<u4").tolist(), 1)) for i, b in zip([x[0] for x in rows], ids([x[1] or "" for x in rows])))
    for x in got:
        assert x.length == len(x.ids) and x.ids_crc32 == zlib.crc32(np.array(x.ids, "<u4").tobytes())
    sequences = defaultdict(list)
    for x in got:
        sequences[x.sequence_id].append((x.offset, x.length))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))]
        n = sum(n for _, n in s)
        assert n == 2048 or n < 2048 and n & (n - 1) == 0
    pieces = defaultdict(list)
    for x in got:
        pieces[x.doc_id].append((x.start, tuple(x.ids), x.doc_tokens))
    assert sum(x.length for x in got) == sum(len(t) * k for (_, t), k in want.items())
    for (doc, tokens), k in want.items():
        parts = sorted(pieces[doc])
        if k == 1:
            assert tuple(i for _, p, _ in parts for i in p) == tokens and {n for _, _, n in parts} == {len(tokens)}
    assert packing.report(spark.createDataFrame([], DOCS), TOKENIZER).collect() == []


def _trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest())
        for k, m in members.items()
    )


@pytest.mark.parametrize("limit", [2, 4096])
def test_trie_equals_brute_force(spark, limit):
    r = random.Random(13)
    rows = []
    for c in [*range(60), 100, 101, 205, 307, 399, -7, -100, -103]:
        kind = r.random()
        n = r.choice([1, 2, 5, 9, 40]) if kind < 0.8 else 35
        for t in range(n):
            text = f"t{t if kind > 0.6 else r.randint(0, 2)}" + "x" * (t % 5)
            rows.append((c, t, "user" if t % 2 else "bot", text, "a", "b"))
    rows += [(9, None, None, None, "a", "b"), (9, None, None, None, "a", "b"), (9, 0, "", "", "a", "b"), (None, 1, "user", "lost", "a", "b"), (10, 3, "user", "tie", "a", "b")]
    got = conversation_trie.report(spark.createDataFrame(rows, TURNS), limit).collect()
    assert sorted(map(tuple, got), key=lambda x: (x[0], x[1])) == sorted(_trie(rows), key=lambda x: (x[0], x[1]))


def test_trie_of_one_long_conversation_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CELL", 8)
    rows = [(100, t, "user", f"turn {t}", "a", "b") for t in range(700)] + [(1, 0, "user", "only", "a", "b")]
    got = conversation_trie.report(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted(map(tuple, got), key=lambda x: (x[0], x[1])) == sorted(_trie(rows), key=lambda x: (x[0], x[1]))
    assert conversation_trie.report(spark.createDataFrame([], TURNS)).collect() == []
