"""The operators against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcost.llm import components, decontam, line_dedup, mixing, simhash, substring_dedup, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts(n: int, seed: int) -> list[str]:
    """Random texts with exact copies, near copies, shared passages and repeated lines."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(400)]
    lines = [" ".join(r.choices(vocabulary, k=r.randint(1, 40))) for _ in range(30)]
    out: list[str] = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
        elif out and kind < 0.4:
            w = r.choice(out).split(" ")
            w[r.randrange(len(w))] = r.choice(vocabulary)
            out.append(" ".join(w))
        else:
            own = [" ".join(r.choices(vocabulary, k=r.randint(1, 60))) for _ in range(r.randint(1, 6))]
            out.append("\n".join(own + r.sample(lines, r.randint(0, 4))))
    return out


@pytest.fixture(scope="module")
def texts():
    return _texts(150, 5)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int")


def _roots(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _fingerprint(text: str) -> int:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, texts):
    fps = [_fingerprint(t) for t in texts]
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    assert any(fps[a] != fps[b] for a, b in links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.report(docs).collect()}
    assert got == {i: (f"{f:016x}", c) for i, (f, c) in enumerate(zip(fps, _roots(len(fps), links)))}
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == set(_roots(len(fps), links))


def test_anchors_cover_all_near_pairs():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 64, 400, np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, int(rng.integers(0, 3)), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(int(bit))
    home = simhash.homes(a)
    for h, seen in zip(home, simhash.visited(b)):
        assert h in seen and len(set(seen.tolist())) == len(seen)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(300, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}


def _distance(pattern: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != c)))
    return min(row)


def test_myers_and_pieces():
    r = random.Random(2)
    for _ in range(300):
        p, t = ("".join(r.choice("ab ") for _ in range(r.randint(1, n))) for n in (90, 60))
        d = _distance(p, t)
        assert decontam.myers(p, t, d) == d and (d == 0 or decontam.myers(p, t, d - 1) is None)
        k = r.randint(0, 5)
        cut = decontam.pieces(p, min(k, len(p) - 1))
        assert "".join(x for _, x in cut) == p and all(p[o : o + len(x)] == x and x for o, x in cut)


def test_decontamination_finds_edited_items(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(300)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(8, 20)))) for i in range(25)]
    rows = []
    for d in range(80):
        body = " ".join(r.choices(vocabulary, k=120))
        if d % 3:
            item = list(r.choice(items)[1])
            for _ in range(r.randint(0, int(len(item) * 0.15))):
                item[r.randrange(len(item))] = r.choice("xyz")
            body = body[:200] + " " + "".join(item).upper() + "! " + body[200:]
        rows.append((d, body))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, body in rows:
        text = decontam.normalised(body)
        found = {i: e for i, t in items if (e := _distance(decontam.normalised(t), text)) <= int(len(decontam.normalised(t)) * decontam.BUDGET)}
        want[d] = (sorted(found), min(found.values(), default=None))
    got = {x.doc_id: (x.item_ids, x.distance) for x in decontam.report(docs, bench).collect()}
    assert got == want and any(d for _, d in want.values())


def _removed(texts: list[bytes], length: int, keep: str) -> list[bytearray]:
    places: dict[bytes, list[tuple[int, int]]] = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            places.setdefault(t[k : k + length], []).append((i, k))
    out = [bytearray(len(t)) for t in texts]
    for where in places.values():
        for i, k in where[1:] if keep == "first" else where if len(where) > 1 else []:
            out[i][k : k + length] = b"\1" * length
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [2000, 1])
def test_substring_dedup(docs, texts, keep, group, monkeypatch):
    monkeypatch.setattr(substring_dedup.repeated_windows, "__defaults__", (60, keep, group))
    monkeypatch.setattr(substring_dedup, "GRAM", 16)
    monkeypatch.setattr(substring_dedup, "ROWS", 2)  # so that common classes, anchors and windows are dealt over tasks
    raw = [t.encode() for t in texts]
    want = {}
    for i, (t, gone) in enumerate(zip(raw, _removed(raw, 60, keep))):
        want[i] = bytes(b for b, g in zip(t, gone) if not g)
    got = {r.doc_id: bytes(r["__sub_kept"]) for r in substring_dedup.cleaned(docs, 60, keep).collect()}
    assert got == want and any(len(want[i]) < len(t) for i, t in enumerate(raw))


def test_substring_dedup_within_a_periodic_document(spark):
    rows = [(0, "for " * 400), (1, "x" * 399), (2, "y" * 401), (3, None)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert got == {0: (1600, 1600, 1, none), 1: (399, 0, 0, hashlib.sha256(b"x" * 399).hexdigest()), 2: (401, 401, 1, none), 3: (0, 0, 0, none)}


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(1)
    for n, symbols in ((1, 3), (50, 1), (700, 2), (2000, 256)):
        buf = rng.integers(0, symbols, n)
        order, rank = substring_dedup.suffix_order(buf, 40)
        keys = [tuple(buf[i : i + 40]) for i in range(n)]
        assert sorted(order) == list(range(n)) and all(keys[a] <= keys[b] for a, b in zip(order, order[1:]))
        assert all((rank[a] == rank[b]) == (keys[a] == keys[b]) for a, b in zip(order, order[1:]))


def test_decontamination_finds_short_items(spark):
    items = [(1, "What is the capital of France?"), (2, "中国的首都是哪一座城市，它在哪条河边？"), (3, "Who won?"), (4, "谁赢了"), (5, "?!"), (6, "x" * 40)]
    assert all(len(decontam.normalised(t)) < decontam.MIN_CHARS for _, t in items[:5])
    texts = [
        "He asked: what is the capital of  FRANCE? Paris.",
        "He asked what iz the kapital of france and left.",
        "what was the capitol in any franc",
        "他问道中国的首都是哪一座城市它在哪条河边谁也不知道",
        "Tell me who won, please",
        "the owl who wondered",
        "结果谁赢了呢",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in enumerate(texts):
        text = decontam.normalised(t)
        want[d] = {i: e for i, x in items[:2] if (e := _distance(decontam.normalised(x), text)) <= int(len(decontam.normalised(x)) * decontam.BUDGET)}
    want[4], want[6] = {3: 0}, {4: 0}
    assert [sorted(want[d]) for d in range(8)] == [[1], [1], [], [2], [3], [], [4], []]
    got = {r.doc_id: (r.item_ids, r.distance) for r in decontam.report(docs, bench).collect()}
    assert got == {d: (sorted(w), min(w.values(), default=None)) for d, w in want.items()}
    assert {r.doc_id for r in decontam.clean(docs, bench).collect()} == {2, 5, 7}


def test_line_dedup(docs, texts):
    def tokens(line: str) -> frozenset:
        w = WORD.findall(line)
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))

    earlier: list[frozenset] = []
    want = {}
    for i, t in enumerate(texts):
        left = []
        for line in t.split("\n"):
            if WORD.search(line):
                s = tokens(line)
                gone = any(9 * len(s & e) >= 4 * (len(s) + len(e)) for e in earlier)
                earlier.append(s)
                if gone:
                    continue
            left.append(line)
        want[i] = "\n".join(left)
    got = {r.doc_id: r.text for r in line_dedup.report(docs).collect()}
    assert got == want and any(want[i] != t for i, t in enumerate(texts))


@pytest.mark.parametrize("split_from", [0, 64, 128])
def test_line_dedup_split_lists(docs, texts, monkeypatch, split_from):
    """The same lines go whether every list, some or none are split."""
    want = {r.doc_id: r.text for r in line_dedup.report(docs).collect()}
    monkeypatch.setattr(line_dedup, "SPLIT_CLASS", split_from)
    assert {r.doc_id: r.text for r in line_dedup.report(docs).collect()} == want


def test_a_common_passage_is_split_and_loses_no_line(spark):
    """400 lines share a rare-word passage; each has a near copy in another document, far away in the list's order."""
    r = random.Random(5)
    common = " ".join(f"c{i}" for i in range(6))
    lines = [common + " " + " ".join(f"w{r.randrange(10**6)}" for _ in range(30)) for _ in range(400)]
    near = [x + " end" for x in lines]
    table = spark.createDataFrame(list(enumerate(lines)) + [(1000 + k, near[k * 7 % 400]) for k in range(400)], "doc_id long, text string")
    texts, _, _ = line_dedup._texts(table)
    shingles = line_dedup._postings(texts, line_dedup.equal_lines(texts), line_dedup.rarity(texts), 4, 5).withColumn("token", F.lit(line_dedup.LAST_CLASS).cast("long") * (1 << 56))
    lists, _ = line_dedup._lists(shingles.where("pos = 0"))
    rows = lists.collect()
    assert len(rows) == 800 and sum(not x.later for x in rows) == 1 and {x.f.nid for x in rows} == {0}
    got = {x.doc_id: x.text for x in line_dedup.report(table).collect()}
    assert all(got[i] == lines[i] for i in range(400)) and all(got[1000 + k] == "" for k in range(400))


def test_rarity_classes_need_no_lambdas(spark, monkeypatch):
    """Shingles are counted as rows; a token is its shingle's hash, with the class of the counted bucket in the upper 8 bits."""
    rows = [(i, f"a common passage of six words n{i} n{i + 1} n{i + 2}") for i in range(50)] + [(50, "short"), (51, "")]
    texts, _, _ = line_dedup._texts(spark.createDataFrame(rows, "doc_id long, text string"))
    hashes = {r.no: r.h for r in line_dedup._lines(texts).select(F.col("nid").alias("no"), line_dedup._shingles(F.col("line")).alias("h")).collect()}
    with monkeypatch.context() as m:
        m.setattr(line_dedup, "_shingles", None)
        classes = line_dedup.rarity(texts)
    counts = Counter((h >> 48) & 0xFFFF for of in hashes.values() for h in of)
    top = {b: min(line_dedup.LAST_CLASS, max(0, 32 + round(16 * float(np.log2(c / max(1.0, sum(counts.values()) / 65536)))))) for b, c in counts.items()}
    got = {r.nid: r.t for r in line_dedup._lines(texts).select("nid", line_dedup._tokens(F.col("line"), classes).alias("t")).collect()}
    low = (1 << 56) - 1
    assert got == {d: [top[(h >> 48) & 0xFFFF] << 56 | h & low for h in of] for d, of in hashes.items()}
    assert len(got) == 51 and max(t >> 56 for t in got[7]) > min(t >> 56 for t in got[7]) == 32


def test_pairs_are_verified_over_one_shuffle_of_the_sets(spark, monkeypatch, capsys):
    monkeypatch.setattr(line_dedup, "small", lambda df: df)
    texts = spark.createDataFrame([(i, 0, " ".join(f"w{i // 2}x{k}" for k in range(40)) + " end" * (i % 2)) for i in range(20)], "nid long, th long, text string")
    postings = texts.select("nid", "th", F.lit(0).alias("no"))
    sets = line_dedup._sets(texts, postings)
    pairs = line_dedup.save(postings.where("nid % 2 = 1").select("*", (F.col("nid") - 1).alias("e_nid"), F.col("th").alias("e_th"), F.col("no").alias("e_no")), "pairs")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        late = line_dedup._verified(pairs, sets, 4, 5)
        late.explain()
        assert {r.nid for r in late.collect()} == set(range(1, 20, 2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "ReusedExchange" in capsys.readouterr().out


def test_mix_takes_near_the_target(docs):
    rows = mixing.report(docs).collect()
    by_source: dict[float, list] = {}
    for r in rows:
        by_source.setdefault((r.source_size, r.target), []).append(r)
        assert r.taken <= 2 * r.size
    total = sum(s for s, _ in by_source)
    assert abs(sum(t for _, t in by_source) - 1.5 * total) < 1e-6
    for (size, target), of in by_source.items():
        assert target <= 2 * size and abs(sum(r.taken for r in of) - target) <= 2 * max(r["size"] for r in of)
    copies = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert all(copies[r.doc_id] * r["size"] == r.taken for r in rows)


def test_warc_round_trip_and_lookup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    body = "<p>" + "long enough " * 100
    pages = [(i, f"http://www.site{i % 9}.example.org/p/{i % 40}?q={i}", body if i % 5 == 0 else f"<p>{i} é" * (i + 1)) for i in range(120)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    captures = warc.write_archives(table, f"{tmp_path}/warc")
    index = warc.build_index(captures, f"{tmp_path}/cdx")
    got = {r.page_id: r for r in warc.read_records(warc.places(table, index), f"{tmp_path}/warc", 3).collect()}
    assert len(got) == 120
    for i, url, html in pages:
        r = got[i]
        again = i % 5 == 0 and i != 115
        assert (r.url, r.payload_bytes, r.record_type, r.refers_to) == (url, len(html.encode()), "revisit" if again else "response", 115 if again else None)
        assert r.payload_digest == hashlib.sha1(html.encode()).hexdigest() and (r.payload is None) == again and (again or bytes(r.payload) == html.encode())
    urls = spark.createDataFrame([(pages[i][1],) for i in range(0, 120, 10)] + [("http://nowhere.example/",)], "url string")
    assert {r.page_id for r in warc.lookup(spark, index, f"{tmp_path}/warc", urls).collect()} == set(range(0, 120, 10))


def test_surt_sorts_hosts_together():
    assert warc.surt("HTTP://Blog.Example.com:8080/A?b=c#d") == "com,example,blog:8080)/A?b=c"
    assert warc.surt("http://example.com") == "com,example)/" and warc.surt(None) == ""


def test_broadcast_bound_does_not_change_results(docs, monkeypatch):
    from shelfcost.llm import store

    want = sorted((r.doc_id, r.n_removed) for r in line_dedup.report(docs).collect())
    monkeypatch.setattr(store.small, "__defaults__", (0,))
    assert sorted((r.doc_id, r.n_removed) for r in line_dedup.report(docs).collect()) == want


def test_a_very_common_address_is_found_in_all_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    rows = [(i, "http://a.b/common" if i % 3 else f"http://a.b/{i}", f"<p>{i}") for i in range(300)] + [(500, None, "x"), (None, "http://a.b/common", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if there were enough for several parts
    try:
        captures = warc.write_archives(pages, f"{tmp_path}/warc")
        index = warc.build_index(captures, f"{tmp_path}/cdx")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(index.parts) > 1
    found = warc.places(pages, index).collect()
    assert len(found) == len({(r.file, r.offset) for r in found}) == len(rows)
    assert sorted(-1 if r.page_id is None else r.page_id for r in warc.report(pages).collect()) == sorted(-1 if i is None else i for i, _, _ in rows)


def test_mixing_agrees_where_rows_share_an_id(spark):
    rows = [(1, f"a{i} b{i} c{i}", "s") for i in range(40)] + [(2, f"x{i} y z", None) for i in range(40)] + [(i, "w " * i, "t") for i in range(3, 30)]
    mixes = []
    for seed in range(3):
        docs = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "doc_id long, text string, source string").repartition(seed + 2)
        mixes.append(Counter(map(tuple, mixing.mix(docs).collect())))
    assert mixes[0] == mixes[1] == mixes[2] and sum(mixes[0].values()) > 0
