"""The pipeline against a plain restatement of its stages, and the SQL of the operators that have one."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from shelfcost.llm import decontam, queries, quality_rules

from .test_brute import WORD, _distance, _fingerprint, _roots

SF = "/root/testdata/sf0.001"


def _passes(text: str) -> bool:
    m = dict(zip(quality_rules.MEASURES, quality_rules.measure_text(text)))
    n = m["n_words"]
    return not (
        n < 50 or 100 * m["n_repeat_words"] > 50 * n or 100 * m["n_symbols"] > 30 * n or 100 * m["n_dup_lines"] > 50 * m["n_lines"]
        or m["word_chars"] > 20 * n or m["word_chars"] < 2 * n or m["n_upper"] > m["n_lower"]
    )


def _without_similar_lines(docs: list[tuple]) -> list[tuple]:
    earlier: list[frozenset] = []
    out = []
    for i, text, source in docs:
        left = []
        for line in text.split("\n"):
            w = WORD.findall(line)
            if w:
                s = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
                gone = any(9 * len(s & e) >= 4 * (len(s) + len(e)) for e in earlier)
                earlier.append(s)
                if gone:
                    continue
            left.append(line)
        out.append((i, "\n".join(left), source))
    return out


def _one_of_each(docs: list[tuple]) -> list[tuple]:
    fps = [_fingerprint(t) for _, t, _ in docs]
    links = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    return [d for k, (d, root) in enumerate(zip(docs, _roots(len(docs), links))) if k == root]


def _copies(docs: list[tuple]) -> Counter:
    size = {i: len(WORD.findall(t)) for i, t, _ in docs}
    sources = sorted({s for _, _, s in docs})
    of = {s: sum(size[i] for i, _, x in docs if x == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    target, free = {}, set(sources)
    left = 1.5 * sum(of.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * of[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2 * of[s] for s in over}
        left -= sum(2 * of[s] for s in over)
        free -= over
    out: Counter = Counter()
    for s in sources:
        rate, offset = target[s] / of[s], int(hashlib.md5(s.encode()).hexdigest()[:8], 16) / 2**32
        ids = sorted((i for i, _, x in docs if x == s), key=lambda i: (size[i], hashlib.md5(str(i).encode()).hexdigest()))
        for k, i in enumerate(ids, 1):
            out[i] = math.floor(offset + k * rate) - math.floor(offset + (k - 1) * rate)
    return +out


def test_run_against_brute_force(spark, tmp_path):
    r = random.Random(12)
    vocabulary = ["".join(r.choice("abcdefghik") for _ in range(r.randint(2, 8))) for _ in range(500)]
    sentence = lambda k: " ".join(r.choices(vocabulary, k=k))
    items = [(i, sentence(14)) for i in range(4)]
    common = [sentence(20) for _ in range(5)]
    texts: list[str] = []
    for k in range(90):
        body = [sentence(r.randint(10, 40)) for _ in range(r.randint(3, 5))]
        if k % 4 == 1:
            body.insert(1, r.choice(common))
        if k % 6 == 2:
            body.append(sentence(6) + " " + r.choice(items)[1].upper() + "; " + sentence(6))
        if k % 7 == 3:
            body = [w + "###" for w in body[0].split()]
        if k % 10 == 5:
            w = texts[k - 3].split(" ")
            w[r.randrange(len(w))] = "changed"
            body = [" ".join(w)]
        texts.append("\n".join(body))
    rows = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = [(i, t, s) for i, t, _, s, _ in rows if _passes(t)]
    assert len(docs) < len(rows)
    docs = _one_of_each(_without_similar_lines(docs))
    plain = [(t, int(len(t) * decontam.BUDGET)) for t in (decontam.normalised(t) for _, t in items)]
    clean = [d for d in docs if all(_distance(p, decontam.normalised(d[1])) > k for p, k in plain)]
    assert len(clean) < len(docs)
    got = Counter((x.doc_id, x.text) for x in corpus_pipeline.run(spark, str(tmp_path)).collect())
    text = {i: t for i, t, _ in clean}
    assert got == Counter({(i, text[i]): n for i, n in _copies(clean).items()})


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.fetchall())
