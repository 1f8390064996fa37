"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import hashlib
import time
from collections import Counter

import pytest

import corpus_pipeline
from shelfcost.llm import decontam, html_extract, line_dedup, mixing, quality_model, quality_rules, simhash, substring_dedup, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
LONG = " ".join(f"word{i % 977}" for i in range(200_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", "en", "a", 5),
    (4, "one", "en", "b", 3),
    (5, "one", "en", "b", 3),
    (5, "one", "en", "b", 3),
    (6, LONG, "en", "b", len(LONG)),
    (None, "a text without an id, with some words", "en", "c", 37),
    (None, None, None, "c", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, None), (None, 1, 1), (6, None, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, "short"), (3, "word1 word2 word3 word4 word5 word6 word7 word8")], "item_id long, text string")


def test_every_document_operator_keeps_every_row(docs, labels, benchmark):
    n = len(ROWS)
    for report in (
        simhash.report(docs),
        decontam.report(docs, benchmark),
        toxicity.report(docs, labels),
        quality_model.report(docs, labels),
        substring_dedup.report(docs),
        mixing.report(docs),
        line_dedup.report(docs),
        quality_rules.report(docs),
    ):
        assert report.count() >= n  # rows repeated under one id may meet each other, none is lost
        assert {r.doc_id for r in report.collect()} == {r[0] for r in ROWS}


def test_empty_tables(spark, empty, labels, benchmark):
    none = spark.createDataFrame([], labels.schema)
    for report in (
        simhash.report(empty),
        decontam.report(empty, benchmark),
        toxicity.report(empty, none),
        quality_model.report(empty, none),
        substring_dedup.report(empty),
        mixing.report(empty),
        line_dedup.report(empty),
        quality_rules.report(empty),
    ):
        assert report.collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.report(pages).collect() == [] and warc.report(pages).collect() == []
    assert decontam.clean(empty, spark.createDataFrame([], benchmark.schema)).collect() == []


def test_scores_without_labels_are_the_base_rate(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for report in (toxicity.report(docs, none), quality_model.report(docs, none)):
        assert {(r.score, r.predicted) for r in report.collect()} == {(0.5, 1)}


def test_simhash_of_texts_without_words_is_zero(docs):
    by_id = {}
    for r in simhash.report(docs).collect():
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    zero = ("0" * 16, 1)
    assert by_id[1] == by_id[2] == by_id[3] == {zero} and zero in by_id[None]
    assert {c for _, c in by_id[4] | by_id[5]} == {4}


def test_keep_one_names_rows_by_id_and_text(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a, "x"), (None, a, "x"), (None, b, "x"), (2, a, "x"), (2, c, "x"), (None, d, "x"), (None, d, "y"), (None, d, "x"), (None, None, "x"), (7, "", "x"), (8, d + " e", "x"), (8, d + " e", "x")]
    got = Counter((r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert got == Counter({(1, a): 1, (None, b): 1, (2, c): 1, (None, d): 1, (7, ""): 1, (8, d + " e"): 2})


def test_line_dedup_names_rows_by_id_and_text(spark):
    line = [" ".join(f"{x}{i}" for i in range(12)) for x in "abcdefghi"]
    rows = [(None, [0, 1]), (None, [2, 0]), (None, [3, 4]), (None, [0, 5]), (4, [6, 7]), (4, [8, 7]), (4, [8, 7]), (5, [6, 5, 1])]
    texts = ["\n".join(line[k] for k in at) for _, at in rows]
    docs = spark.createDataFrame([(i, t) for (i, _), t in zip(rows, texts)], "doc_id long, text string")
    got = [(r.doc_id, r.n_lines, r.n_removed, r.text) for r in line_dedup.report(docs).collect()]
    assert len(got) == len(rows) and [sum(n for _, n, _, _ in got), sum(1 for g in got if not g[3])] == [17, 1]
    kept = Counter(x for g in set(got) for x in g[3].split("\n") if x)
    assert kept == Counter(line)  # every line stays in one document, whichever row of an id comes first


def test_pipeline_stages_keep_the_columns_of_documents(spark, docs, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_clashing_column_names_are_carried(spark, benchmark):
    clash = "n_words long, size string, target string, copies string, fp string, node string, gone string, nid string, raw string, th string, key string, line string, label string, tokens string, token string"
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(80)), "en", "s", 1, 7, *["x"] * 14) for i in range(3)]
    d = spark.createDataFrame(rows, f"{SCHEMA}, {clash}")
    text = {r[1] for r in rows}
    for out in (quality_rules.apply_policy(d), line_dedup.dedup_lines(d).select(*d.columns), simhash.keep_one(d), decontam.clean(d, benchmark), mixing.mix(d), substring_dedup.cleaned(d).select(*d.columns)):
        assert out.columns == d.columns
        got = out.distinct().collect()
        assert {r.text for r in got} == text and {(r.n_words, r["size"], r.tokens) for r in got} == {(7, "x", "x")}


def test_null_and_empty_pages(spark):
    rows = [(1, None, None), (2, "http://a.b/c", ""), (3, "not a url", "<p>x"), (4, "http://[bad", "<html>"), (None, None, "<p>y</p>"), (3, "not a url", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.report(pages).collect()) == [(0, "y", 1), (1, "", 0), (2, "", 0), (3, "x", 1), (3, "x", 1), (4, "", 0)]
    found = warc.report(pages).collect()
    assert sorted((r.page_id or 0, r.payload_digest, r.record_type) for r in found) == sorted((p or 0, hashlib.sha1((h or "").encode()).hexdigest(), "response") for p, _, h in rows)


def _seconds(page: str) -> float:
    start = time.process_time()
    html_extract.extract(page)
    return time.process_time() - start


@pytest.mark.parametrize(
    "unit",
    ["<div class='comment'>hello</div>", "<div>x</i></em></section>", "<article>x", "<section>x y", "<b><p>x</b>", "<p>x<!--", "<p>x<![CDATA[ ", "<?x", "<p a "],
)
def test_extraction_takes_linear_time(unit):
    few, many = _seconds(unit * 4_000), _seconds(unit * 32_000)
    assert many < 24 * few + 1  # 8 times the page; a quadratic step takes 64 times as long


def test_long_marked_and_badly_nested_pages():
    article = "<article><p>" + "some words of the article " * 40 + "</p></article>"
    text = " ".join(("some words of the article " * 40).split())
    comments = "".join(f"<div class='comment c{i}'>I agree {i}</div>" for i in range(100_000))
    assert html_extract.extract(article + comments) == text
    nested = "<div>" * 100_000 + article + "</i></em></span>" * 100_000
    assert html_extract.extract(nested) == text
    sections = "<section>" * 50_000 + "<p>" + text + "</p>" + "</section>" * 50_000
    assert html_extract.extract(sections) == text


def test_decontamination_in_blocks_equals_one_block(spark, docs, monkeypatch):
    items = [(i, " ".join(f"word{i + k}" for k in range(9))) for i in range(40)] + [(7, "one"), (None, "with some words"), (50, "no such words here"), (51, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def rows():
        return Counter((r.doc_id, r.text, r.source, tuple(sorted({(h.item_id or -1, h.distance) for h in r["__dec_hits"]}))) for r in decontam.matches(docs, benchmark).collect())

    whole = rows()
    kept = Counter(decontam.clean(docs, benchmark).collect())
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 300)
    assert len(list(decontam.blocks(benchmark))) > 5
    assert rows() == whole and sum(whole.values()) == len(ROWS)
    assert decontam.matches(docs, benchmark).columns == [*docs.columns, "__dec_hits"]
    assert Counter(decontam.clean(docs, benchmark).collect()) == kept and sum(kept.values()) < len(ROWS)
