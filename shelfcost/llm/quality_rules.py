"""Quality rules as a bitmask ledger.

Every document is measured once. Each rule compares one ratio of the measurements with a
bound; the rules that a document fails are the set bits of one long. The ledger keeps
the bits and the measurements, so that a policy (a named, versioned mask of the rules that
count) is applied afterwards with one bitwise ``and``, without reading a text again, and
ablations (how many more documents each rule rejects by itself, or would be kept without
it) come from one aggregation over the masks.

``n_upper`` counts the upper-case letters of every script, ``n_lower`` all other letters, those without case included.

Defined cases: a null or empty text has zero of everything and fails ``too_short``; repeated
rows are measured one by one; other columns, whatever their names, are carried unchanged
except that columns named like the ledger's own (``MEASURES``, ``failed_bits``) are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcost.llm.text import WORD_RE

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower")
_SYMBOLS, _UPPER, _LOWER = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]")


def _cased(text: str) -> tuple[int, int]:
    """The letters in upper case, and all other letters."""
    raw = text.encode("ascii", "ignore")
    upper, lower = (len(raw) - len(raw.translate(None, chars)) for chars in (_UPPER, _LOWER))
    if len(raw) < len(text):
        for c, n in Counter(_BEYOND_ASCII.findall(text)).items():
            if c.isalpha():
                if c.isupper():
                    upper += n
                else:
                    lower += n
    return upper, lower


def _repeated(words: list[str]) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pair = ids[:-1] * len(number) + ids[1:]
    _, pair = np.unique(pair, return_inverse=True)  # below n, so the next product fits
    _, window, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= twice
    return int(hit.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one text."""
    if not text:
        return (0,) * len(MEASURES)
    words = WORD_RE.findall(text)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if WORD_RE.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    raw = text.encode("utf-8", "replace")
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return len(words), sum(map(len, words)), symbols, dup, _repeated(words), lines, *_cased(text)


@F.pandas_udf(StructType([StructField(m, LongType()) for m in MEASURES]))
def _measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure_text(t) for t in batch], columns=list(MEASURES), dtype="int64")


@dataclass(frozen=True)
class Rule:
    """A document fails if ``failed`` holds; the bit is the rule's place in the rule list and never changes."""

    name: str
    failed: Column


def rules() -> list[Rule]:
    """The rules by bit. New rules go to the end, so that old ledgers keep their meaning."""
    n, c = F.col("n_words"), F.col
    return [
        Rule("too_short", n < 50),
        Rule("repeated_words", 100 * c("n_repeat_words") > 50 * n),
        Rule("symbols", 100 * c("n_symbols") > 30 * n),
        Rule("duplicate_lines", 100 * c("n_dup_lines") > 50 * c("n_lines")),
        Rule("long_words", c("word_chars") > 20 * n),
        Rule("short_words", c("word_chars") < 2 * n),
        Rule("shouting", c("n_upper") > c("n_lower")),
    ]


def mask(*names: str) -> int:
    """The bits of the named rules."""
    place = {"too_short": 0, "repeated_words": 1, "symbols": 2, "duplicate_lines": 3, "long_words": 4, "short_words": 5, "shouting": 6}
    return sum(1 << place[n] for n in names)


BASE = mask("too_short", "repeated_words")
#: Versioned policies: the rules that reject. A version is never edited, only followed by another.
POLICIES = {
    "base@1": BASE,
    "web@1": BASE | mask("symbols", "duplicate_lines", "long_words", "short_words"),
    "web@2": BASE | mask("symbols", "duplicate_lines", "long_words", "short_words", "shouting"),
}
CURRENT = "web@2"


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``; one narrow pass over the texts, no shuffle."""
    own = {*MEASURES, "failed_bits"}
    carried = [c for c in docs.columns if c not in own]
    measured = docs.select(*carried, _measured(F.col("text")).alias("__rules_m"))
    table = measured.select(*carried, *(F.col(f"__rules_m.{m}").alias(m) for m in MEASURES))
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules()):
        bits = bits.bitwiseOR(F.when(rule.failed, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return table.withColumn("failed_bits", bits)


def kept(policy: str = CURRENT, bits: Column | None = None) -> Column:
    """True for documents that ``policy`` keeps."""
    bits = F.col("failed_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(POLICIES[policy])) == 0


def apply_policy(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that ``policy`` keeps, with the columns of ``docs``."""
    packed = docs.select(F.struct(*docs.columns).alias("__rules_row"), F.col("text"))
    return ledger(packed).where(kept(policy)).select("__rules_row.*")


def ablation(led: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of ``policy``: documents that fail it, that fail it alone (kept without it), and all documents.

    One aggregation over the masks: bits are combined per document, counts per rule.
    """
    m = POLICIES[policy]
    bits = F.col("failed_bits").bitwiseAND(F.lit(m))
    counts = [F.count(F.lit(1)).alias("documents")]
    active = [(i, r) for i, r in enumerate(rules()) if m >> i & 1]
    for i, r in active:
        counts.append(F.count_if(bits.bitwiseAND(F.lit(1 << i)) != 0).alias(f"f{i}"))
        counts.append(F.count_if(bits == (1 << i)).alias(f"a{i}"))
    one = led.agg(*counts)
    rows = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"a{i}").alias("failed_alone"), F.col("documents")) for i, r in active))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def report(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per document: doc_id, the measurements, base_failed, kept, failed_bits."""
    led = ledger(docs.select("doc_id", "text"))
    base = F.col("failed_bits").bitwiseAND(F.lit(BASE)) != 0
    return led.select("doc_id", *MEASURES[:5], base.alias("base_failed"), kept(policy).alias("kept"), "failed_bits")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM twice CROSS JOIN range(3) r(k)) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    len(regexp_extract_all(text, '\p{Lu}')) AS up, len(regexp_extract_all(text, '\p{L}')) - len(regexp_extract_all(text, '\p{Lu}')) AS low
  FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)
), b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (100 * n_symbols > 30 * n_words)::BIGINT
    + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (word_chars > 20 * n_words)::BIGINT + 32 * (word_chars < 2 * n_words)::BIGINT + 64 * (up > low)::BIGINT AS failed_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""
