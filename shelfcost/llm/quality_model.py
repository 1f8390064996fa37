"""Quality classifier: a sparse rule ensemble.

Each text is measured once (counts of words, characters, symbols, repeats, lines) and described by ratios of the counts.
A forest of shallow trees is fitted on the labelled rows; every path from a root to a node is a rule, a
conjunction of comparisons on the ratios. A lasso logistic regression over the rules keeps a few of them, and the kept
rules are compiled into one Spark column expression: the score of a row needs no model object.

The fit is Spark's own, over all labelled rows given; what comes to the driver is the trees and weights, whose number
is set by ``TREES`` and ``DEPTH``.

Defined cases: a null or empty text has all counts zero and a score like any other; without labelled rows of both classes
the score is the share of label 1 (0.5 without any); repeated texts are scored one by one; of several labels of one
document the largest counts; null labels and ids are not learned from; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcost.llm.quality_rules import MEASURES, measure_text
from shelfcost.llm.store import drop, save
from shelfcost.llm.text import WORD_RE

TREES, DEPTH, LASSO, SEED = 20, 3, 0.002, 11
MORE = ("n_chars_all", "n_distinct", "n_digits", "n_stops", "n_other", "run")
_DIGITS, _STOPS = b"0123456789", b".,;:!?"
_PLAIN = bytes(range(128))


def _counts(text: str | None) -> tuple[int, ...]:
    base = measure_text(text)
    if not text:
        return base + (0,) * len(MORE)
    words = WORD_RE.findall(text)
    raw = text.encode("utf-8", "replace")
    digits, stops = (len(raw) - len(raw.translate(None, chars)) for chars in (_DIGITS, _STOPS))
    best = here = 0
    last = None
    for w in words:
        here = here + 1 if w == last else 1
        last = w
        if here > best:
            best = here
    return base + (len(text), len(set(words)), digits, stops, len(raw.translate(None, _PLAIN)), best)


@F.pandas_udf(StructType([StructField(m, LongType()) for m in (*MEASURES, *MORE)]))
def _measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([_counts(t) for t in batch], columns=[*MEASURES, *MORE], dtype="int64")


def ratios() -> dict[str, Column]:
    """The statistics that rules compare, as expressions over the counts."""
    c = F.col
    words, chars, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_chars_all"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    return {
        "words": F.log1p(c("n_words")),
        "word_length": c("word_chars") / words,
        "symbols": c("n_symbols") / words,
        "duplicate_lines": c("n_dup_lines") / lines,
        "repeated": c("n_repeat_words") / words,
        "distinct": c("n_distinct") / words,
        "line_words": c("n_words") / lines,
        "upper": c("n_upper") / F.greatest(c("n_upper") + c("n_lower"), F.lit(1)),
        "digits": c("n_digits") / chars,
        "stops": c("n_stops") / words,
        "other_letters": c("n_other") / chars,
        "longest_run": c("run") / words,
    }


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the ratios of every text; one narrow pass."""
    counted = docs.select("doc_id", _measured(F.col("text")).alias("m")).select("doc_id", "m.*")
    return counted.select("doc_id", *(e.cast("double").alias(k) for k, e in ratios().items()))


Path = tuple[tuple[str, bool, float], ...]  # (statistic, at most, bound) each


def _paths(node, names: list[str], above: Path = ()) -> Iterator[Path]:
    """The rules of one tree: the conjunction that leads to each node below the root."""
    if above:
        yield above
    if node.subtreeDepth() > 0:
        split = node.split()
        name, bound = names[split.featureIndex()], split.threshold()
        yield from _paths(node.leftChild(), names, (*above, (name, True, bound)))
        yield from _paths(node.rightChild(), names, (*above, (name, False, bound)))


def _condition(path: Path) -> Column:
    out = F.lit(True)
    for name, at_most, bound in path:
        out = out & (F.col(name) <= bound if at_most else F.col(name) > bound)
    return out


def fit(train: DataFrame) -> tuple[float, list[tuple[Path, float]]]:
    """(intercept, the kept rules with their weights) from rows with the statistics and ``label`` 0 or 1."""
    n, ones = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
        return float(_logit(share)), []
    names = list(ratios())
    data = VectorAssembler(inputCols=names, outputCol="__x").transform(train.withColumn("label", F.col("label").cast("double"))).cache()
    forest = RandomForestClassifier(featuresCol="__x", numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64).fit(data)
    found = sorted({p for tree in forest.trees for p in _paths(tree._call_java("rootNode"), names)}, key=lambda p: (len(p), p))
    rules = data.select("label", F.array(*(_condition(p).cast("double") for p in found)).alias("r"))
    rules = rules.select("label", array_to_vector("r").alias("r")).cache()
    lasso = LogisticRegression(featuresCol="r", regParam=LASSO, elasticNetParam=1.0, maxIter=40, standardization=False).fit(rules)
    data.unpersist()
    rules.unpersist()
    return float(lasso.intercept), [(p, float(w)) for p, w in zip(found, lasso.coefficients) if w]


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def compiled(intercept: float, rules: list[tuple[Path, float]]) -> Column:
    """The score (0 to 1) as one expression over the statistics."""
    z = F.lit(intercept)
    for path, weight in rules:
        z = z + F.when(_condition(path), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label), each document once."""
    return labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Learned from labelled rows outside fold 0 of 5."""
    stats = save(statistics(docs.select("doc_id", "text")), "statistics")
    train = save(stats.join(labelled(labels, "quality"), "doc_id").where(fold(F.col("doc_id"), 5) != 0), "labelled")
    score = compiled(*fit(train))
    drop(train)
    out = stats.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
