"""Toxicity by class-conditional Kneser-Ney models.

A word is read letter by letter, with its real letters: the probability of a letter depends on up to ``ORDER - 1`` letters before it,
the beginning of the word included, so that whole toxic words and the stems of those with many endings are known as
such. For each class an interpolated Kneser-Ney model gives that probability: the class's own counts, discounted, and for
the mass so freed shorter grams that both classes share. These are continuation counts of the whole corpus, labelled or not: by
how many different longer grams a gram is continued to the left, over the lengths of ``SHORTER``. Rare expressions therefore weigh the same
in both classes, and only what the labels really show tells them apart.

A document is scored by its log-likelihood under the toxic model less that under the ordinary one, normalised by length:
over the whole text, and over its most toxic words, so that a few words in a long text still show. A logistic
regression turns these into a probability; it is fitted on the labelled rows, each scored by models that were counted without
the row's own fold.

Work and bounds: one pass counts the words by class and fold; grams, continuation counts, totals by context and log ratios are grouped
Spark tables that grow with the corpus's vocabulary. The ratios are written, sorted by the 64-bit hash of the gram, as shards of
``SHARD`` grams to the shared folder; a second pass over the texts looks up the grams of words that a task has not met, shard by
shard, so no task holds the model. Grams whose ratio is zero, those in contexts that no labelled row has, need no entry. The driver holds one row per
shard and the fitted weights.

Defined cases: words are runs of letters, in lower case, cut every ``LONGEST`` letters; a null text, or one without words, has
all features zero and a score like any other; without labelled rows of both
classes the score is the share of label 1 (0.5 without any); of several labels of one document the largest
counts; null labels and ids are not learned from; repeated rows count each time; other columns are ignored.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections import Counter, OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcost.llm.quality_model import fold, labelled
from shelfcost.llm.store import drop, drop_path, new_path, open_fs, save, small

ORDER = 8
SHORTER = (5, 3, 1)  # lengths of the shared grams
DISCOUNT = 0.75
LONGEST = 32
FOLDS, HELD_OUT = 4, 2
PARTS = (0, 1, 3)  # the folds that labels are learned from
REST = 2 * len(PARTS)  # the row of counts of documents that are not learned from
MODELS = len(PARTS) + 1  # one without each of the PARTS, and the full one
FEATURES = ("mean", "top1", "top2", "top3", "over2", "over4", "over6", "share4")
SHARD = 1 << 20
CACHE_BYTES = 96 << 20
HELD = 300_000  # different words that a task counts before it passes them on
KNOWN = 1 << 19  # words whose ratios a worker keeps, about 200 bytes each
SLICE = 2 << 20
_LETTERS = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: runs of letters, in lower case, cut every LONGEST letters."""
    text = (text or "").lower()
    for c in set(text):
        if c > "\x7f" and not c.isalpha():
            text = text.replace(c, " ")
    words = text.encode("utf-8", "replace").translate(_LETTERS).split()
    if words and max(map(len, words)) > LONGEST:
        long = (w.decode() for w in words)
        words = [w[at : at + LONGEST].encode() for w in long for at in range(0, len(w), LONGEST)]
    return words


def word_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, c0 ... c6): occurrences by fold and class of the labelled rows (2 * the fold's place + label), and in all other documents."""
    own = F.array_position(F.array(*map(F.lit, PARTS)), fold(F.col("doc_id"), FOLDS)).cast("int")
    known = save(labels.select("doc_id", (2 * (own - 1) + F.col("label")).alias("row")), "labels")
    rows = docs.select("doc_id", "text").join(small(known), "doc_id", "left").select("text", F.coalesce("row", F.lit(REST)).alias("row"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, Counter] = {}

        def frames() -> Iterator[pd.DataFrame]:
            for row, c in found.items():
                if not c:
                    continue
                yield pd.DataFrame({"row": np.int32(row), "word": list(map(bytes.decode, c)), "n": np.fromiter(c.values(), np.int64, len(c))})
            found.clear()

        for batch in batches:
            for row, text in zip(batch["row"], batch["text"]):
                found.setdefault(row, Counter()).update(words_of(text))
                if sum(map(len, found.values())) > HELD:
                    yield from frames()
        yield from frames()

    found = rows.mapInPandas(count, "row int, word string, n long")
    return found.groupBy("word").agg(*(F.sum(F.when(F.col("row") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(REST + 1)))


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, c0 ... c6): the last letter of a gram after the others; a space stands at the beginning and the end of a word."""
    spaced = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    each = F.transform(F.sequence(F.lit(2), F.length("s")), lambda i: F.substring(F.col("s"), F.greatest(i - (ORDER - 1), F.lit(1)), F.least(i, F.lit(ORDER))))
    counts = [f"c{k}" for k in range(REST + 1)]
    return words.select(spaced.alias("s"), *counts).select(F.explode(each).alias("gram"), *counts).groupBy("gram").agg(*(F.sum(c).alias(c) for c in counts))


def _shorter(gram: Column) -> Column:
    """The gram that a gram backs off to: its last letters, the next of SHORTER."""
    n = F.length(gram)
    out = F.right(gram, F.lit(SHORTER[-1]))
    for k in reversed(SHORTER[:-1]):
        out = F.when(n > k, F.right(gram, F.lit(k))).otherwise(out)
    return out


def _context(gram: Column) -> Column:
    return F.substring(gram, F.lit(1), F.length(gram) - 1)


def shared_model(grams: DataFrame) -> DataFrame:
    """(gram, p): the last letter's probability after the others, of all shorter grams, by continuation counts. Saved."""
    above = grams.select("gram")
    levels = []
    for k, least in zip(SHORTER, (*SHORTER[1:], 0)):
        longer = above.where(F.length("gram") > k)
        level = save(longer.groupBy(_shorter(F.col("gram")).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "shared")
        levels.append(level)
        above = above.where(F.length("gram") <= k).unionByName(level.select("gram"))
    total = levels[-1].agg(F.sum("n")).first()[0] or 1
    p = levels[-1].select("gram", (F.col("n") / total).alias("p"))
    out = p
    for level in reversed(levels[:-1]):
        same = Window.partitionBy(_context(F.col("gram")))
        level = level.select("gram", "n", F.sum("n").over(same).alias("total"), F.count(F.lit(1)).over(same).alias("kinds"), _shorter(F.col("gram")).alias("low"))
        level = level.join(p.select(F.col("gram").alias("low"), F.col("p").alias("lower")), "low")
        p = level.select("gram", ((F.greatest(F.col("n") - DISCOUNT, F.lit(0)) + DISCOUNT * F.col("kinds") * F.col("lower")) / F.col("total")).alias("p"))
        out = out.unionByName(p)
    out = save(out, "shared")
    for level in levels:
        drop(level)
    return out


def log_ratios(grams: DataFrame, shared: DataFrame) -> DataFrame:
    """(gram, l0 ... l3): by model, the log of the last letter's probability under the toxic class less that under the ordinary one."""
    g = grams.withColumn("low", _shorter(F.col("gram"))).join(shared.select(F.col("gram").alias("low"), "p"), "low")
    same = Window.partitionBy("context")
    sums = {}
    for m in range(MODELS):
        for label in (0, 1):
            sums[m, label] = sum((F.col(f"c{2 * k + label}") for k in range(len(PARTS)) if k != m), F.lit(0))
    g = g.select("gram", "p", _context(F.col("gram")).alias("context"), *(c.alias(f"n{m}{label}") for (m, label), c in sums.items()))
    totals = [f(c).over(same).alias(f"{t}{m}{label}") for m, label in sums for t, f, c in (("t", F.sum, F.col(f"n{m}{label}")), ("k", F.count_if, F.col(f"n{m}{label}") > 0))]
    g = g.select("*", *totals)

    def probability(m: int, label: int) -> Column:
        n, t, kinds = (F.col(f"{x}{m}{label}") for x in "ntk")
        return F.when(t > 0, (F.greatest(n - DISCOUNT, F.lit(0)) + DISCOUNT * kinds * F.col("p")) / t).otherwise(F.col("p"))

    return g.select("gram", *(F.log(probability(m, 1) / probability(m, 0)).alias(f"l{m}") for m in range(MODELS)))


class Ratios:
    """Shards of (hash of gram, ratios by model), sorted by hash."""

    def __init__(self, folder: str, shards: Sequence[tuple[int, int, str]]):
        """``shards``: (first hash, number of grams, file)."""
        self.folder = folder
        self.shards = sorted(shards)
        self.firsts = [s[0] for s in self.shards]

    def _read(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        _, n, name = self.shards[k]
        key = f"{self.folder}/{name}"
        if key not in _shards:
            fs, path = open_fs(self.folder)
            with fs.open_input_file(f"{path}/{name}") as f:
                data = f.readall()
            _shards[key] = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.float32, offset=8 * n).reshape(n, MODELS)
            while len(_shards) > 1 and sum(a.nbytes + b.nbytes for a, b in _shards.values()) > CACHE_BYTES:
                _shards.popitem(last=False)
        _shards.move_to_end(key)
        return _shards[key]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The ratios of ascending hashes, zero for grams without an entry."""
        out = np.zeros((len(keys), MODELS), np.float32)
        for k in range(len(self.shards)):
            lo = bisect_left(keys, self.firsts[k])
            hi = bisect_left(keys, self.firsts[k + 1]) if k + 1 < len(self.shards) else len(keys)
            if lo < hi:
                held, ratios = self._read(k)
                at = np.minimum(np.searchsorted(held, keys[lo:hi]), len(held) - 1)
                out[lo:hi] = np.where((held[at] == keys[lo:hi])[:, None], ratios[at], 0)
        return out


_shards: OrderedDict[str, tuple[np.ndarray, np.ndarray]] = OrderedDict()


def write_ratios(ratios: DataFrame, folder: str, shard: int = SHARD) -> Ratios:
    """The ratios other than zero as shards in ``folder``."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush(df: pd.DataFrame) -> pd.DataFrame:
            fs, path = open_fs(folder)
            fs.create_dir(path, recursive=True)
            name = uuid.uuid4().hex
            with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(df["key"].to_numpy(np.int64).tobytes())
                out.write(df.drop(columns="key").to_numpy(np.float32).tobytes())
            return pd.DataFrame({"first": [int(df["key"].iloc[0])], "n": [len(df)], "file": [name]})

        for batch in batches:
            if len(batch):
                held.append(batch)
            while sum(map(len, held)) >= shard:
                df = pd.concat(held)
                held = [df.iloc[shard:]] if len(df) > shard else []
                yield flush(df.iloc[:shard])
        if held:
            yield flush(pd.concat(held))

    columns = [f"l{m}" for m in range(MODELS)]
    some = F.greatest(*(F.abs(c) for c in columns)) > 0
    rows = ratios.where(some).select(F.xxhash64("gram").alias("key"), *(F.col(c).cast("float").alias(c) for c in columns))
    found = rows.repartitionByRange("key").sortWithinPartitions("key").mapInPandas(write, "first long, n long, file string").collect()  # one row per shard
    return Ratios(folder, [tuple(r) for r in found])


class _Words:
    """The ratios of words, by model, as packed floats; a bounded number is kept."""

    def __init__(self, ratios: Ratios):
        self.ratios = ratios
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) + len(words) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if not new:
            return
        digest, keys, lengths = xxhash.xxh64_intdigest, [], []
        for w in new:
            before = len(keys)
            if w.isascii():
                s = b" %b " % w
                keys.extend([digest(s[i - ORDER if i > ORDER else 0 : i], 42) for i in range(2, len(s) + 1)])
            else:
                t = f" {w.decode()} "
                keys.extend([digest(t[i - ORDER if i > ORDER else 0 : i].encode(), 42) for i in range(2, len(t) + 1)])
            lengths.append(len(keys) - before)
        hashes = np.array(keys, np.uint64).view(np.int64)
        order = np.argsort(hashes)
        ratios = np.empty((len(hashes), MODELS), np.float32)
        ratios[order] = self.ratios.find(hashes[order])
        data = np.add.reduceat(ratios, np.cumsum(lengths) - lengths, axis=0).astype("<f4").tobytes()
        self.known.update((w, data[4 * MODELS * k : 4 * MODELS * (k + 1)]) for k, w in enumerate(new))


def features(ratios: np.ndarray, size: int) -> tuple[float, ...]:
    """The FEATURES of a text from the ratios of its words: the sum per byte, the most toxic words, and how many there are."""
    n = len(ratios)
    if not n:
        return (0.0,) * len(FEATURES)
    top = np.sort(np.partition(ratios, n - 3)[n - 3 :] if n > 3 else ratios)[::-1]
    top = np.concatenate((top, np.zeros(3)))[:3]
    over = [(ratios > x).sum() for x in (2, 4, 6)]
    return (float(ratios.sum()) / size, *map(float, top), *(float(np.log1p(x)) for x in over), over[1] / n)


def described(docs: DataFrame, ratios: Ratios) -> DataFrame:
    """Per document: doc_id, the features under the full model (f_*), and under the one without the document's own fold (o_*)."""
    place = F.array_position(F.array(*map(F.lit, PARTS)), fold(F.col("doc_id"), FOLDS)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(place > 0, place - 1).otherwise(MODELS - 1).alias("model"))
    columns = [f"{side}_{name}" for side in "fo" for name in FEATURES]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words(ratios)
        for batch in batches:
            texts, models, out = batch["text"].tolist(), batch["model"].tolist(), []
            at = 0
            while at < len(texts):
                to, n, split, new = at, 0, [], set()
                while to < len(texts) and n < SLICE:
                    split.append(words_of(texts[to]))
                    new.update(split[-1])
                    n += len(texts[to] or "")
                    to += 1
                words.learn(new)
                known = words.known
                for w, model in zip(split, models[at:to]):
                    r = np.frombuffer(b"".join(map(known.__getitem__, w)), "<f4").reshape(-1, MODELS)
                    size = sum(map(len, w)) + len(w)
                    full = features(r[:, MODELS - 1], size)
                    out.append((*full, *(full if model == MODELS - 1 else features(r[:, model], size))))
                at = to
            df = pd.DataFrame(out, columns=columns, dtype="float64")
            df.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield df

    return rows.mapInPandas(describe, "doc_id long, " + ", ".join(f"{c} double" for c in columns))


def calibrated(rows: DataFrame, share: float) -> Column:
    """The probability as an expression over the features, from rows with ``label``; ``share`` where these lack a class."""
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        return F.lit(share)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.withColumn("label", F.col("label").cast("double"))).cache()
    model = LogisticRegression(featuresCol="x", regParam=1e-3, maxIter=50).fit(data)
    data.unpersist()
    z = F.lit(float(model.intercept))
    for name, weight in zip(FEATURES, model.coefficients):
        z = z + F.col(name) * F.lit(float(weight))
    return 1 / (1 + F.exp(-z))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Learned from labelled rows outside fold 2 of 4."""
    spark = docs.sparkSession
    known = save(labelled(labels, "toxic").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT), "labels")
    grams = save(gram_counts(word_counts(docs, known)), "grams")
    shared = shared_model(grams)
    folder = new_path(spark, "ratios")
    ratios = write_ratios(log_ratios(grams, shared), folder)
    table = save(described(docs, ratios), "features")
    own = save(table.select("doc_id", *(F.col(f"o_{f}").alias(f) for f in FEATURES)).join(known, "doc_id"), "labelled")
    n, ones = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    score = calibrated(own, ones / n if n else 0.5)
    for scratch in (own, grams, shared, known):
        drop(scratch)
    drop_path(spark, folder)
    out = table.select("doc_id", *(F.col(f"f_{f}").alias(f) for f in FEATURES))
    out = out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), score.cast("double").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
