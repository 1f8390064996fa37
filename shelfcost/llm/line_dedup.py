"""Line dedup by an exact set-similarity join.

A line is the set of its five-word shingles (a shorter line: its words as one shingle). A line is removed if an
earlier line of the corpus (smaller document id, then smaller line number; removed or not) has a Jaccard
similarity of at least ``num / den`` with it, 0.8 by default. Lines without a word are never removed.

Equal lines are settled first, by their hash. For the others, tokens are ordered by rarity: by their
corpus-wide count (in classes by hash bucket, a fixed number of buckets, so the lookup has a fixed size), then by
their hash. Shingles of common passages so come last and are not indexed. Shingles are 64-bit hashes.
Two similar sets share a token among the first ``n - ceil(t n) + 1`` of each, so only these are indexed; the pairs
that meet there pass the length filter and the positional filter at their first common token before the sets
themselves are compared.

Within a token's list each line is first compared with the list's first line and with the one before it, which settles
groups of near copies in linear time; only lines that are still unsettled meet the earlier lines of the list, and of these only the ones whose 64-bit
signatures differ in no more bits than similar sets can. The list of a token from a common hash bucket (``SPLIT_CLASS``) is dealt into parts by
a hash of its lines, so that no task sorts a whole one; its lines still meet the first one of the whole list.

Only DataFrame functions are used on this path. The tables of removed lines are broadcast to the documents while
their files stay below ``store.BROADCAST_BYTES``, and joined by a shuffle beyond.

Defined cases: a null text stays null, an empty one empty; a null id sorts first; a row's name is its id and (where ids repeat) the hash of its
text, in this order, so rows of one id (or of none) with different texts are documents of their own, and only rows that repeat
both share their removed lines; an empty table gives an empty table; other
columns are carried, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcost.llm.store import drop, save, small
from shelfcost.llm.text import words

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SHINGLE = 5
#: Lists of tokens from this rarity class on (buckets of twice the mean count) are split; the last class is open upwards, so it has more parts.
SPLIT_CLASS = 48
LAST_CLASS = 127
LAST_PARTS = 1024
_NULL = -(1 << 63)
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _nid() -> Column:
    """The id, with the least number for null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL))


def _texts(docs: DataFrame) -> tuple[DataFrame, Column, list[DataFrame]]:
    """(nid, th, text): each row's name once, as a repeated row would meet itself as an earlier one; th as a column of ``docs``; and the written tables it reads.

    th is the hash of the text, or, where no two rows have one id, zero, as the id is a name by itself then: names go along with all indexed tokens.
    """
    twice = docs.groupBy(_nid().alias("nid")).count().where("count > 1")
    if twice.isEmpty():
        th = F.lit(0).cast("long")
        return docs.select(_nid().alias("nid"), th.alias("th"), "text"), th, []
    th = F.xxhash64("text")
    named = docs.select(_nid().alias("nid"), th.alias("th"), "text")
    several = save(named.groupBy("nid", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    one = save(named.join(small(several), ["nid", "th"], "left_semi").groupBy("nid", "th").agg(F.first("text").alias("text")), "once")
    return named.join(small(several), ["nid", "th"], "left_anti").unionByName(one), th, [several, one]


def _words(line: Column) -> Column:
    """The line's words; a plain split where blanks are the only white space, which is much cheaper."""
    other = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c"))
    return F.when(other, words(line)).otherwise(F.array_remove(F.split(line, " "), ""))


def _shingle(w: Column, i: Column) -> Column:
    """The 64-bit hash of the shingle that starts at word ``i`` (words past the end are left out)."""
    return F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE)))


def _starts(w: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))


def _shingles(line: Column) -> Column:
    """The hashes of the line's shingles, each once. The words are a lambda's argument, so they are cut once per line."""
    return F.get(F.transform(F.array(_words(line)), lambda w: F.array_distinct(F.transform(_starts(w), lambda i: _shingle(w, i)))), F.lit(0))


def _bucket(h: Column) -> Column:
    """The hash bucket of a shingle: its upper bits."""
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")


def _tokens(line: Column, classes: Column) -> Column:
    """The line's tokens: each shingle's hash with its rarity class in the upper 8 bits, so that their order as numbers is by rarity."""
    return F.transform(_shingles(line), lambda h: F.get(classes, _bucket(h)).bitwiseXOR(h))


def _signature(shingles: Column) -> Column:
    """64 bits, one set for each shingle: two lines' signatures differ in no more bits than their sets in shingles."""
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))))


def _lines(texts: DataFrame) -> DataFrame:
    """(nid, th, no, line): the lines with a word."""
    lines = texts.select("nid", "th", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return lines.where(F.col("line").rlike(_HAS_WORD))


def equal_lines(texts: DataFrame) -> DataFrame:
    """(nid, th, gone): per document the numbers of the lines that equal an earlier one, as a written table."""
    lines = _lines(texts).select(F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), "nid", "th", "no")
    at = F.struct("nid", "th", "no")
    several = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first")).where("n > 1").drop("n")
    several = save(several, "several")  # so that a very common line can be split over tasks in the join
    later = lines.join(small(several), ["h1", "h2"]).where(at != F.col("first"))
    equal = save(later.groupBy("nid", "th").agg(F.collect_set("no").alias("gone")), "equal")
    drop(several)
    return equal


def _without(texts: DataFrame, gone: DataFrame) -> DataFrame:
    """(nid, th, all, gone): documents with their lines and the numbers of the removed ones (null: none)."""
    d = texts.select("nid", "th", F.split("text", "\n").alias("all"))
    return d.join(small(gone), ["nid", "th"], "left")


def rarity(texts: DataFrame) -> Column:
    """For each hash bucket the class (16 to a doubling, 0 to ``LAST_CLASS``, 32 for the mean) of its shingle count in all lines, as a constant array.

    The class stands in a number that a shingle's hash is combined with by exclusive or: it changes the upper 8 bits, which the bucket holds, to the class.
    Shingles are rows of their own here (repeats within a line count), as generated code is much cheaper than lambdas.
    """
    words_of = _lines(texts).select(_words(F.col("line")).alias("w"))
    counted = words_of.select("w", F.explode(_starts(F.col("w"))).alias("i")).groupBy(_bucket(_shingle(F.col("w"), F.col("i"))).alias("b")).count()
    found = dict(counted.collect())  # BUCKETS rows at most
    mean = max(1.0, sum(found.values()) / BUCKETS)
    classes = (min(LAST_CLASS, max(0, 32 + round(16 * math.log2(found[b] / mean)))) if b in found else 0 for b in range(BUCKETS))
    upper = ((c ^ b >> BUCKET_BITS - 8) << 56 for b, c in enumerate(classes))
    signed = (x - (1 << 64) if x >> 63 else x for x in upper)
    return F.split(F.lit(",".join(map(str, signed))), ",").cast("array<bigint>")


def _postings(texts: DataFrame, equal: DataFrame, classes: Column, num: int, den: int) -> DataFrame:
    """(token, nid, th, no, n, pos): the indexed tokens of the lines that equal no earlier one."""
    lines = _without(texts, equal).select("nid", "th", "gone", F.posexplode("all").alias("no", "line"))
    first = F.col("gone").isNull() | ~F.array_contains("gone", F.col("no"))
    lines = lines.where(F.col("line").rlike(_HAS_WORD) & first)
    lines = lines.select("nid", "th", "no", F.sort_array(_tokens(F.col("line"), classes)).alias("tokens"))
    n = F.size("tokens")
    prefix = n - F.floor((num * n + den - 1) / den).cast("int") + 1
    return lines.select("nid", "th", "no", n.alias("n"), F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("pos", "token"))


def _may_match(n: Column, i: Column, m: Column, j: Column, num: int, den: int) -> Column:
    """Length filter, and positional filter as at the first common token."""
    length = den * F.least(n, m) >= num * F.greatest(n, m)
    reach = 1 + F.least(n - i - 1, m - j - 1)
    return length & ((num + den) * reach >= num * (n + m))


def _sets(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """(nid, th, no, tokens, sig) of every line that shares an indexed token with another."""
    wanted = save(lists.groupBy("nid", "th").agg(F.collect_set("no").alias("want")), "wanted")
    d = texts.join(small(wanted), ["nid", "th"]).select("nid", "th", "want", F.split("text", "\n").alias("all"))
    picked = d.select("nid", "th", F.explode("want").alias("no"), "all").select("nid", "th", "no", F.get("all", F.col("no")).alias("line")).where(F.col("line").isNotNull())
    sets = save(picked.select("nid", "th", "no", _shingles(F.col("line")).alias("tokens")).withColumn("sig", _signature(F.col("tokens"))), "sets")
    drop(wanted)
    return sets


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The later sides (nid, th, no) of the ``pairs`` (nid, th, no, e_nid, e_th, e_no) that are similar enough."""
    # both sides are read by the same select but for the names, so that Spark writes one shuffle of the sets and reads it twice
    late, early = (sets.select(*(F.col(c).alias(f"{side}_{c}") for c in ("nid", "th", "no", "tokens"))) for side in ("l", "e"))
    named = pairs.distinct().withColumnsRenamed({c: f"l_{c}" for c in ("nid", "th", "no")})
    both = named.join(late, ["l_nid", "l_th", "l_no"]).join(early, ["e_nid", "e_th", "e_no"])
    common = F.size(F.array_intersect("l_tokens", "e_tokens"))
    similar = (num + den) * common >= num * (F.size("l_tokens") + F.size("e_tokens"))
    return both.where(similar).select(*(F.col(f"l_{c}").alias(c) for c in ("nid", "th", "no"))).distinct()


def _lists(postings: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(token, nid, th, no, n, pos, f, p, later): the lines of each token that has several, the list's first line, the line before (null: none in its part), and
    whether the line comes after the first; and the written tables it reads.
    """
    rank = F.shiftright("token", 56).cast("int")
    split = rank >= SPLIT_CLASS
    parts = F.when(rank == LAST_CLASS, F.lit(LAST_PARTS)).otherwise(F.call_function("shiftleft", F.lit(1), ((rank - 32) / 16).cast("int")))
    part = F.when(split, F.pmod(F.xxhash64("nid", "th", "no"), parts).cast("int")).otherwise(F.lit(0))
    in_part = Window.partitionBy("token", "part")
    by_part = in_part.orderBy("nid", "th", "no")
    me = F.struct("nid", "th", "no", "n", "pos")
    # a token of one line alone links nothing; of a split list that is known below
    several = postings.withColumn("part", part).withColumn("lines", F.count(F.lit(1)).over(in_part)).where((F.col("lines") > 1) | split).drop("lines")
    kept = save(several.select("*", F.first(me).over(by_part).alias("f"), F.lag(me).over(by_part).alias("p")).drop("part"), "lists")
    whole = kept.where(~split).withColumn("later", F.col("p").isNotNull())
    several = kept.where(split).groupBy("token").agg(F.min("f").alias("f"), F.count(F.lit(1)).alias("lines")).where("lines > 1").drop("lines")
    several = save(several, "several")
    at_first = (F.col("nid") == F.col("f.nid")) & (F.col("th") == F.col("f.th")) & (F.col("no") == F.col("f.no"))
    dealt = save(kept.where(split).drop("f").join(small(several), "token").withColumn("later", ~at_first).select(*whole.columns), "lists")
    drop(several)
    return whole.unionByName(dealt), [kept, dealt]


def similar_lines(texts: DataFrame, equal: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """(nid, th, gone): per document the numbers of the lines that equal no earlier line but are similar to one, as a written table."""
    postings = _postings(texts, equal, rarity(texts), num, den)
    lists, written = _lists(postings)
    sets = _sets(texts, lists)

    near = lists.where("later").select("nid", "th", "no", "n", "pos", F.explode(F.array_distinct(F.array("f", "p"))).alias("e"))
    near = near.where(_may_match(F.col("n"), F.col("pos"), F.col("e.n"), F.col("e.pos"), num, den))
    settled = save(_verified(near.select("nid", "th", "no", F.col("e.nid").alias("e_nid"), F.col("e.th").alias("e_th"), F.col("e.no").alias("e_no")), sets, num, den), "settled")

    signed = lists.select("token", "nid", "th", "no", "n", "pos", "later").join(sets.select("nid", "th", "no", "sig"), ["nid", "th", "no"])
    late = signed.where("later").join(settled, ["nid", "th", "no"], "left_anti")
    early = signed.select("token", F.col("nid").alias("e_nid"), F.col("th").alias("e_th"), F.col("no").alias("e_no"), F.col("n").alias("m"), F.col("pos").alias("e_pos"), F.col("sig").alias("e_sig"))
    before = F.struct("e_nid", "e_th", "e_no") < F.struct("nid", "th", "no")
    # sets that are similar enough differ in at most (den - num) / (den + num) of their sizes' sum
    differ = (num + den) * F.bit_count(F.col("sig").bitwiseXOR(F.col("e_sig"))) <= (den - num) * (F.col("n") + F.col("m"))
    rest = late.join(early, "token").where(before & differ & _may_match(F.col("n"), F.col("pos"), F.col("m"), F.col("e_pos"), num, den))
    more = _verified(rest.select("nid", "th", "no", "e_nid", "e_th", "e_no"), sets, num, den)
    similar = save(settled.unionByName(more).groupBy("nid", "th").agg(F.collect_set("no").alias("gone")), "similar")
    for table in (*written, sets, settled):
        drop(table)
    return similar


def dedup_lines(docs: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` without the removed lines, with ``__line_n`` (lines) and ``__line_gone`` (removed lines); ``n_chars`` follows the text where there is such a column."""
    texts, th, written = _texts(docs.select("doc_id", "text"))
    equal = equal_lines(texts)
    similar = similar_lines(texts, equal, num, den)
    gone = save(equal.unionByName(similar).groupBy("nid", "th").agg(F.flatten(F.collect_list("gone")).alias("gone")), "gone")
    for table in (*written, equal, similar):
        drop(table)
    gone = gone.withColumnsRenamed({"nid": "__line_id", "th": "__line_hash", "gone": "__line_set"})
    d = docs.withColumns({"__line_id": _nid(), "__line_hash": th, "__line_all": F.split("text", "\n")}).join(small(gone), ["__line_id", "__line_hash"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("__line_all") - 1), "__line_set")
    text = F.when(F.col("__line_set").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("__line_all"), i)), "\n"))
    here = F.size(F.col("__line_all")) - F.size(stay)
    out = d.withColumns({"__line_n": F.coalesce(F.size("__line_all"), F.lit(0)).cast("long"), "__line_gone": F.when(F.col("__line_set").isNull() | F.col("text").isNull(), F.lit(0)).otherwise(here).cast("long"), "text": text})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns, "__line_n", "__line_gone")


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, and the text that stays."""
    d = dedup_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", F.col("__line_n").alias("n_lines"), F.col("__line_gone").alias("n_removed"), "text")


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS no, unnest(string_split(text, chr(10))) AS line FROM documents
), cls AS (
  SELECT line, min((doc_id, no)) AS first_at FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
), tok AS (
  SELECT DISTINCT line, unnest(list_transform(range(1, greatest(len(x) - 4, 1) + 1), lambda i: array_to_string(x[i:i + 4], ' '))) AS w
  FROM (SELECT line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS x FROM cls)
), freq AS (
  SELECT w, count(*) AS f FROM tok GROUP BY w
), ord AS (
  SELECT line, w, row_number() OVER (PARTITION BY line ORDER BY f, w) AS k, count(*) OVER (PARTITION BY line) AS n FROM tok JOIN freq USING (w)
), pre AS (
  SELECT o.*, first_at FROM ord o JOIN cls USING (line) WHERE 5 * (n - k + 1) >= 4 * n
), cand AS (
  SELECT DISTINCT a.line AS late, b.line AS early, a.n AS n, b.n AS m FROM pre a JOIN pre b ON a.w = b.w AND b.first_at < a.first_at AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), matched AS (
  SELECT DISTINCT c.late FROM (
    SELECT late, early, n, m, count(*) AS both_have FROM cand JOIN tok x ON x.line = late JOIN tok y ON y.line = early AND y.w = x.w GROUP BY ALL
  ) c WHERE 9 * both_have >= 4 * (n + m)
), verdict AS (
  SELECT l.*, cls.first_at IS NOT NULL AND (matched.late IS NOT NULL OR cls.first_at <> (doc_id, no)) AS gone
  FROM l LEFT JOIN cls USING (line) LEFT JOIN matched ON matched.late = l.line
)
SELECT d.doc_id, count(v.no)::BIGINT AS n_lines, coalesce(sum(gone::INT), 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(v.line, chr(10) ORDER BY v.no) FILTER (NOT gone), '') END AS text
FROM documents d LEFT JOIN verdict v ON v.doc_id = d.doc_id GROUP BY d.doc_id, d.text
"""
