"""Conversation prefix trie, built as burst tries.

Conversations are sequences of turns; a node of the trie is a distinct sequence of first turns. A turn is known by the 128-bit
hash of its role and text, so texts are read once and never shuffled.

* **Shards and heads.** A conversation is cut every ``BLOCK`` turns. The turns before a cut are a trie head, known by a 128-bit
  hash that is a running XOR (so a very long conversation is hashed in parts, not in one task); the block behind it is a
  suffix in the head's container. Equal blocks of one container are first merged to one weighted suffix, so copies of a
  conversation, however many, are one row from here on.
* **Bursting.** A container with more than ``limit`` suffixes bursts: its suffixes go, by the id of their next turn, to containers
  of their own, whose heads become nodes. This is repeated until every container fits; as a block holds ``BLOCK`` turns,
  that many rounds suffice at any input size.
* **Sweeping.** The remaining containers are dealt to tasks, sorted, and swept once into nodes.

A node is named by its smallest member and its depth. Sums over subtrees need no walk along the trie: the nodes that one conversation
names are a stretch of its path, so a subtree's sum is the sum of its members' stretches less what the top's own name
counts above the top. Both are grouped sums and running sums in cells, so a path of any length, or a node with
a third of all conversations, is split over tasks.

Defined cases: rows without conv_id belong to no conversation; null role or text is empty, and a null turn stands first; turns of
equal number are ordered by the hash of role and text, and repeated rows are turns of their own; an empty table has no nodes;
other columns are ignored. A SHA-256 over a node's members is sequential by nature: the members are sorted by range
over tasks and joined to chunks there, so that one task reads only the chunks of a node, one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcost.llm.store import drop, save, small

BLOCK = 16
LIMIT = 4096
CELL = 4096
PERIOD, HEADS = 100, 6
NO_ENDS = hashlib.sha256(b"").hexdigest()
PATHS = "e1 long, e2 long, h1 long, h2 long, k long, conv long, n long, tids array<binary>, chars array<long>, owners array<long>, counts array<long>"


def running(df: DataFrame, key: str, at: str, total: Callable[[Column], Column], both: Callable[[Column, Column], Column], names: dict[str, str]) -> DataFrame:
    """``df`` with, for each (new: old) of ``names``, the total of ``old`` over the rows of ``key`` before the row's place ``at``.

    Added up in cells of ``CELL`` places, so that no window holds a whole key.
    """
    cells = df.withColumn("__cell", F.floor(F.col(at) / CELL))
    unbounded = Window.unboundedPreceding
    over_cells = Window.partitionBy(key).orderBy("__cell").rowsBetween(unbounded, -1)
    sums = cells.groupBy(key, "__cell").agg(*(total(F.col(old)).alias(f"__{old}") for old in names.values()))
    starts = sums.select(key, "__cell", *(F.coalesce(total(F.col(f"__{old}")).over(over_cells), F.lit(0)).alias(f"__s_{old}") for old in names.values()))
    inside = Window.partitionBy(key, "__cell").orderBy(at).rowsBetween(unbounded, -1)
    rows = cells.withColumns({f"__i_{old}": F.coalesce(total(F.col(old)).over(inside), F.lit(0)) for old in names.values()})
    out = rows.join(starts, [key, "__cell"])
    return out.select(*df.columns, *(both(F.col(f"__s_{old}"), F.col(f"__i_{old}")).alias(new) for new, old in names.items()))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, chars): every turn with its place from 0 in its conversation.

    The turns are sorted by range over tasks and numbered within each range; what stands before a range is added.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    tid = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", tid.alias("tid"), F.length(text).cast("long").alias("chars")).where(F.col("conv_id").isNotNull())
    order = [F.col("turn").asc_nulls_first(), F.col("tid")]
    turns = save(turns.repartitionByRange(F.col("conv_id"), *order).withColumn("cell", F.spark_partition_id()), "turns")
    before = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = turns.groupBy("conv_id", "cell").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("conv_id", "cell").orderBy(*order)) - 1
    return turns.withColumn("i", place).join(starts, ["conv_id", "cell"]).select("conv_id", (F.col("start") + F.col("i")).alias("pos"), "tid", "chars")


def with_shared_heads(turns: DataFrame, period: int = PERIOD, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (their turns, their ids).

    Conversation c begins with the first h turns of conversation c - c % ``period`` (all if it has fewer), h = crc32(c) % ``heads``, and
    goes on with its own turns after its first h.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv_id")
    convs = lengths.select("conv_id", (c - c % period).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"))
    bases = lengths.where(c % period == 0).select(c.alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("base_n")
    own = turns.join(convs, "conv_id").where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tid", "chars")
    first = turns.where((c % period == 0) & (F.col("pos") < heads - 1)).select(c.alias("base"), "pos", "tid", "chars")
    taken = convs.join(first, "base").where(F.col("pos") < F.col("taken")).select("conv_id", "pos", "tid", "chars")
    return own.unionByName(taken), convs.select("conv_id")


def blocks(turns: DataFrame) -> DataFrame:
    """Per conversation and ``BLOCK`` turns: their ids and lengths, the key (h1, h2) of the head and (e1, e2) of head and block."""
    held = F.sort_array(F.collect_list(F.struct("pos", "tid", "chars")))
    b = turns.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("k")).agg(held.alias("t")).select("conv_id", "k", F.col("t.tid").alias("tids"), F.col("t.chars").alias("chars"))
    b = b.withColumns({f"g{s}": F.xxhash64(F.lit(s), "k", "tids") for s in (1, 2)})  # the salt comes first: the two are independent
    b = running(b, "conv_id", "k", F.bit_xor, lambda x, y: x.bitwiseXOR(y), {"h1": "g1", "h2": "g2"})
    return b.select("conv_id", "k", "tids", "chars", "h1", "h2", F.col("h1").bitwiseXOR(F.col("g1")).alias("e1"), F.col("h2").bitwiseXOR(F.col("g2")).alias("e2"))


def _close(rows: list, used: int) -> tuple[list[list[int]], list[list[int]]]:
    """The smallest member and the number of members of each node on the path of each sorted suffix of one container."""
    owners = [[0] * (len(r.tids) - used) for r in rows]
    counts = [[0] * (len(r.tids) - used) for r in rows]
    conv, n = [r.conv for r in rows], [r.n for r in rows]
    began: list[int] = []  # the row at which each node of the current path began

    def close(depth: int, end: int) -> None:
        while len(began) > depth:
            i = began.pop()
            least, members = min(conv[i:end]), sum(n[i:end])
            for x in range(i, end):
                owners[x][len(began)], counts[x][len(began)] = least, members

    last: list[bytes] = []
    for i, r in enumerate(rows):
        now = list(r.tids[used:])
        same = 0
        while same < len(last) and same < len(now) and last[same] == now[same]:
            same += 1
        close(same, i)
        began.extend([i] * (len(now) - same))
        last = now
    close(0, len(rows))
    return owners, counts


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Containers, sorted, to the paths of their suffixes; at most ``limit`` suffixes are held."""
    columns = [c.split()[0] for c in PATHS.split(", ")]
    out: list[tuple] = []

    def swept(rows: list) -> None:
        own, count = _close(rows, rows[0].used)
        for r, o, c in zip(rows, own, count):
            out.append((r.e1, r.e2, r.h1, r.h2, r.k, r.conv, r.n, r.tids, r.chars, [*r.owners, *o], [*r.counts, *c]))

    held: list = []
    for batch in batches:
        for row in batch.itertuples(index=False):
            if held and (row.c1, row.c2) != (held[0].c1, held[0].c2):
                swept(held)
                held = []
            held.append(row)
        if len(out) > 5000:
            yield pd.DataFrame(out, columns=columns)
            out.clear()
    if held:
        swept(held)
    if out:
        yield pd.DataFrame(out, columns=columns)


def paths(suffixes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``suffixes`` (distinct blocks with weight ``n`` and smallest member ``conv``) with, for each turn, the smallest member and the
    members of its node: ``owners`` and ``counts``. Saved."""
    none = F.array().cast("array<long>")
    state = suffixes.withColumns({"c1": F.col("h1"), "c2": F.col("h2"), "used": F.lit(0), "owners": none, "counts": none})
    container = ["c1", "c2"]
    fitting: list[DataFrame] = []
    scratch: list[DataFrame] = []
    while True:
        over = save(state.groupBy(*container).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > limit).select(*container), "burst")
        scratch.append(over)
        if over.isEmpty():
            fitting.append(state)
            break
        fitting.append(state.join(small(over), container, "left_anti"))
        large = state.join(small(over), container, "left_semi")
        more = F.col("used") < F.size("tids")
        fitting.append(large.where(~more))  # the suffix that ends at the head: alone in a container of its own
        turn = F.element_at("tids", F.col("used") + 1)
        moved = large.where(more).withColumns({c: F.xxhash64(F.lit(s), c, turn) for s, c in enumerate(container, 1)})
        heads = moved.groupBy(*container).agg(F.min("conv").alias("owner"), F.sum("n").alias("members"))
        state = moved.join(heads, container).withColumns({
            "owners": F.concat("owners", F.array("owner")), "counts": F.concat("counts", F.array("members")), "used": F.col("used") + 1,
        }).drop("owner", "members")
        state = save(state, "burst")
        scratch.append(state)
    left = fitting[0]
    for f in fitting[1:]:
        left = left.unionByName(f)
    swept = left.repartition(*container).sortWithinPartitions(*container, "tids").mapInPandas(_sweep, PATHS)
    swept = save(swept, "paths")
    for table in scratch:
        drop(table)
    return swept


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (e1, e2, conv_id) to chunks: the decimal ids of one key in one batch, comma-joined."""
    for batch in batches:
        ids = batch["conv_id"].to_numpy()
        if not len(ids):
            continue
        e1, e2 = batch["e1"].to_numpy(), batch["e2"].to_numpy()
        cut = np.flatnonzero((e1[1:] != e1[:-1]) | (e2[1:] != e2[:-1])) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(ids)]
        yield pd.DataFrame({"e1": e1[starts], "e2": e2[starts], "first": ids[starts], "ids": [",".join(map(str, ids[a:b])) for a, b in zip(starts, ends)]})


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted chunks to the SHA-256 of each key's ids; only the hash in progress is held."""
    key, state = None, hashlib.sha256()
    for batch in batches:
        out = []
        for e1, e2, ids in zip(batch["e1"], batch["e2"], batch["ids"]):
            if key != (e1, e2):
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (e1, e2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pd.DataFrame(out, columns=["e1", "e2", "sha"])
    if key:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["e1", "e2", "sha"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(e1, e2, sha) of ``ends`` (e1, e2, conv_id): the SHA-256 of each key's ids, ascending, comma-joined."""
    order = ["e1", "e2", "conv_id"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_chunks, "e1 long, e2 long, first long, ids string")
    return chunks.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "first").mapInPandas(_hashes, "e1 long, e2 long, sha string")


def trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the prefix trie of conversations ``convs`` (conv_id) with ``turns`` (conv_id, pos from 0, tid, chars).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = turns.sparkSession
    key = ["conv_id", "depth"]
    cut = save(blocks(turns), "blocks")
    suffixes = save(cut.groupBy("h1", "h2", "e1", "e2", "k").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"), F.any_value("tids").alias("tids"), F.any_value("chars").alias("chars")), "suffixes")
    found = paths(suffixes, limit)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()

    at = F.posexplode(F.arrays_zip("owners", "counts", "chars")).alias("j", "x")
    steps = found.select("k", "conv", "h1", "h2", "owners", at).where(F.col("x.owners") == F.col("conv"))
    steps = steps.select(
        F.col("conv").alias("conv_id"), (F.col("k") * BLOCK + F.col("j") + 1).alias("depth"), F.col("x.counts").alias("n_convs"), F.col("x.chars").alias("chars"), "h1", "h2",
        F.when(F.col("j") > 0, F.get("owners", F.col("j") - 1)).when(F.col("k") == 0, F.lit(root.conv_id)).alias("parent_conv_id"),
    )  # the parent of a block's first node ends the block before, whose key is this block's head
    under = found.where(F.size("owners") == BLOCK).select(F.col("e1").alias("h1"), F.col("e2").alias("h2"), F.element_at("owners", -1).alias("above"))
    crossing = steps.where(F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(under, ["h1", "h2"]).withColumnRenamed("above", "parent_conv_id")
    nodes = steps.where(F.col("parent_conv_id").isNotNull()).unionByName(crossing).select(*key, "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    nodes = save(nodes, "nodes")
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = save(nodes, "nodes")

    named = nodes.groupBy("conv_id").agg(F.sum("saved").alias("t"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    named = save(named, "named")
    weights = cut.select("conv_id", "e1", "e2").join(named, "conv_id").groupBy("e1", "e2").agg(F.sum("t").alias("t"), F.sum("leaves").alias("leaves"))
    below = found.select("e1", "e2", "k", "owners").join(weights, ["e1", "e2"]).select("k", "t", "leaves", F.posexplode("owners").alias("j", "conv_id"))
    below = below.groupBy("conv_id", (F.col("k") * BLOCK + F.col("j") + 1).alias("depth")).agg(F.sum("t").alias("t"), F.sum("leaves").alias("n_leaves"))
    above = running(nodes, "conv_id", "depth", F.sum, lambda x, y: x + y, {"above": "saved"})

    last = cut.groupBy("conv_id").agg(F.max_by(F.struct("e1", "e2"), "k").alias("e"))
    ends = save(convs.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(f"e.{c}", F.lit(0)).alias(c) for c in ("e1", "e2"))), "ends")
    hashes = save(end_hashes(ends), "ends")
    place = found.select("e1", "e2", F.element_at("owners", -1).alias("conv_id"), (F.col("k") * BLOCK + F.size("owners")).alias("depth"))
    sha = hashes.join(place, ["e1", "e2"]).select(*key, "sha")

    out = above.join(below, key).join(sha, key, "left").select(
        *key, "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("t") - F.col("above")).alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    if not root.n:
        return out
    total = named.agg(F.sum("t").alias("t"), F.sum("leaves").alias("leaves")).first()
    turnless = hashes.where((F.col("e1") == 0) & (F.col("e2") == 0)).first()
    n_children = nodes.where(F.col("depth") == 1).count()
    top = (root.conv_id, 0, None, root.n, n_children, total.leaves or 1, total.t or 0, turnless.sha if turnless else NO_ENDS)
    return out.unionByName(spark.createDataFrame([top], out.schema))


def report(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations."""
    turns = save(ordered_turns(conversations), "ordered")
    rebuilt, convs = with_shared_heads(turns)
    return trie(rebuilt, convs, limit).select(
        *(F.col(c).cast("long").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), "ends_sha256",
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT DISTINCT c, c - c % 100 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
  FROM t
), r AS (
  SELECT c.c, 0 AS part, pos, id, chars FROM c JOIN t ON t.c = c.base WHERE pos < h
  UNION ALL SELECT c.c, 1, pos, id, chars FROM c JOIN t ON t.c = c.c WHERE pos >= h
), l AS (
  SELECT c.c, coalesce(list(id ORDER BY part, pos) FILTER (id IS NOT NULL), []) AS ids, coalesce(list(chars ORDER BY part, pos) FILTER (id IS NOT NULL), []) AS chars
  FROM c LEFT JOIN r ON r.c = c.c GROUP BY c.c
), m AS (
  SELECT c, len(ids) AS n, d AS depth, ids[:d] AS node, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM l)
), nodes AS (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
  FROM m GROUP BY node, depth
), kids AS (
  SELECT node[:depth - 1] AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), up AS (
  SELECT n.node[:a.d] AS node, a.d AS depth, n.saved, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes n LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth, unnest(range(n.depth + 1)) AS a(d)
), sums AS (
  SELECT node, depth, sum(saved) AS saved, sum(leaf) AS leaves FROM up GROUP BY ALL
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
  s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.depth = n.depth LEFT JOIN kids k ON k.node = n.node AND k.depth = n.depth
LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[:n.depth - 1] AND p.depth = n.depth - 1
"""
