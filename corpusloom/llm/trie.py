"""Prefix tries of conversations, packed as double arrays shard by shard.

A node is a distinct sequence of first turns; its id is a pair of 64-bit words, the exclusive or of
a hash of each turn and its place, so that it can be gathered in any order and by parts.

1. Conversations are dealt by their first turns, so that a shard holds neighbours in the trie. In a shard
   the turns get dense ids, and the trie is packed into BASE and CHECK: the child of a cell by turn id t is the
   cell BASE[cell] + t if CHECK of it names the parent. Every conversation is walked through the arrays.
2. Nodes that several shards hold, as the upper ones, are merged by id: members, smallest member, children.
3. Values of a node (words that its repetition saves, leaf or not) belong to the shard of its smallest member.
   Sums over the subtrees of each shard, bottom-up, are added up by id.

A conversation of any length is cut into segments of ``segment`` turns. The trie of later segments starts at the
node where the segment before ends; what lies below that node is summed along each conversation first. So a
task holds at most ``SHARD_TURNS`` turns and one segment, as numbers without texts.

Null roles and texts are empty ones. Turns are ordered by turn (null first), role and text, so
repeated rows are turns of their own. Rows without a conversation id belong to none. A conversation without turns
is a member of the root alone. An empty table has no members, hence no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import crc32_sql, staged, table
from corpusloom.llm.order import positions

SEGMENT = 2048
SHARD_TURNS = 50_000
#: Turns by which conversations are dealt.
DEALT_BY = 6
#: Free cells that are tried for the children of one cell before the end of the arrays is taken.
TRIES = 64
FREE = -1


class DoubleArray:
    """A trie over sequences of dense ids. Cell 0 is the root; CHECK of a free cell is ``FREE``."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Packs the sequences ``ids[start : start + length]``."""
        self.base, self.check = np.zeros(1024, dtype=np.int64), np.full(1024, FREE, dtype=np.int64)
        self.check[0] = 0
        self.size, self.low = 1, 1
        at = np.zeros(len(starts), dtype=np.int64)
        open_, depth = np.flatnonzero(lengths > 0), 0
        while len(open_):
            pairs = np.stack([at[open_], ids[starts[open_] + depth]], axis=1)
            found, which = np.unique(pairs, axis=0, return_inverse=True)
            self._add(found[:, 0], found[:, 1])
            at[open_] = (self.base[found[:, 0]] + found[:, 1])[which.reshape(-1)]
            depth += 1
            open_ = open_[lengths[open_] > depth]

    def _reserve(self, end: int) -> None:
        if end > len(self.base):
            more = max(end, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, FREE, dtype=np.int64)])

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free cells."""
        self._reserve(self.size + n)
        cells = self.low + np.flatnonzero(self.check[self.low : self.size + n] == FREE)[:n]
        self.low = int(cells[0])
        return cells

    def _take(self, cells: np.ndarray, parents: np.ndarray) -> None:
        self.check[cells] = parents
        self.size = max(self.size, int(cells.max()) + 1)

    def _add(self, parents: np.ndarray, ids: np.ndarray) -> None:
        """Children of cells that have none yet; rows are sorted by parent and id."""
        firsts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        counts = np.diff(np.r_[firsts, len(parents)])
        for first, count in zip(firsts[counts > 1].tolist(), counts[counts > 1].tolist()):
            wanted = ids[first : first + count]
            base = self._place(wanted)
            self.base[parents[first]] = base
            self._take(base + wanted, parents[first : first + count])
        single = firsts[counts == 1]
        if len(single):
            cells = self._free(len(single))
            self.base[parents[single]] = cells - ids[single]
            self._take(cells, parents[single])

    def _place(self, ids: np.ndarray) -> int:
        """A base with free cells for all ids, the first of them in one of the first free cells or at the end."""
        span = int(ids[-1] - ids[0]) + 1
        self._reserve(self.size + span + TRIES)
        for cell in self._free(TRIES).tolist():
            self._reserve(cell + span)
            if (self.check[cell + ids - ids[0]] == FREE).all():
                return cell - int(ids[0])
        return self.size - int(ids[0])

    def walk(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The cell after each id of the sequences, in the order of ``ids``; ``FREE`` where the trie has no such path."""
        out = np.full(len(ids), FREE, dtype=np.int64)
        at = np.zeros(len(starts), dtype=np.int64)
        open_, depth = np.flatnonzero(lengths > 0), 0
        while len(open_):
            places = starts[open_] + depth
            cells = self.base[at[open_]] + ids[places]
            inside = (cells >= 0) & (cells < self.size)
            there = inside & (self.check[np.where(inside, cells, 0)] == at[open_]) & (cells != 0)
            open_, cells, places = open_[there], cells[there], places[there]
            out[places] = at[open_] = cells
            depth += 1
            open_ = open_[lengths[open_] > depth]
        return out


NODES = pa.schema(
    [("shard", pa.int64()), ("node", pa.int32()), ("parent", pa.int32()), ("level", pa.int32()), ("segment", pa.int64())]
    + [("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("words", pa.int64()), ("n", pa.int64()), ("conv", pa.int64()), ("has_child", pa.bool_()), ("entry", pa.bool_())]
)


def _shard_nodes(shard: int, items: list[dict], segment: int) -> pa.RecordBatch:
    """The nodes of a shard, parents first: an entry for each node that its segments start at, and those of their turns."""
    lengths = np.array([len(x["h1"]) + 1 for x in items], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    flat = {c: np.array([v for x in items for v in (entry(x), *x[c])], dtype=np.int64) for c, entry in ENTRY.items()}
    of = np.repeat(np.arange(len(items)), lengths)
    step = np.arange(len(of)) - starts[of]
    conv, part = (np.array([x[c] for x in items], dtype=np.int64) for c in ("conv", "segment"))
    # Dense ids in order of first appearance; an entry differs from a turn.
    turns = np.stack([flat["h1"], flat["h2"], (step == 0).astype(np.int64)], axis=1)
    _, firsts, which = np.unique(turns, axis=0, return_index=True, return_inverse=True)
    rank = np.empty(len(firsts), dtype=np.int64)
    rank[np.argsort(firsts, kind="stable")] = np.arange(len(firsts))
    ids = rank[which.reshape(-1)]

    cells = DoubleArray(ids, starts, lengths)
    walked = cells.walk(ids, starts, lengths)
    a, b = (np.bitwise_xor.accumulate(flat[c]) for c in ("f1", "f2"))
    a, b = (x ^ np.where(starts > 0, x[starts - 1], 0)[of] for x in (a, b))
    # One row for each cell, by level, from its first occurrence.
    _, firsts = np.unique(walked, return_index=True)
    firsts = firsts[np.argsort(step[firsts], kind="stable")]
    number = np.full(cells.size, -1, dtype=np.int32)
    number[walked[firsts]] = np.arange(len(firsts), dtype=np.int32)
    node = number[walked]
    smallest = np.full(len(firsts), np.iinfo(np.int64).max)
    np.minimum.at(smallest, node, conv[of])
    parent = number[cells.check[walked[firsts]]]
    has_child = np.zeros(len(firsts), dtype=bool)
    has_child[parent[parent >= 0]] = True
    columns = [
        np.full(len(firsts), shard), np.arange(len(firsts), dtype=np.int32), parent, step[firsts].astype(np.int32), part[of[firsts]],
        a[firsts], b[firsts], part[of[firsts]] * segment + step[firsts], flat["words"][firsts], np.bincount(node, minlength=len(firsts)), smallest, has_child,
        (step[firsts] == 0) & (part[of[firsts]] > 0),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, NODES.types)], schema=NODES)


#: What the entry of an item has in the place of a turn: as hash and as id that of its node.
ENTRY = {"h1": lambda x: x["a"], "h2": lambda x: x["b"], "f1": lambda x: x["a"], "f2": lambda x: x["b"], "words": lambda x: 0}


def _tries(batches: Iterable[pa.RecordBatch], segment: int, turns: int) -> Iterator[pa.RecordBatch]:
    shard, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for item in batch.slice(at, 64).to_pylist():
                held.append(item)
                size += len(item["h1"]) + 1
                if size >= turns:
                    yield _shard_nodes(shard, held, segment)
                    shard, held, size = shard + 1, [], 0
    if held:
        yield _shard_nodes(shard, held, segment)


SUMS = "a bigint, b bigint, entry boolean, depth bigint, conv bigint, parent_conv bigint, n bigint, children bigint, leaves bigint, saved bigint"


def _subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For shards sorted by node: sums of the values of the nodes that are at home in the shard over its subtrees."""

    def sums(rows: pa.Table) -> pa.RecordBatch:
        column = {c: rows.column(c).to_numpy() for c in ("parent", "level", "all_conv", "all_n", "leaves", "saved", "home", "entry")}
        parent, level = column["parent"], column["level"]
        children = np.zeros(len(parent), dtype=np.int64)
        below = np.flatnonzero(parent >= 0)
        np.add.at(children, parent[below], column["home"][below].astype(np.int64))
        leaves, saved = (np.where(column["home"], column[c], 0) for c in ("leaves", "saved"))
        ends = np.flatnonzero(np.r_[level[1:] != level[:-1], True]) + 1
        for end, start in zip(ends[::-1], np.r_[0, ends[:-1]][::-1]):
            if start:
                np.add.at(leaves, parent[start:end], leaves[start:end])
                np.add.at(saved, parent[start:end], saved[start:end])
        for total in (leaves, saved):  # what lies below an entry is in the value of its node already
            total[column["entry"]] = 0
        parents = pa.array(np.where(parent >= 0, column["all_conv"][parent], 0), mask=parent < 0)
        names = ["a", "b", "entry", "depth", "conv", "parent_conv", "n", "children", "leaves", "saved"]
        arrays = [*(rows.column(c).combine_chunks() for c in ("a", "b", "entry", "depth", "all_conv")), parents, rows.column("all_n").combine_chunks()]
        return pa.RecordBatch.from_arrays([*arrays, *(pa.array(x) for x in (children, leaves, saved))], names=names)

    held, last = [], None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else []
        for start, end in zip(cuts, [*cuts[1:], len(shards)]):
            if held and shards[start] != last:
                yield sums(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(start, end - start))
            last = shards[start]
    if held:
        yield sums(pa.Table.from_batches(held))


def _end_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids that end at a node, from rows sorted by node and id, one after the other."""
    last, state, out = None, hashlib.sha256(), []
    for batch in batches:
        for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv"))):
            if (a, b) == last:
                state.update(b",")
            else:
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = (a, b), hashlib.sha256()
            state.update(str(conv).encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b", "ends"])
            out = []
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*last, state.hexdigest())], names=["a", "b", "ends"])


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, h1, h2, words): the turns of each conversation in order, places from 0, by hash."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    turns = df.where(F.col(f"`{conv}`").isNotNull()).select(F.col(f"`{conv}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").alias("turn"), role_.alias("role"), text_.alias("text"))
    hashes = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2")]
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words")
    hashed = turns.select("conv", "turn", "role", "text", *hashes, words)
    return positions(hashed, "conv", ["turn", "role", "text"], ["conv", "h1", "h2", "words"], "place")


def trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the prefix trie of the conversations ``convs`` (conv) with their turns (conv, place, h1, h2, words).

    Columns: conv (smallest member), depth, parent_conv, n (members), children, leaves, saved, ends.
    """
    hashed = turns.withColumns({"part": F.floor(F.col("place") / segment), "f1": F.xxhash64("place", "h1", "h2"), "f2": F.xxhash64(F.lit(1), "place", "h2", "h1")})
    in_order = F.array_sort(F.collect_list(F.struct("place", "h1", "h2", "f1", "f2", "words")))
    items = hashed.groupBy("conv", "part").agg(in_order.alias("t"), F.bit_xor("f1").alias("x1"), F.bit_xor("f2").alias("x2"))
    items = convs.select("conv").distinct().join(items, "conv", "left")
    along = W.partitionBy("conv").orderBy("part")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    nothing = F.lit(0).cast("bigint")
    items = items.select(
        "conv", F.coalesce("part", nothing).alias("segment"), F.coalesce(F.bit_xor("x1").over(before), nothing).alias("a"), F.coalesce(F.bit_xor("x2").over(before), nothing).alias("b"),
        F.coalesce("x1", nothing).alias("x1"), F.coalesce("x2", nothing).alias("x2"), F.lead("part").over(along).isNull().alias("last"),
        *(F.coalesce(f"t.{c}", F.array().cast("array<bigint>")).alias(c) for c in ("h1", "h2", "f1", "f2", "words")),
    )
    items = staged(items, "trie_items")

    size = items.agg(F.sum(F.size("h1") + 1).alias("n")).first()["n"] or 0
    first_turns = [F.get("f1", F.lit(k)) for k in range(DEALT_BY)]
    dealt = items.repartitionByRange(max(1, -(-size // shard_turns)), "segment", "a", *first_turns, "conv")
    dealt = dealt.sortWithinPartitions("segment", "a", *first_turns, "conv")
    schema = ", ".join(f"{f.name} { {pa.int64(): 'bigint', pa.int32(): 'int', pa.bool_(): 'boolean'}[f.type]}" for f in NODES)
    found = dealt.select("conv", "segment", "a", "b", "h1", "h2", "f1", "f2", "words").mapInArrow(lambda x: _tries(x, segment, shard_turns), schema)
    found = staged(found, "trie_nodes")

    own = ~F.col("entry")
    merged = found.groupBy("a", "b").agg(F.sum(F.when(own, F.col("n"))).alias("all_n"), F.min(F.when(own, F.col("conv"))).alias("all_conv"), F.max("has_child").alias("inner"))
    valued = found.join(merged, ["a", "b"]).withColumn("home", own & (F.col("conv") == F.col("all_conv")))
    valued = valued.withColumns({"leaves": (~F.col("inner")).cast("bigint"), "saved": (F.col("all_n") - 1) * F.col("words")})
    valued = staged(valued, "trie_values")

    # What lies below the node where a segment starts: the values of all later segments of its members.
    at_home = valued.where("home AND segment > 0").groupBy(F.col("all_conv").alias("conv"), "segment").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    later = items.where("segment > 0").select("conv", "segment", "a", "b").join(at_home, ["conv", "segment"], "left")
    on = W.partitionBy("conv").orderBy(F.desc("segment")).rowsBetween(W.unboundedPreceding, 0)
    later = later.select("a", "b", *(F.sum(c).over(on).alias(c) for c in ("leaves", "saved")))
    later = later.groupBy("a", "b").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    valued = valued.join(later, ["a", "b"], "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", nothing) for c in ("leaves", "saved")})

    summed = valued.repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(_subtrees, SUMS)
    totals = [F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
    nodes = summed.groupBy("a", "b").agg(*(F.max(F.when(own, F.col(c))).alias(c) for c in ("depth", "conv", "parent_conv", "n")), *totals)
    ends = items.where("last").select(F.expr("a ^ x1").alias("a"), F.expr("b ^ x2").alias("b"), "conv")
    ends = ends.repartition("a", "b").sortWithinPartitions("a", "b", "conv").mapInArrow(_end_digests, "a bigint, b bigint, ends string")
    out = nodes.join(ends, ["a", "b"], "left")
    return out.select("conv", "depth", "parent_conv", "n", "children", "leaves", "saved", F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends"))


def grafted(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """The turns of conversations whose first h are those of the conversation ``id - id % every``; h is crc32 of the id modulo ``most``."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.select("conv").distinct().select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("donor"))
    heads = turns.where((F.col("place") < most - 1) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "donor")
    lengths = heads.groupBy("donor").agg(F.count("*").alias("there"))
    convs = staged(convs.join(lengths, "donor", "left").select("conv", "h", "donor", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "trie_grafts")
    taken = convs.where("taken > 0").join(heads, "donor").where("place < taken").select(*turns.columns)
    own = turns.join(convs, "conv").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("taken")).select(*turns.columns)
    return taken.unionByName(own)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    turns = staged(numbered_turns(table(spark, sf_dir, "conversations")), "trie_turns")
    nodes = trie(grafted(turns), turns.select("conv"))
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def prefix_trie_sql(conversations: str) -> str:
    """The same in DuckDB SQL over lists of turns."""
    return rf"""
WITH turns AS (
  SELECT conv_id, sha256(role) || sha256(text) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY t NULLS FIRST, role, text) AS p
  FROM (SELECT conv_id, turn AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {conversations} WHERE conv_id IS NOT NULL)
), heights AS (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS donor, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c, 0 AS own, p, turn, words FROM heights JOIN turns ON conv_id = donor AND p <= h
  UNION ALL SELECT c, 1, p, turn, words FROM heights JOIN turns ON conv_id = c AND p > h
), paths AS (
  SELECT c, coalesce(turns, []) AS turns, coalesce(words, []) AS words
  FROM heights LEFT JOIN (SELECT c, list(turn ORDER BY own, p) AS turns, list(words ORDER BY own, p) AS words FROM rebuilt GROUP BY c) USING (c)
), steps AS (
  SELECT c, d, turns[1 : d] AS node, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, len(turns) = d AS ends
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM paths)
), nodes AS (
  SELECT node, any_value(d) AS d, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends
  FROM steps GROUP BY node
), childless AS (
  SELECT *, node NOT IN (SELECT node[1 : d - 1] FROM nodes WHERE d > 0) AS leaf FROM nodes
), sums AS (
  SELECT up, sum(saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves, count(*) FILTER (WHERE len(up) = d - 1) AS children
  FROM (SELECT *, unnest(list_transform(range(d + 1), lambda k: node[1 : k])) AS up FROM childless) GROUP BY up
)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, p.c AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs, CAST(children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.up = n.node LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1 : n.d - 1]"""


OP12_SQL = prefix_trie_sql("conversations")
