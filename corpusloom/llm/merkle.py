"""A Merkle manifest of a dataset: a content-addressed graph of digests, and proofs by descent from its root.

The leaf of a row is H of its fields; H is the lowercase hex SHA-256 of its inputs one after the
other. The leaves of a source, by id, are the bottom of a tree in which every ``BRANCH`` consecutive nodes
become one, until one is left, the source's subroot; the subroots, by source, become the root alike.

- **Building.** Nodes are numbered by position and cut into segments of ``BRANCH ** LEVELS``. One task
  builds a segment and stores a record (digest, children) for every node in it; the tops of the
  segments are the nodes of the next round, so the rounds grow with the logarithm of the largest source.
- **Proving.** Requests descend from the root. In each round the records of a segment and the requests
  for its nodes meet; the digits of a request's rank select a child at each level, by digest, and the other
  children are collected. The steps of a segment are put, in reverse, before those of the segments above it.

A proof step is the hex digests left and right of the selected child; either may be empty. Ids are ordered null
first, and rows that repeat an id by their leaf; repeated rows are leaves of their own. A null source
is a source. A null field is ``-`` in the leaf. An empty table has no leaf, no root and no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import crc32_sql, staged, table
from corpusloom.llm.order import positions

BRANCH = 3
LEVELS = 6
SEGMENT = BRANCH**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots has this one name; those of sources are "-" or "=" and the source.
TOP = ""


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """H of the values, each by its UTF-8 length, a colon and itself, null as ``-``."""
    return F.sha2(F.concat(*(_field(v) for v in values)).cast("binary"), 256)


def _digest(children: Iterable[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _segment_levels(nodes: list[str], alone: bool) -> Iterator[list[str]]:
    """The levels above the nodes of a segment; one that is a tree of its own ends at its single node."""
    for _ in range(LEVELS):
        if alone and len(nodes) == 1:
            return
        nodes = [_digest(nodes[i : i + BRANCH]) for i in range(0, len(nodes), BRANCH)]
        yield nodes


def _by_segment(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[dict]]]:
    """(tree, segment, its rows in order) of rows sorted by tree and segment."""
    rows = (row for batch in batches for row in batch.to_pylist())
    held = next(rows, None)
    while held is not None:
        key = held["tree"], held["segment"]

        def group():
            nonlocal held
            while held is not None and (held["tree"], held["segment"]) == key:
                yield held
                held = next(rows, None)

        inside = group()
        yield *key, inside
        for _ in inside:
            pass


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for tree, segment, group in _by_segment(batches):
            nodes = [row["digest"] for row in group]
            alone = segment == 0 and len(nodes) < SEGMENT
            for height, level in enumerate(_segment_levels(nodes, alone), 1):
                for i, digest in enumerate(level):
                    yield tree, segment, height, digest, nodes[i * BRANCH : (i + 1) * BRANCH], False
                nodes = level
            yield tree, segment, 0, nodes[0], None, True

    yield from _batches(rows(), RECORDS)


RECORDS = pa.schema(
    [("tree", pa.string()), ("segment", pa.int64()), ("height", pa.int32()), ("digest", pa.string()), ("children", pa.list_(pa.string())), ("top", pa.bool_())]
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _spark_schema(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


@dataclass
class Round:
    """The nodes of a round (tree, rank, digest; at the bottom also row) and the records (tree, segment, height, digest, children) above them."""

    nodes: DataFrame
    records: DataFrame


def build(leaves: DataFrame) -> tuple[list[Round], DataFrame]:
    """The rounds of the trees over (tree, rank, digest, row), and the single node of each tree, (tree, rank, digest)."""
    rounds, nodes = [], leaves
    while True:
        cut = nodes.withColumn("segment", F.floor(F.col("rank") / SEGMENT))
        dealt = cut.repartition("tree", "segment").sortWithinPartitions("tree", "segment", "rank")
        built = staged(dealt.mapInArrow(_build, _spark_schema(RECORDS)), "merkle_records")
        rounds.append(Round(nodes, built.where("NOT top").drop("top")))
        nodes = built.where("top").select("tree", F.col("segment").alias("rank"), "digest")
        if nodes.where("rank > 0").isEmpty():
            return rounds, nodes


def _descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments, each its path row, its records and its requests, to the paths of the requests."""
    batches = iter(batches)
    head = next(batches, None)
    if head is None:
        return
    schema = pa.schema([head.schema.field(c) for c in PATH])

    def rows():
        for tree, _, group in _by_segment(chain([head], batches)):
            records: dict[str, list[str]] = {}
            height = 0
            for row in group:
                if row["kind"] == 0:
                    above = row
                elif row["kind"] == 1:
                    records[row["digest"]] = row["children"]
                    height = max(height, row["height"])
                else:
                    at, left, right = above["digest"], [], []
                    for level in range(height - 1, -1, -1):
                        digit = row["rank"] // BRANCH**level % BRANCH
                        children = records[at]
                        left.append("".join(children[:digit]))
                        right.append("".join(children[digit + 1 :]))
                        at = children[digit]
                    if at != row["digest"]:
                        raise ValueError(f"the descent to {row['rank']} of {tree!r} ends at another digest")
                    yield tree, row["rank"], at, left[::-1] + above["left"], right[::-1] + above["right"], above["under"], row["row"]

    yield from _batches(rows(), schema, 1024)


#: under: the digests of the roots above, as the path of the top node has them; row: what a request carries along.
PATH = ("tree", "rank", "digest", "left", "right", "under", "row")


def descend(rounds: list[Round], tops: DataFrame) -> DataFrame:
    """From the paths of the top nodes (all of ``PATH`` but ``row``) to those of all leaves; steps stand leaf side first."""
    paths = tops
    for k, at in reversed(list(enumerate(rounds))):
        nodes = at.nodes if "row" in at.nodes.columns else at.nodes.withColumn("row", F.struct("rank"))
        types = {**dict(paths.dtypes), **dict(nodes.dtypes), "children": "array<string>", "height": "int"}

        def shaped(df: DataFrame, kind: int, segment: Column) -> DataFrame:
            columns = [(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in (*PATH, "children", "height")]
            return df.select(*columns, segment.cast("bigint").alias("segment"), F.lit(kind).alias("kind"))

        requests = shaped(nodes, 2, F.floor(F.col("rank") / SEGMENT))
        met = shaped(paths.drop("row"), 0, F.col("rank")).unionByName(shaped(at.records, 1, F.col("segment"))).unionByName(requests)
        met = met.repartition("tree", "segment").sortWithinPartitions("tree", "segment", "kind")
        found = met.mapInArrow(_descend, ", ".join(f"`{c}` {types[c]}" for c in PATH))
        paths = staged(found.drop("row"), "merkle_paths") if k else found
    return paths


def tree_name(source: Column) -> Column:
    """A name of each source that is not null and keeps the order of sources, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def manifest(df: DataFrame, leaf: Column, key: str, source: str, also: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``df``: its key, ``leaf``, ``subroot``, ``root``, the columns ``also``, and its proof.

    The proof is ``left`` and ``right``, the hex digests beside the node on each level, leaf side first.
    """
    also = also or {}
    row = F.struct(F.col(f"`{key}`").alias("key"), *(c.alias(n) for n, c in also.items())).alias("row")
    leaves = staged(df.select(row, tree_name(F.col(f"`{source}`")).alias("tree"), leaf.alias("digest")), "merkle_leaves")
    ranked = staged(positions(leaves, "tree", ["row.key", "digest"], leaves.columns, "rank"), "merkle_ranked")
    rounds, subroots = build(ranked)
    named = subroots.select(F.lit(TOP).alias("tree"), "digest", F.struct(F.col("tree").alias("name"), F.col("digest").alias("subroot")).alias("row"))
    upper = staged(positions(named, "tree", ["row.name"], named.columns, "rank"), "merkle_subroots")
    upper_rounds, roots = build(upper)
    no_step = F.array().cast("array<string>")
    of_root = F.struct(F.col("digest").alias("root")).alias("under")
    found = descend(upper_rounds, roots.select("tree", "rank", "digest", no_step.alias("left"), no_step.alias("right"), of_root))
    under = F.struct("row.subroot", "under.root").alias("under")
    tops = found.select(F.col("row.name").alias("tree"), F.lit(0).cast("bigint").alias("rank"), "digest", "left", "right", under)
    paths = descend(rounds, staged(tops, "merkle_tops"))
    return paths.select(F.col("row.key").alias(key), F.col("digest").alias("leaf"), "under.subroot", "under.root", *(F.col(f"row.{n}").alias(n) for n in also), "left", "right")


def proof_digest(left: Column, right: Column) -> Column:
    """H of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "").cast("binary"), 256)


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and its proof give."""
    steps = F.arrays_zip(left.alias("left"), right.alias("right"))
    return F.aggregate(steps, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]).cast("binary"), 256))


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and the roots that their leaves give after tampering."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    given = [F.col(c) for c in FIELDS]
    found = manifest(docs, leaf_digest(*given), "doc_id", "source", {"tampered": leaf_digest(*given[:-1], bare)})
    out = found.withColumn("folded_root", folded(F.col("tampered"), F.col("left"), F.col("right")))
    return out.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def merkle_sql(documents: str, levels: int = 12) -> str:
    """The same in DuckDB SQL: the levels of a tree are lists, enough of them for 3 ** ``levels`` leaves."""

    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*(field(c) for c in FIELDS[:-1]), field(text)]) + ")"

    def tree(below: str, top: str) -> str:
        for k in range(levels):
            below = f"""
SELECT *, CASE WHEN len(l{k}) = 1 THEN l{k} ELSE list_transform(range((len(l{k}) + 2) // 3), lambda i: sha256(array_to_string(l{k}[3 * i + 1 : 3 * i + 3], ''))) END AS l{k + 1}
FROM ({below})"""
        return f"SELECT *, l{levels}[1] AS {top} FROM ({below})"

    def step(level: str, k: int, n: str) -> str:
        first, at = f"3 * ({n} // {3 ** (k + 1)})", f"({n} // {3**k})"
        left, right = (f"array_to_string({level}[{part}], '')" for part in (f"{first} + 1 : {at}", f"{at} + 2 : {first} + 3"))
        one = f"len({level}) = 1"
        return f"{{'o': {one}, 'a': CASE WHEN {one} THEN '' ELSE {left} END, 'b': CASE WHEN {one} THEN '' ELSE {right} END}}"

    def steps(of: str, n: str) -> str:
        return "[" + ", ".join(step(f"{of}.l{k}", k, n) for k in range(levels)) + "]"

    fold = "list_reduce(steps, lambda x, s: {'o': s.o, 'a': CASE WHEN s.o THEN x.a ELSE sha256(s.a || x.a || s.b) END, 'b': ''}, {'o': false, 'a': tampered, 'b': ''}).a"
    even = crc32_sql("CAST(doc_id AS VARCHAR)") + " % 2 = 0"
    return f"""
WITH leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {even} THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS tampered,
  FROM {documents}
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n FROM leaves
), trees AS ({tree("SELECT source, list(leaf ORDER BY n) AS l0 FROM ranked GROUP BY source", "subroot")}
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS m FROM trees
), upper AS ({tree("SELECT list(subroot ORDER BY m) AS l0 FROM numbered", "root")}
), ups AS (
  SELECT t.m, root, {steps("upper", "t.m")} AS up FROM upper, numbered t
), proofs AS (
  SELECT doc_id, leaf, tampered, t.subroot, u.root, list_concat({steps("t", "r.n")}, u.up) AS steps
  FROM ranked r JOIN numbered t ON r.source IS NOT DISTINCT FROM t.source JOIN ups u ON t.m = u.m
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s.a || s.b), '')) AS proof_sha256,
  {fold} AS folded_root, {fold} = root AS verified
FROM proofs"""


OP11_SQL = merkle_sql("documents")
