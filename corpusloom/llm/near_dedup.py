"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts gives, for each document, a hash of its set of word shingles, the minima of
   128 hash functions as packed low bytes, and a key for each band of the full minima. Documents with
   equal sets form a class, which has a number of its own from there on.
2. Classes that share a band key are compared by their packed signatures: exclusive or and bit counts give the
   lanes that differ, and the share of equal ones, corrected for chance collisions, estimates the similarity. The limit lies five standard errors below
   the threshold. Of a bucket only the links of a spanning forest go on, never all pairs.
3. The components of these links are candidate groups. Their full sets are compared group by group,
   and links that the full sets confirm give the components of the result.

Buckets and groups of any size are worked on in pairs of bounded blocks. At the threshold a band misses
fewer than one pair in a million, and the estimate as well.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z. A text with fewer words than a shingle has one
shingle of all its words; a null text and one without words have none, and link with nothing. Rows
without an id get a component only through equal texts that have one. Rows that repeat an id with
another text keep the classes of their texts, which an id never links; a component is named by its smallest id, so
two may have one name. Texts are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import worker_cache
from corpusloom.llm.common import in_pieces, runs, staged, table, texts
from corpusloom.llm.components import components
from corpusloom.llm.words import mix, shingle_set, word_hashes

HASHES = 128
LANES = np.uint64(0x0101010101010101)
CHUNK = 1024
SIGNATURE_BLOCK = 512  # classes of a bucket in a block
SET_BLOCK = 256  # classes of a group in a block
SET_BLOCK_SHINGLES = 1 << 18
BROADCAST_IDS = 500_000


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(41))
    return rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    a, b = _FUNCTIONS
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), CHUNK):
        np.minimum(out, (shingles[at : at + CHUNK, None] * a + b).min(axis=0), out=out)
    return out


_FUNCTIONS = _functions()


def band_rows(percent: int) -> int:
    """Minima in a band: all 128 hashes give bands of this height, fewer rows for lower thresholds."""
    return 5 if percent >= 85 else 4 if percent >= 75 else 3


def _sign(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    worker_cache("near_dedup")  # lets those of earlier steps go
    bands = HASHES // rows
    for batch in in_pieces(batches, 1024):
        keys, sizes, signatures, band_keys = [], [], [], []
        for text in texts(batch.column("text")):
            shingles = shingle_set(word_hashes(text or b""))
            sizes.append(len(shingles))
            if len(shingles) == 0:
                keys.append(None)
                signatures.append(None)
                band_keys.append(None)
                continue
            low = minima(shingles)
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            signatures.append((low & np.uint64(255)).astype(np.uint8).tobytes())
            grid = low[: bands * rows].reshape(bands, rows)
            key = np.arange(1, bands + 1, dtype=np.uint64)
            for k in range(rows):
                key = mix(key ^ grid[:, k])
            band_keys.append(key.astype(np.int64))
        yield pa.RecordBatch.from_pydict(
            {
                **{c: batch.column(c) for c in ("doc_id", "t1", "t2")},
                "key": pa.array(keys, pa.binary()),
                "n": pa.array(sizes, pa.int64()),
                "signature": pa.array(signatures, pa.binary()),
                "bands": pa.array(band_keys, pa.list_(pa.int64())),
            }
        )


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    free = np.ones(n, dtype=bool)
    out = []
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        stack = [root]
        while stack:
            at = stack.pop()
            found = np.flatnonzero(linked[at] & free)
            free[found] = False
            out += [(at, int(x)) for x in found]
            stack += found.tolist()
    return out


def _edges(batches: Iterable[pa.RecordBatch], keys: list[str], compare) -> Iterator[pa.RecordBatch]:
    """Spanning links of each block pair; rows of one block are compared with each other only where lo = hi."""
    a, b = [], []
    for group in runs(batches, keys):
        if group.num_rows > 1:
            nodes = group.column("node").to_numpy()
            linked = compare(group)
            lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
            if lo != hi:
                block = group.column("block").to_numpy()
                linked &= block[:, None] != block[None, :]
            for x, y in _forest(linked):
                if nodes[x] != nodes[y]:
                    a.append(int(nodes[x]))
                    b.append(int(nodes[y]))
        if len(a) > 10_000:
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
            a, b = [], []
    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def estimates(group: pa.Table) -> np.ndarray:
    """Collision-corrected similarity of all pairs of packed signatures."""
    packed = np.frombuffer(b"".join(group.column("signature").to_pylist()), dtype=np.uint64).reshape(group.num_rows, HASHES // 8)
    equal = np.empty((len(packed), len(packed)), dtype=np.int16)
    for i, row in enumerate(packed):
        differ = packed ^ row
        for shift in (4, 2, 1):  # any bit of a lane of eight to its lowest one
            differ |= differ >> np.uint64(shift)
        equal[i] = HASHES - np.bitwise_count(differ & LANES).sum(axis=1)
    chance = 1 / 256
    return (equal / HASHES - chance) / (1 - chance)


def similar(group: pa.Table, percent: int) -> np.ndarray:
    """For all pairs of full sets: 100 * intersection >= percent * union."""
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    n = len(sets)
    common = np.zeros((n, n), dtype=np.float64)
    if n == 2:
        common[0, 1] = common[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(n), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        new = np.r_[True, values[1:] != values[:-1]]
        column = np.cumsum(new) - 1
        shared = np.bincount(column)[column] > 1
        column, owner = column[shared], owner[shared]
        cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 if len(column) else 0, 2048)).tolist() + [len(column)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                own = column[start:end]
                grid = np.zeros((n, int(own[-1] - own[0]) + 1), dtype=np.float32)
                grid[owner[start:end], own - own[0]] = 1
                common += grid @ grid.T
    union = sizes[:, None] + sizes[None, :] - common
    out = 100 * common >= percent * union
    np.fill_diagonal(out, False)
    return out


def _blocks(rows: DataFrame, blocks, node: str = "node") -> DataFrame:
    """Each row once for each pair of blocks that its block is in: lo <= hi."""
    rows = rows.withColumn("_n", blocks).withColumn("block", F.pmod(F.xxhash64(node), F.col("_n")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
    return rows.withColumn("lo", F.least("block", "_other")).withColumn("hi", F.greatest("block", "_other")).drop("_n", "_other")


def _grouped(rows: DataFrame, keys: list[str], compare) -> DataFrame:
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(lambda batches: _edges(batches, keys, compare), "a bigint, b bigint")


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches, 512):
        found = [shingle_set(word_hashes(t or b"")).tobytes() for t in texts(batch.column("text"))]
        columns = {c: batch.column(c) for c in ("node", "group", "n")}
        yield pa.RecordBatch.from_pydict({**columns, "shingles": pa.array(found, pa.large_binary()).cast(pa.binary())})


def sized(ids: DataFrame) -> DataFrame:
    """A table of ids for a join: sent to all tasks if it has at most ``BROADCAST_IDS`` rows, else shuffled."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _decided(df: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, t1, t2, n, component_id, first) of all rows: t1 and t2 are hashes of the text, first is said of one of them in each component."""
    texts_ = F.col(f"`{text}`")
    docs = df.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), texts_.alias("text"), *_text_hashes(texts_))
    rows = band_rows(percent)
    limit = percent / 100 - 5 * math.sqrt(percent / 100 * (1 - percent / 100) / HASHES)
    columns = "doc_id bigint, t1 bigint, t2 bigint, key binary, n bigint, signature binary, bands array<bigint>"
    signed = staged(docs.mapInArrow(lambda batches: _sign(batches, rows), columns), "signed")
    # Rows of a class have one set, so any of them has its signature; its first row is the one with the smallest id.
    of_class = signed.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key")
    classes = of_class.agg(F.min(F.struct("doc_id", "t1", "t2")).alias("first"), *(F.first(c).alias(c) for c in ("n", "signature", "bands")))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    # Buckets with more than one class, their members with packed bytes, and candidate links.
    bands = classes.select("node", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    members = bands.join(buckets, "band").join(classes.select("node", "signature"), "node")
    members = _blocks(members, F.ceil(F.col("m") / SIGNATURE_BLOCK).cast("bigint"))
    members = members.select("band", "lo", "hi", "block", "node", "signature")
    candidates = staged(_grouped(members, ["band", "lo", "hi"], lambda g: estimates(g) >= limit), "candidates")
    groups = components(candidates).select("node", F.col("component").alias("group"))

    # The full sets of the classes in groups, and the links that they confirm.
    inside = staged(groups.join(classes.select("node", "first", "n"), "node"), "groups")
    found = docs.join(sized(inside.select("node", "group", "n", "first.*")), ["doc_id", "t1", "t2"])
    sets = found.select("node", "group", "n", "text").mapInArrow(_sets, "node bigint, group bigint, n bigint, shingles binary")
    weights = inside.groupBy("group").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    blocks = F.greatest(F.ceil(F.col("m") / SET_BLOCK), F.ceil(F.col("w") / SET_BLOCK_SHINGLES)).cast("bigint")
    sets = _blocks(sets.join(weights, "group"), blocks).select("group", "lo", "hi", "block", "node", "shingles")
    links = staged(_grouped(sets, ["group", "lo", "hi"], lambda g: similar(g, percent)), "confirmed")
    linked = components(links)

    named = classes.select("key", "node", "first").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = named.groupBy("component").agg(F.min("first").alias("of_all"))
    named = named.join(firsts, "component").select("key", "of_all")
    out = signed.select("doc_id", "t1", "t2", "key", "n").join(named, "key", "left")
    first = F.struct("doc_id", "t1", "t2") == F.col("of_all")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("of_all.doc_id"))
    return out.select("doc_id", "t1", "t2", "n", component.alias("component_id"), (F.col("key").isNull() | F.coalesce(first, F.lit(False))).alias("first"))


def _text_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def near_duplicates(df: DataFrame, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents whose sets have a Jaccard similarity of ``percent`` or more are linked."""
    out = _decided(df, percent, doc_id, text)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(df: DataFrame, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near copies: of each component one row with its smallest id stays.

    Rows without an id or without words stay. A row goes by its id and its text, so other rows of its id stay.
    """
    decided = staged(_decided(df, percent, doc_id, text).where("doc_id IS NOT NULL"), "near_copies")
    names = ["_near_id", "_near_t1", "_near_t2"]

    def keys(rows: DataFrame) -> DataFrame:
        return sized(rows.select(*(F.col(c).alias(n) for c, n in zip(("doc_id", "t1", "t2"), names))))

    copies = keys(decided.where("NOT first").select("doc_id", "t1", "t2").distinct())
    repeated = keys(decided.where("first AND n > 0").groupBy("doc_id", "t1", "t2").agg(F.count("*").alias("m")).where("m > 1"))
    given = [F.col(f"`{c}`") for c in df.columns]
    hashes = [h.alias(n) for h, n in zip(_text_hashes(F.col(f"`{text}`")), names[1:])]
    rows = df.select(F.struct(*given).alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias(names[0]), *hashes)
    kept = rows.join(copies, names, "left_anti")
    once = kept.join(repeated, names, "left_semi").dropDuplicates(names)
    return kept.join(repeated, names, "left_anti").unionByName(once).select("row.*")


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of all documents at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), 85)


def near_dedup_sql(documents: str, percent: int) -> str:
    """(doc_id, n_shingles, component_id, kept) in DuckDB SQL, from exact sets of whole texts."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM {documents}),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM words),
classes AS (SELECT s, row_number() OVER () AS node, least, len(s) AS n
  FROM (SELECT s, min(doc_id) AS least FROM sets WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY s)),
tokens AS (SELECT node, n, unnest(s) AS t FROM classes),
pairs AS (SELECT a.node AS a, b.node AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT node AS a, node AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
named AS (SELECT a AS node, min(least) AS component_id FROM reach JOIN classes ON b = node GROUP BY a)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, CASE WHEN len(sets.s) = 0 THEN doc_id ELSE component_id END AS component_id,
  doc_id IS NOT DISTINCT FROM (CASE WHEN len(sets.s) = 0 THEN doc_id ELSE component_id END) AS kept
FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN named USING (node)"""


OP3_SQL = near_dedup_sql("documents", 85)
