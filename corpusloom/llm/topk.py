"""Exact top-k by inner product over norm-sorted blocks.

Vectors become integers floor(64 * x). All are dealt by descending length to blocks; a rotation by the
eigenvectors of their second moments puts most of each inner product into the first components.
Queries first meet the block of the longest vectors, which gives each a lower limit for its k-th score.
A pair of query block and block goes on only if the largest lengths can reach a limit, and within a
block vectors are taken by descending length in steps: a step ends the block as soon as length times
length is below all limits, and vectors whose partial product plus the Cauchy-Schwarz bound of the rest
stays below the limit are left out. All others are scored exactly, so limits never lose a result.

Query blocks are taken in chunks of ``CHUNK``, and each chunk meets a block in a task of its own. How many blocks
a chunk can need is looked up in the sorted lengths of all blocks, one number each.

Ties go to the smaller ``vec_id``. Vectors that are null or hold null or non-finite components, and rows
without ``vec_id``, take no part; a shorter vector counts as filled up with zeros. Components are kept as the
floating-point numbers that floor gives, and scores are computed in integers as long as they need; a score that
fits no long fails, and so does a component of 2**400 or more, for which no bound can be computed. Rows are told
apart by their place, so repeated rows are candidates of each other. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import in_pieces, runs, staged, table

SCALE = 64
LARGEST = 2.0**400  # of a scaled component, so that squares stay finite
CHUNK = 16  # query blocks that meet a block together, about as many values as it has
MAX_BLOCKS = 1 << 20  # lengths in the table of blocks that tasks get
BLOCK_VALUES = 1 << 20  # components in a block of candidates
QUERY_VALUES = 1 << 16  # in a block of queries
HEAD = 16  # rotated components in the partial product
SLACK = 1e-6  # relative, for the rounding of bounds; scores themselves are exact


def _integers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches, 4096):
        ids, values, norms, sizes = [], [], [], []
        for vec_id, row in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if vec_id is None or not row.is_valid or row.values.null_count:
                continue
            x = np.floor(np.asarray(row.values.to_numpy(zero_copy_only=False), dtype=np.float64) * SCALE)
            if not np.isfinite(np.asarray(row.values.to_numpy(zero_copy_only=False), dtype=np.float64)).all():
                continue
            if (np.abs(x) >= LARGEST).any():
                raise ValueError(f"a component of vector {vec_id} is too large")
            ids.append(vec_id)
            values.append(x.astype("<f8").tobytes())
            norms.append(math.sqrt(float(x @ x)))
            sizes.append(len(x))
        yield pa.RecordBatch.from_pydict(
            {"vec_id": pa.array(ids, pa.int64()), "x": pa.array(values, pa.binary()), "norm": pa.array(norms, pa.float64()), "d": pa.array(sizes, pa.int32())}
        )


def _matrix(rows: list[bytes], d: int) -> np.ndarray:
    out = np.zeros((len(rows), d), dtype=np.float64)
    for i, row in enumerate(rows):
        x = np.frombuffer(row, dtype="<f8")
        out[i, : len(x)] = x
    return out


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """Eigenvectors of the second moments of all vectors, the largest first; d * d sums come to the driver."""

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in in_pieces(batches, 4096):
            m = _matrix(batch.column("x").to_pylist(), d)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(d * d), pa.int64()), "v": pa.array(total.ravel())})

    sums = vectors.select("x").mapInArrow(moments, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    gram = np.zeros(d * d)
    gram[sums["at"].to_numpy()] = sums["v"].to_numpy()
    return np.linalg.eigh(gram.reshape(d, d))[1][:, ::-1].copy()


def _packed(rows: DataFrame, d: int, size: int, keyed: bool) -> DataFrame:
    """Rows of a partition, by descending length, as blocks of at most ``size``: (ids, places, x, longest)."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            ids, places, xs, norms = zip(*held)
            x = _matrix(list(xs), d).astype("<f8")
            return pa.RecordBatch.from_pydict(
                {
                    "ids": pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()),
                    "places": pa.array([np.array(places, dtype="<i8").tobytes()], pa.binary()),
                    "x": pa.array([x.tobytes()], pa.binary()),
                    "longest": pa.array([max(norms)], pa.float64()),
                }
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "place", "x", "norm"))):
                held.append(row)
                if len(held) >= size:
                    yield block()
                    held = []
        if held:
            yield block()

    dealt = rows.select("vec_id", "place", "x", "norm").sortWithinPartitions(F.col("norm").desc(), "place")
    out = dealt.mapInArrow(pack, "ids binary, places binary, x binary, longest double")
    return out.withColumn("block" if keyed else "query_block", F.monotonically_increasing_id())


def _exact(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as integers: by floats where all sums are exact in them, by Python's integers where they may fit no long."""
    d = queries.shape[1]
    most = d * float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
    if most < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    if most < 2**63 and max(np.abs(queries).max(), np.abs(candidates).max()) < 2**63:
        return queries.astype(np.int64) @ candidates.astype(np.int64).T
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object) for m in (queries, candidates)]
    return whole[0] @ whole[1].T


def search_block(queries: np.ndarray, own: np.ndarray, limits: np.ndarray, ids: np.ndarray, places: np.ndarray, candidates: np.ndarray, turn: np.ndarray, k: int):
    """(query number, id, score) of the k best of the candidates, given by descending length, for each query; below ``limits`` none.

    ``own`` are the places of the queries, which no query finds.
    """
    rotated_q = queries @ turn
    rotated_c = candidates @ turn
    head = min(HEAD, queries.shape[1])
    rest_q, rest_c = np.linalg.norm(rotated_q[:, head:], axis=1), np.linalg.norm(rotated_c[:, head:], axis=1)
    norm_q, norm_c = np.linalg.norm(queries, axis=1), np.linalg.norm(candidates, axis=1)
    limits = limits.astype(np.float64).copy()
    slack = SLACK * (1 + norm_q * (norm_c[0] if len(norm_c) else 0))
    best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    at, step = 0, 4 * k
    while at < len(candidates):
        open_q = np.flatnonzero(norm_q * norm_c[at] + slack >= limits)
        if len(open_q) == 0:
            break
        end = min(len(candidates), at + step)
        partial = rotated_q[open_q, :head] @ rotated_c[at:end, :head].T + rest_q[open_q, None] * rest_c[None, at:end]
        hopeful = partial + slack[open_q, None] >= limits[open_q, None]
        rows, columns = np.flatnonzero(hopeful.any(axis=1)), np.flatnonzero(hopeful.any(axis=0))
        if len(rows):
            scores = _exact(queries[open_q[rows]], candidates[at + columns])
            others = own[open_q[rows], None] != places[None, at + columns]
            a, b = np.nonzero(hopeful[np.ix_(rows, columns)] & others & (scores >= limits[open_q[rows], None]).astype(bool))
            new = scores[a, b]
            if new.dtype == object:
                if any(not -(1 << 63) <= x < 1 << 63 for x in new):
                    raise ValueError("a score does not fit a long")
                new = new.astype(np.int64)
            found = (open_q[rows][a], ids[at + columns[b]], new)
            q, i, s = (np.concatenate(x) for x in zip(best, found))
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            first = np.searchsorted(q, q, side="left")
            rank = np.arange(len(q)) - first
            full = rank == k - 1
            limits[q[full]] = np.maximum(limits[q[full]], s[full])
            best = tuple(x[rank < k] for x in (q, i, s))
        at, step = end, min(2048, 2 * step)
    return best


def _search(batches: Iterable[pa.RecordBatch], d: int, turn: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Rows by block and chunk: the block first, then the queries that it may serve."""
    at, ids, places, candidates = None, None, None, None
    for batch in batches:
        for row in in_pieces([batch], 1):
            key = row.column("block")[0].as_py(), row.column("chunk")[0].as_py()
            x = np.frombuffer(row.column("x")[0].as_buffer(), dtype="<f8").reshape(-1, d)
            own, own_places = (np.frombuffer(row.column(c)[0].as_buffer(), dtype="<i8") for c in ("ids", "places"))
            if row.column("kind")[0].as_py() == 0:
                at, ids, places, candidates = key, own, own_places, x
                continue
            if key != at:
                raise RuntimeError("a block is missing")
            raw = row.column("limits")[0]
            limits = np.frombuffer(raw.as_buffer(), dtype="<f8") if raw.is_valid else np.full(len(own), -np.inf)
            q, i, s = search_block(x, own_places, limits, ids, places, candidates, turn, k)
            yield pa.RecordBatch.from_pydict({"place": pa.array(own_places[q]), "query_id": pa.array(own[q]), "vec_id": pa.array(i), "score": pa.array(s)})


FOUND = "place bigint, query_id bigint, vec_id bigint, score bigint"


def _meet(blocks: DataFrame, queries: DataFrame, d: int, turn: np.ndarray, k: int) -> DataFrame:
    """Best candidates for queries that carry the number of a block, for each block and chunk of queries in a task of their own."""
    columns = ["block", "chunk", "kind", "ids", "places", "x", "limits"]
    met = queries.select("block", "chunk").distinct()
    left = blocks.join(met, "block").withColumn("kind", F.lit(0)).withColumn("limits", F.lit(None).cast("binary")).select(*columns)
    right = queries.withColumn("kind", F.lit(1)).select(*columns)
    dealt = left.unionByName(right).repartition("block", "chunk").sortWithinPartitions("block", "chunk", "kind")
    return dealt.mapInArrow(lambda batches: _search(batches, d, turn, k), FOUND)


def top_k(df: DataFrame, k: int, is_query, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, embedding) where ``is_query`` holds, over all other rows."""
    spark = df.sparkSession
    raw = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    vectors = staged(raw.mapInArrow(_integers, "vec_id bigint, x binary, norm double, d int"), "vectors")
    vectors = vectors.withColumn("place", F.monotonically_increasing_id())
    n, d = vectors.agg(F.count("*"), F.max("d")).first()
    if not n or not d:
        d = max(1, d or 0)
    turn = rotation(vectors, d) if n else np.eye(d)
    size, query_size = max(64, block_values // d), max(16, QUERY_VALUES // d)

    ranged = vectors.repartitionByRange(max(1, -(-n // size)), F.col("norm").desc(), F.xxhash64("vec_id", "place"))
    blocks = staged(_packed(ranged, d, size, True), "vector_blocks")
    asked = vectors.where(is_query)
    asked = asked.repartitionByRange(max(1, -(-n // 20 // query_size)), F.col("norm").desc(), F.xxhash64("vec_id", "place"))
    queries = staged(_packed(asked, d, query_size, False), "query_blocks")

    # The first block that a query meets is that of the longest vectors.
    queries = queries.withColumn("chunk", F.floor(F.shiftright("query_block", 33) / CHUNK).cast("bigint"))
    lengths = blocks.select("longest", "block").collect() if n <= MAX_BLOCKS * size else None  # one number for each block
    if lengths is None:
        raise ValueError(f"more than {MAX_BLOCKS} blocks: use larger block_values")
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    lengths = sorted(lengths, key=lambda r: (-r["longest"], r["block"]))
    first = lengths[0]["block"]
    start = queries.withColumn("block", F.lit(first)).withColumn("limits", F.lit(None).cast("binary"))
    begun = staged(_meet(blocks.where(F.col("block") == first), start, d, turn, k), "first_scores")

    by_rank = Window.partitionBy("place").orderBy(F.col("score").desc(), "vec_id")
    limits = begun.withColumn("r", F.row_number().over(by_rank)).where(F.col("r") == k).select("place", F.col("score").alias("limit"))
    queries = staged(_with_limits(queries, limits), "query_limits")
    served = _served(queries, [(r["block"], r["longest"]) for r in lengths[1:]])
    rest = _meet(blocks.where(F.col("block") != first), served, d, turn, k)
    found = begun.unionByName(rest).withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _served(queries: DataFrame, blocks: list[tuple[int, float]]) -> DataFrame:
    """Each query block once for each block that can reach its least limit; blocks are sorted by descending length."""
    numbers = np.array([b for b, _ in blocks], dtype=np.int64)
    shortest_last = np.array([length for _, length in blocks], dtype=np.float64)

    def reached(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, chunk, longest, least in zip(*(batch.column(c).to_pylist() for c in ("query_block", "chunk", "longest", "least"))):
                enough = longest * shortest_last * (1 + SLACK) + SLACK >= least
                cut = int(np.searchsorted(~enough, True)) if len(enough) else 0
                yield pa.RecordBatch.from_pydict({"query_block": pa.array(np.full(cut, block)), "chunk": pa.array(np.full(cut, chunk)), "block": pa.array(numbers[:cut])})

    pairs = queries.select("query_block", "chunk", "longest", "least").mapInArrow(reached, "query_block bigint, chunk bigint, block bigint")
    return pairs.join(queries.select("query_block", "ids", "places", "x", "limits"), "query_block")


def _with_limits(queries: DataFrame, limits: DataFrame) -> DataFrame:
    """Query blocks with the limits of their rows, and the least one."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("query_block").to_pylist(), batch.column("places").to_pylist()):
                own = np.frombuffer(raw, dtype="<i8")
                yield pa.RecordBatch.from_pydict(
                    {"query_block": pa.array(np.full(len(own), block)), "at": pa.array(np.arange(len(own))), "place": pa.array(own)}
                )

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["query_block"]):
            own = np.array([-np.inf if x is None else x for x in group.column("limit").to_pylist()], dtype="<f8")
            yield pa.RecordBatch.from_pydict(
                {
                    "query_block": pa.array([group.column("query_block")[0].as_py()], pa.int64()),
                    "limits": pa.array([own.tobytes()], pa.binary()),
                    "least": pa.array([float(own.min())]),
                }
            )

    rows = queries.select("query_block", "places").mapInArrow(places, "query_block bigint, at bigint, place bigint")
    rows = rows.join(limits, "place", "left").select("query_block", "at", F.col("limit").cast("double").alias("limit"))
    rows = rows.repartition("query_block").sortWithinPartitions("query_block", "at")
    return queries.join(rows.mapInArrow(joined, "query_block bigint, limits binary, least double"), "query_block")


K = 20


def op9_top_k(spark, sf_dir: str) -> DataFrame:
    """The 20 best of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), K, F.col("vec_id") % 20 == 0)


OP9_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= {K}"""
