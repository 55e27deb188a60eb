"""A uniform shuffle into shards of exact size, from a hypergeometric communication matrix.

1. The rows are staged, so that the partitions, their order and their counts are fixed.
2. The matrix says how many rows of each partition go to each shard. Its rows follow the multivariate
   hypergeometric law, so it is the matrix of a uniform permutation with these shard sizes. It is drawn
   in two levels: the driver draws for at most ``GROUPS`` groups of partitions, and one task for each
   group draws for its partitions. All draws come from seeds made of ``seed`` and the place.
3. Each partition permutes its rows by a keyed hash of their places and deals them out by the matrix.
4. One exchange brings the rows to blocks of their shard, which are permuted again; the place in the
   shard is the place in the block after the rows of the blocks before it.

The law is ``rows``: shard sizes are at most one apart. Equal rows, ties and null columns make no
difference, as a row is named by its place; an empty table gives an empty table. Input columns named
``shard`` or ``slot`` are replaced by the result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import staged, table

GROUPS = 1024
PLACE_BITS = 33  # of monotonically_increasing_id: the place in the partition
BLOCK_ROWS = 1 << 18


def draw(counts: np.ndarray, sizes: np.ndarray, seed: list[int]) -> np.ndarray:
    """One row for each count: how many of its items go to each shard, all together filling ``sizes``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(sizes, dtype=np.int64)
    out = np.zeros((len(counts), len(left)), dtype=np.int64)
    for i, n in enumerate(counts):
        # "marginals" works one shard after the other: its time doesn't depend on the counts.
        out[i] = _marginals(rng, left, int(n))
        left -= out[i]
    return out


def _marginals(rng, left: np.ndarray, n: int) -> np.ndarray:
    """One shard after the other, each from what the shards before it leave."""
    out = np.zeros(len(left), dtype=np.int64)
    rest = int(left.sum())
    for j, size in enumerate(left):
        if n == 0:
            break
        rest -= int(size)
        out[j] = _hypergeometric(rng, int(size), rest, n)
        n -= out[j]
    return out


def _hypergeometric(rng, good: int, bad: int, n: int) -> int:
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if good + bad else 0
    return _by_weights(rng, good, bad, n)


def _by_weights(rng, good: int, bad: int, n: int) -> int:
    """The same law beyond numpy's range: by the quotients of neighbouring probabilities, summed up around the mode.

    What lies more than twelve deviations from it is less likely than the last digit of a random number.
    """
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    mode = (n + 1) * (good + 1) // (total + 2)
    reach = 50 + math.ceil(12 * math.sqrt(n * (good / total) * (bad / total)))
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) * (n - k[:-1])) - np.log((k[:-1] + 1) * (bad - n + k[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(int(np.searchsorted(weights, rng.random() * weights[-1], side="right")), len(k) - 1)])


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """From (part, n): (part, bounds), where rows of a partition with place < bounds[j], and no lower one, go to shard j."""
    spark = counts.sparkSession
    parts = counts.count()
    per_group = max(1, math.ceil(parts / GROUPS))
    order = Window.orderBy("part")
    if parts > GROUPS:  # partition numbers have no gaps to speak of, so they give the group themselves
        grouped = counts.withColumn("g", F.floor(F.col("part") / per_group).cast("bigint"))
    else:
        grouped = counts.withColumn("g", F.row_number().over(order).cast("bigint"))
    totals = grouped.groupBy("g").agg(F.sum("n").alias("n")).orderBy("g").collect()
    n = sum(r["n"] for r in totals)
    sizes = np.array([n // shards + (j < n % shards) for j in range(shards)], dtype=np.int64)
    quotas = draw(np.array([r["n"] for r in totals]), sizes, [seed, 0])
    quota_rows = [(int(r["g"]), [int(x) for x in q]) for r, q in zip(totals, quotas)]
    quota = spark.createDataFrame(quota_rows, "g bigint, quota array<bigint>")

    def of_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        made = draw(rows["n"].to_numpy(), np.array(rows["quota"].iloc[0]), [seed, 1, int(rows["g"].iloc[0])])
        return pd.DataFrame({"part": rows["part"], "bounds": list(np.cumsum(made, axis=1))})

    return grouped.join(quota, "g").groupBy("g").applyInPandas(of_group, "part bigint, bounds array<bigint>")


def shard(df: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    given = [c for c in df.columns if c not in ("shard", "slot")]
    fixed = staged(df.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(given))), "sharding")
    place = F.monotonically_increasing_id()
    mask = F.lit((1 << PLACE_BITS) - 1)
    rows = fixed.select("*", place.alias("_place")).withColumn("part", F.shiftright("_place", PLACE_BITS))
    counts = staged(rows.groupBy("part").agg(F.count("*").alias("n")), "shard_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    bounds = staged(communication_matrix(counts, shards, seed), "shard_bounds") if total else None
    blocks = max(16, math.ceil(total / shards / block_rows))
    if bounds is None:
        return df.select(*(F.col(f"`{c}`") for c in given), F.lit(None).cast("int").alias("shard"), F.lit(None).cast("bigint").alias("slot"))

    # The first permutation: rows of a partition by a hash of their place, numbered again.
    first = rows.withColumn("_key", F.xxhash64(F.lit(seed), F.lit(1), "_place")).sortWithinPartitions("_key", "_place")
    dealt = first.withColumn("_dealt", F.monotonically_increasing_id().bitwiseAND(mask))
    dealt = dealt.join(bounds, "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("bounds", lambda b: b <= F.col("_dealt"))))
    dealt = dealt.withColumn("shard", F.when(F.col("shard") < shards, F.col("shard")).otherwise(F.raise_error(F.lit("partitions changed between two reads")).cast("int")))
    # The second one: a hash gives the block, and the order in it.
    key = F.xxhash64(F.lit(seed), F.lit(2), "_place")
    dealt = dealt.withColumn("_key", key).withColumn("block", F.pmod(F.shiftright("_key", 20), F.lit(blocks)))
    dealt = dealt.drop("bounds", "part", "_dealt")
    sizes = staged(dealt.groupBy("shard", "block").agg(F.count("*").alias("n")), "shard_blocks")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("shard", "block").orderBy("_key", "_place")) - 1)
    out = ranked.join(starts, ["shard", "block"])
    return out.select(
        *(F.col(f"_c{i}").alias(c) for i, c in enumerate(given)),
        F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.col("_rank")).cast("bigint").alias("slot"),
    )


SHARDS = 40


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal row counts."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("text_crc32"),
    )
    return shard(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
