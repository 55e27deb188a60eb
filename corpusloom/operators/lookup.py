"""Token to id and id to token for whole array columns, with a default on a miss."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructField, StructType

from corpusloom.operators.vocab import MAX_LOCAL_ENTRIES
from corpusloom.schemas import END_OF_TEXT
from corpusloom.sinks.scratch import scratch_path

MAX_LOCAL_BYTES = 64 << 20
_PLACE_BITS = 33  # of monotonically_increasing_id: the place in the partition


def _entries(vocab: DataFrame | Mapping[str, int], max_local: int) -> dict[str, int] | None:
    """The vocabulary as a dict if it is small in rows and bytes, which is looked up first."""
    if isinstance(vocab, Mapping):
        return dict(vocab)
    if max_local == 0:
        return None
    n, n_bytes = vocab.agg(F.count("*"), F.sum(F.octet_length("token"))).first()
    if n > max_local or (n_bytes or 0) > MAX_LOCAL_BYTES:
        return None
    return {r["token"]: r["id"] for r in vocab.select("token", "id").collect()}


def _replaced(items: pa.ListArray, keys: pa.Array, values: pa.Array, default: int | str) -> pa.ListArray:
    """Lists with each item replaced by the value of its key, `default` where there is none."""
    flat = items.flatten()
    looked_up = values.take(pc.index_in(flat, value_set=keys)).fill_null(pa.scalar(default, values.type))
    offsets = np.zeros(len(items) + 1, np.int32)
    np.cumsum(items.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), looked_up, mask=items.is_null())


def tokens_to_ids(
    df: DataFrame,
    vocab: DataFrame | Mapping[str, int],
    tokens_col: str = "tokens",
    ids_col: str = "ids",
    *,
    unk_id: int = 0,
    max_local: int = MAX_LOCAL_ENTRIES,
) -> DataFrame:
    """Replace each token by its id.

    A vocabulary of more than `max_local` rows or MAX_LOCAL_BYTES is joined; the ids are the same.
    """
    entries = _entries(vocab, max_local)
    if entries is None:
        return joined_lookup(df, vocab, tokens_col, ids_col, "token", "id", unk_id)

    keys, values = pa.array(list(entries), pa.string()), pa.array(list(entries.values()), pa.int32())

    @F.arrow_udf("array<int>")
    def look_up(tokens: pa.Array) -> pa.Array:
        return _replaced(tokens, keys, values, unk_id)

    return df.withColumn(ids_col, look_up(F.col(tokens_col)))


def ids_to_tokens(
    df: DataFrame,
    vocab: DataFrame | Mapping[str, int],
    ids_col: str = "ids",
    tokens_col: str = "tokens",
    *,
    unk_token: str = END_OF_TEXT,
    max_local: int = MAX_LOCAL_ENTRIES,
) -> DataFrame:
    """Replace each id by its token, all in the JVM: tokens sit in a constant array indexed by id.

    Takes the join form for a larger vocabulary, as `tokens_to_ids`, or ids above `max_local`.
    """
    entries = _entries(vocab, max_local)
    if entries is not None and min(entries.values(), default=0) < 0:
        raise ValueError("ids must not be negative")
    if entries is None or max(entries.values(), default=0) > max_local:
        table = vocab if isinstance(vocab, DataFrame) else df.sparkSession.createDataFrame(
            list(vocab.items()), "token string, id int"
        )
        return joined_lookup(df, table, ids_col, tokens_col, "id", "token", unk_token)
    size = max(entries.values(), default=-1) + 1
    by_id = [unk_token] * size
    for token, token_id in entries.items():
        by_id[token_id] = token
    # Constant folding turns the parsed literal into one array before the first row.
    table = F.from_json(F.lit(json.dumps(by_id, ensure_ascii=False)), "array<string>")
    unknown = F.lit(unk_token)
    return df.withColumn(
        tokens_col,
        F.transform(F.col(ids_col), lambda i: F.coalesce(F.get(table, i), unknown)),
    )


def joined_lookup(
    df: DataFrame,
    table: DataFrame,
    items_col: str,
    out_col: str,
    key_col: str,
    value_col: str,
    default: int | str,
) -> DataFrame:
    """Lookup as a join, for tables of any size.

    The rows are written once to the scratch folder, so that their partitions stay what they are
    and nothing before is computed twice. A partition sends each of its distinct items once: an
    item that all rows hold meets the table as many times as there are partitions. The values go
    back to the partition, in front of its rows, and are applied as the rows stream by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "lookup")
    columns = [c for c in df.columns if c != out_col]
    df.select(*columns).write.parquet(path)
    rows = spark.read.schema(df.select(*columns).schema).parquet(path)
    rows = rows.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), _PLACE_BITS))
    item_type, value_type = table.schema[key_col].dataType, table.schema[value_col].dataType
    items = rows.select("_part", F.explode(items_col).alias("_item")).distinct()
    values = table.select(F.col(key_col).alias("_item"), F.col(value_col).alias("_value"))
    found = items.join(values, "_item").select("_part", F.lit(0).alias("_kind"), "_item", "_value")
    rows = rows.withColumns(
        {"_kind": F.lit(1), "_item": F.lit(None).cast(item_type), "_value": F.lit(None).cast(value_type)}
    )
    # A task for each partition: the hash of a number would put two of them in one and leave others empty.
    parts = (rows.agg(F.max("_part")).first()[0] or 0) + 1
    together = rows.unionByName(found, allowMissingColumns=True)
    dealt = together.repartitionById(parts, F.col("_part").cast("int")).sortWithinPartitions("_part", "_kind")
    fields = [df.schema[c] for c in columns]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kept = None, []
        for batch in batches:
            place = np.stack([batch.column("_part").to_numpy(), batch.column("_kind").to_numpy()], axis=1)
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                run = batch.slice(start, end - start)
                if place[start, 0] != part:
                    part, kept = place[start, 0], []
                if place[start, 1] == 0:
                    kept.append((run.column("_item"), run.column("_value")))
                    continue
                keys, looked_up = (
                    (pa.concat_arrays(x) for x in zip(*kept)) if kept else (pa.array([], to_arrow_type(t)) for t in (item_type, value_type))
                )
                out = {c: run.column(c) for c in columns}
                out[out_col] = _replaced(run.column(items_col), keys, looked_up, default)
                yield pa.RecordBatch.from_pydict(out)

    return dealt.mapInArrow(apply, StructType([*fields, StructField(out_col, ArrayType(value_type))]))
