"""Tables, staged tables and Arrow helpers of the operators in this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusloom.sinks.scratch import scratch_path

#: White space of the word rule, as a character class for Java's and DuckDB's expressions.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither recompute it nor lose it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, row by row, without Python strings; None for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for value in column.cast(pa.large_binary()):
        yield value.as_buffer().to_pybytes() if value.is_valid else None


def in_pieces(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, to bound what one step holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys from batches sorted by them; only the open group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        start, key = 0, None
        for at, key in enumerate(zip(*columns)):
            if last is not None and key != last:
                held.append(batch.slice(start, at - start))
                yield pa.Table.from_batches(held)
                held, start = [], at
            last = key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in DuckDB SQL, bit by bit."""
    bits = "list_transform(range(8 * length(t)), lambda i: (ascii(substr(t, 1 + CAST(i // 8 AS INTEGER), 1)) >> CAST(i % 8 AS INTEGER)) & 1)"
    step = "CASE WHEN xor(c & 1, b) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"(SELECT xor(list_reduce({bits}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) FROM (SELECT {text} AS t))"
