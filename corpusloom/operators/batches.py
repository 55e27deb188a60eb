"""User functions over column batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], Mapping[str, Sequence]],
    schema: StructType | str,
    keep: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Apply `fn` to batches, given and returned as lists per column.

    The columns of `schema` replace all but the `keep` columns, which pass by untouched.
    `columns` names what fn reads, so that the scan can skip the rest. `partitions` spreads the
    rows first, for sources with too few splits.
    """
    new = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    keep = list(keep)
    out = StructType([df.schema[c] for c in keep] + list(new.fields))
    out_schema = to_arrow_schema(out)
    given = list(df.columns if columns is None else columns)
    read = df.select(*dict.fromkeys([*keep, *given]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = fn({c: batch.column(c).to_pylist() for c in given})
            arrays = [batch.column(c) for c in keep]
            for field in list(out_schema)[len(keep) :]:
                values = pa.array(list(result[field.name]), field.type)
                if len(values) != batch.num_rows:
                    raise ValueError(f"fn returned {len(values)} values of {field.name} for {batch.num_rows} rows")
                arrays.append(values)
            yield pa.RecordBatch.from_arrays(arrays, names=out_schema.names)

    return (read if partitions is None else read.repartition(partitions)).mapInArrow(apply, out)
