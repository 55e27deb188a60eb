"""Records of text files that are longer than a line, found range by range.

Spark reads a text file in byte ranges and cuts it at a separator: the line break for CSV, the bracket that closes an
element for a JSON array. Not every separator ends a record, as quoted text may hold it, and whether a range starts
in quoted text depends on all before it. So the files are read twice:

1. Each range is summed up by what it does to the state (in quotes or not, depth of brackets), for either start.
   Sums of a file's ranges, one row each, are put one after the other: that is the state at the start of each range.
2. Each range is cut at its true record ends. What stands before the first and behind the last of them
   is joined with the pieces of the ranges beside it.

So one file is as many tasks as it has ranges, whatever its texts hold, and a record may be longer than a range.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusloom.sinks.scratch import scratch_path

#: Bound of the broadcast table of states: one row of some 30 bytes for each range, 128 TB in ranges of 128 MB.
MAX_RANGES = 1 << 20
_ESCAPED = re.compile(rb"\\.", re.DOTALL)


@dataclass(frozen=True)
class Grammar:
    """What ends a record: a separator outside of quotes, for bracketed ones at the depth of the records.

    ``opening`` is the bracket that ``separator`` closes. With ``escapes`` a backslash quotes the next character.
    ``rest`` is a pattern of what may stand behind the last record, or alone in a file without one.
    """

    separator: str
    opening: str = ""
    depth: int = 0
    escapes: bool = False
    rest: str = ""

    def step(self, row: bytes, inside: bool, depth: int) -> tuple[bool, int]:
        """The state behind a row and its separator."""
        if self.escapes and b"\\" in row:
            row = _ESCAPED.sub(b"", row)
        if not self.opening:
            return inside ^ bool(row.count(b'"') & 1), depth
        parts = row.split(b'"')
        depth += sum(p.count(self.opening.encode()) for p in parts[inside::2])
        inside ^= not len(parts) & 1
        return inside, depth - (not inside)

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside and depth == self.depth


#: Quotes in fields are doubled, and only quoted fields hold quotes, as in RFC 4180.
CSV = Grammar("\n")
#: Elements of one array of arrays, and of one array of objects, for each file.
JSON_ARRAYS = Grammar("]", "[", 1, True, r"\[?[\s\]]*")
JSON_OBJECTS = Grammar("}", "{", 0, True, r"\[?[\s\]}]*")

_RANGE = "file string, start bigint"


def _by_range(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Each range of a task, by the first of its rows, with all its rows in the order of the file."""

    def rows() -> Iterator[tuple[tuple, int, pa.RecordBatch, bytes]]:
        for batch in batches:
            keys = zip(batch.column("file").to_pylist(), batch.column("start").to_pylist())
            values = batch.column("value").cast(pa.binary()).to_pylist()
            for i, (key, value) in enumerate(zip(keys, values)):
                yield key, i, batch, value

    stream = rows()
    held = next(stream, None)
    while held is not None:
        key, i, batch, _ = held
        others = [c for c in batch.schema.names if c != "value"]
        first = {c: batch.column(c)[i].as_py() for c in others}

        def values() -> Iterator[bytes]:
            nonlocal held
            while held is not None and held[0] == key:
                yield held[3]
                held = next(stream, None)

        inside = values()
        yield first, inside
        for _ in inside:
            pass


def _sums(batches: Iterable[pa.RecordBatch], grammar: Grammar) -> Iterator[pa.RecordBatch]:
    """(file, start) with the state behind the range and the change of depth, for a start outside and inside of quotes."""
    for first, rows in _by_range(batches):
        states = [(False, 0), (True, 0)]
        for row in rows:
            states = [grammar.step(row, *s) for s in states]
        (a, b), (c, d) = states
        yield pa.RecordBatch.from_pylist([{"file": first["file"], "start": first["start"], "out_inside": a, "out_depth": b, "in_inside": c, "in_depth": d}])


_SUMS = f"{_RANGE}, out_inside boolean, out_depth bigint, in_inside boolean, in_depth bigint"


def _states(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the start of each range, from the sums of all ranges sorted by file and start."""
    file, inside, depth = None, False, 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["file"] != file:
                file, inside, depth = r["file"], False, 0
            out.append({"file": file, "start": r["start"], "inside": inside, "depth": depth})
            way = "in" if inside else "out"
            inside, depth = r[f"{way}_inside"], depth + r[f"{way}_depth"]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int64())]))


def _pieces(batches: Iterable[pa.RecordBatch], grammar: Grammar, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The records of each range and, of those that go over its limits, the pieces.

    whole: a record or not; behind: a piece of the record that is open behind the range; number: among the record ends of the range.
    """
    separator = grammar.separator.encode()
    out: list[dict] = []
    size = 0
    for first, rows in _by_range(batches):
        inside, depth = first.pop("inside"), first.pop("depth")
        if inside is None:
            raise ValueError(f"{first['file']} was cut into other ranges before; read it with the same settings and cores")
        opens = first["start"] == 0
        whole = opens or grammar.ends(inside, depth)
        held, number = [], 0
        for row in rows:
            held.append(row)
            inside, depth = grammar.step(row, inside, depth)
            if grammar.ends(inside, depth):
                text = separator.join(held) + (separator if grammar.opening else b"")
                out.append({**first, "value": text.decode(), "whole": whole, "behind": False, "number": number, "opens": opens})
                size += len(text)
                held, whole, opens, number = [], True, False, number + 1
                if len(out) >= 1024 or size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        if held:
            text = separator.join(held) + separator
            out.append({**first, "value": text.decode(), "whole": False, "behind": True, "number": number, "opens": opens})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_records(spark: SparkSession, path: str, grammar: Grammar, partition: str | None = None, where: Column | None = None, **options: str) -> DataFrame:
    """(file, start, number, opens, value): the records of all text files in a path.

    start: the range in which the record ends; number: its place, from 0, among those that end there; opens: whether the
    file begins with it. ``partition`` is a directory column to carry along; only rows of files for which ``where`` holds,
    of that column and `file`, are read; ``options`` choose files, as the text source takes them. A record that is not closed fails. The files are read, and the records written once, before this returns.
    """
    carried = [partition] if partition else []
    schema = StructType([StructField("value", StringType())] + [StructField(c, StringType()) for c in carried])
    lines = spark.read.schema(schema).options(**options).option("lineSep", grammar.separator).text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), *carried)
    lines = lines if where is None else lines.where(where)

    # One row for each range; the files are dealt over tasks.
    sums = lines.mapInArrow(lambda batches: _sums(batches, grammar), _SUMS)
    states = sums.repartition("file").sortWithinPartitions("file", "start").mapInArrow(_states, f"{_RANGE}, inside boolean, depth bigint")
    states = _written(states, "range-states")
    ranges = states.count()
    if ranges > MAX_RANGES:
        raise ValueError(f"{ranges} ranges, more than {MAX_RANGES}: use a larger spark.sql.files.maxPartitionBytes")

    known = lines.join(F.broadcast(states), ["file", "start"], "left")
    fields = [("file", pa.string()), ("start", pa.int64()), *((c, pa.string()) for c in carried)]
    fields += [("value", pa.string()), ("whole", pa.bool_()), ("behind", pa.bool_()), ("number", pa.int64()), ("opens", pa.bool_())]
    names = ", ".join(f"`{n}` { {pa.string(): 'string', pa.int64(): 'bigint', pa.bool_(): 'boolean'}[t]}" for n, t in fields)
    pieces = _written(known.mapInArrow(lambda batches: _pieces(batches, grammar, pa.schema(fields)), names), "range-pieces")

    columns = ["file", *carried, "start", "number", "opens", "value"]
    parts = pieces.where("NOT whole")
    # A piece belongs to the record that ends in the first range from its own on, or behind it, with an end: at most two pieces a range.
    on = W.partitionBy("file").orderBy("start", "behind").rowsBetween(0, W.unboundedFollowing)
    to = F.min(F.when(~F.col("behind"), F.col("start"))).over(on).alias("to")
    places = parts.select("file", "start", "behind", to)
    joined = parts.join(places, ["file", "start", "behind"]).groupBy("file", *carried, "to").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "behind", "value"))), lambda p: p["value"]), "").alias("value"),
        F.max("opens").alias("opens"),
    )
    rest = F.regexp_replace("value", rf"^[\s\x{{feff}}]*{grammar.rest}$", "")
    unclosed = F.raise_error(F.concat(F.lit("the last record is not closed in "), F.col("file")))
    start = F.when(F.col("to").isNotNull(), F.col("to")).when(rest != "", unclosed.cast("bigint"))
    joined = joined.withColumns({"start": start, "number": F.lit(0).cast("bigint")}).where("start IS NOT NULL")
    return pieces.where("whole").select(*columns).unionByName(joined.select(*columns))


def json_elements(spark: SparkSession, path: str, objects: bool = False) -> DataFrame:
    """(file, start, number, value): the elements, as JSON, of files that each hold one array of arrays or of objects."""
    found = read_records(spark, path, JSON_OBJECTS if objects else JSON_ARRAYS)
    return found.select("file", "start", "number", F.regexp_replace("value", r"^[\s\x{feff}]*[\[,]\s*", "").alias("value"))


def numbered(records: DataFrame, name: str) -> DataFrame:
    """``records`` with their numbers from 0 over all files, in the order of the files' names."""
    counts = records.groupBy("file", "start").agg(F.count("*").alias("_n"))  # one row for each range
    before = W.orderBy("file", "start").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("file", "start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return records.join(firsts, ["file", "start"]).withColumn(name, F.col("_first") + F.col("number")).drop("_first")


def csv_rows(records: DataFrame, schema: StructType, options: dict[str, str]) -> DataFrame:
    """The fields of CSV records by position, before the other columns; the header of each file and empty records go."""
    rows = records.withColumn("value", F.regexp_replace("value", r"\r\z", "")).where("value <> ''")
    if options.get("header", "false").lower() == "true":
        rows = rows.where("NOT opens")
    given = {k: v for k, v in options.items() if k != "header"}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    others = [c for c in records.columns if c not in ("value", "opens", "number", "start")]
    return rows.select(F.from_csv("value", fields, {**given, "multiLine": "true"}).alias("_row"), *others).select("_row.*", *others)
