"""Corpora of the three column layouts, one directory per split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from corpusloom.schemas import CORPUS_SCHEMAS
from corpusloom.sources.ranges import CSV, csv_rows, read_records

FORMATS = ("parquet", "json", "csv", "orc")
# How CSV files are written and read: quotes are doubled, blanks stay, and a null is a mark of private characters.
CSV_NULL = "\ue000null\ue000"
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": CSV_NULL,
}
# With one of these, quotes or lines are others than the range reader knows: a file is one task then.
CSV_OWN_RULES = {"multiLine", "quote", "escape", "charToEscapeQuoteEscaping", "comment", "lineSep", "encoding", "charset"}
FILE_OPTIONS = {"pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter"}
SPLIT_NAMES = ("train", "validation", "test")


def read_corpus(
    spark: SparkSession,
    path: str,
    layout: str | StructType,
    format: str = "parquet",
    *,
    split: str | None = None,
    default_split: str = "train",
    splits: str = "directory",
    **options: str,
) -> DataFrame:
    """A corpus with its `split` column; with `split`, only that part of it, without the column.

    Splits are partition directories (`split=train/`) or, with splits="file", file names that
    start with a split name (`test-00000-of-00002.parquet`). Everything else counts as
    `default_split`. Files of other splits are not read. Broken JSON and CSV rows with too few or
    too many fields fail. CSV texts may hold line breaks, and a file is many tasks nevertheless: its
    byte ranges are read twice (`sources.ranges`), once before this returns. Options that change
    quotes or lines read each file in one task, but for multiLine="false", where texts hold no breaks.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
    schema = CORPUS_SCHEMAS[layout] if isinstance(layout, str) else layout
    if format == "csv" and not CSV_OWN_RULES & options.keys():
        return _read_csv_ranges(spark, path, schema, split, default_split, splits, options)
    if format == "csv":
        options = {**CSV_OPTIONS, "multiLine": "true", "mode": "FAILFAST", **options}
    elif format == "json":
        options = {"mode": "FAILFAST", **options}
    reader = spark.read.format(format).options(**options)
    if splits == "directory":
        # Only a partitioned folder has the column: a CSV row of a flat one must not miss a field.
        df = reader.schema(schema).load(path)
        found = F.lit(None).cast("string")
        if "split" in df.columns:
            df = reader.schema(StructType([*schema.fields]).add("split", StringType())).load(path)
            found = F.col("split")
    elif splits == "file":
        df = reader.schema(schema).load(path)
        found = _split_of_name(F.col("_metadata.file_name"))
    else:
        raise ValueError(f"splits must be 'directory' or 'file', not {splits!r}")
    df = df.withColumn("split", F.coalesce(found, F.lit(default_split)))
    return df if split is None else select_split(df, split)


def _split_of_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, rf"^({'|'.join(SPLIT_NAMES)})\b", 1), F.lit(""))


def _read_csv_ranges(
    spark: SparkSession, path: str, schema: StructType, split: str | None, default_split: str, splits: str, options: dict[str, str]
) -> DataFrame:
    """The same for CSV, range by range."""
    if splits not in ("directory", "file"):
        raise ValueError(f"splits must be 'directory' or 'file', not {splits!r}")
    files = {k: v for k, v in options.items() if k in FILE_OPTIONS}
    named = splits == "directory" and "split" in spark.read.options(**files).text(path).columns
    found = F.col("split") if named else F.lit(None).cast("string") if splits == "directory" else _split_of_name(F.element_at(F.split("file", "/"), -1))
    of_row = F.coalesce(found, F.lit(default_split))
    # Before the ranges are looked at, so that files of other splits are left alone.
    records = read_records(spark, path, CSV, "split" if named else None, None if split is None else of_row == split, **files)
    records = records.withColumn("split", of_row)
    rows = csv_rows(records.drop("file"), schema, {**CSV_OPTIONS, "mode": "FAILFAST", **options})
    return rows if split is None else rows.drop("split")


def select_split(df: DataFrame, split: str = "train") -> DataFrame:
    """Rows of one split, without the split column. Prunes directories on a partitioned table."""
    return df.where(F.col("split") == split).drop("split")


def corpus_columns(df: DataFrame) -> list[str]:
    """The source columns, which model inputs replace."""
    return [c for c in df.columns if c != "split"]
