"""Removal of lines that many sites share, found by HyperLogLog sketches.

A line is what stands between line breaks, without white space around it; blank lines are never
removed. For each line hash, one sketch of the sites of all rows that hold it and one of their different texts are
merged by aggregation; lines whose smaller estimate is near the threshold get exact counts. Lines with ``min_sites``
sites and as many different texts are boilerplate: copies of a few documents on many sites don't make their lines
common. Boilerplate goes from every text, whatever its share of it; a text of such lines alone becomes empty.

A null text stays null and an empty one empty; a null site is no site; repeated rows get equal
results; an empty table gives an empty table. All columns are kept; ``n_lines_removed`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusloom.llm.common import in_pieces, staged, table

MIN_SITES = 10
LG_K = 12
MARGIN = 0.05  # three standard errors of a sketch with 2**12 registers
#: Lines that are sent to all tasks; more than that are joined.
BROADCAST_LINES = 500_000


#: White space around a line, and the seed of Spark's xxhash64.
BLANKS, HASH_SEED = " \t\r\x0b\x0c", 42


def _strip(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_sites(df: DataFrame, text: str = "text", site: str = "source") -> DataFrame:
    """(line, site, t): line hashes with the sites and text hashes of all rows that hold them, not yet distinct."""
    base = df.select(F.xxhash64(F.col(f"`{text}`")).alias("t"), F.col(f"`{text}`").alias("x"), F.col(f"`{site}`").alias("site"))
    stripped = F.transform(F.split("x", "\n"), _strip)
    lines = F.explode(F.array_distinct(F.filter(stripped, lambda a: a != ""))).alias("a")
    return base.where("site IS NOT NULL").select("t", "site", lines).select(F.xxhash64("a").alias("line"), "site", "t")


def boilerplate(df: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """(line): hashes of lines with ``min_sites`` different sites or more, and as many different texts."""
    votes, counted = line_sites(df, text, site), ["site", "t"]
    spread = votes.groupBy("line").agg(*(F.hll_sketch_agg(c, F.lit(LG_K)).alias(c) for c in counted))
    spread = spread.select("line", F.array_min(F.array(*(F.hll_sketch_estimate(c) for c in counted))).alias("sites"))
    spread = spread.where(F.col("sites") >= min_sites * (1 - margin))
    spread = staged(spread, "line_spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + margin)).select("line")
    near = spread.where(F.col("sites") <= min_sites * (1 + margin)).select("line")
    exact = votes.join(near, "line", "left_semi").groupBy("line").agg(*(F.countDistinct(c).alias(c) for c in counted))
    exact = exact.select("line", F.array_min(F.array(*counted)).alias("n"))
    return staged(sure.unionByName(exact.where(F.col("n") >= min_sites).select("line")), "boilerplate_lines")


def cut(text: str, lines: set[int]) -> tuple[str, int]:
    """A text without the lines of these hashes, and how many went."""
    given = text.split("\n")
    kept = [a for a in given if xxhash.xxh64_intdigest(a.strip(BLANKS).encode(), HASH_SEED) not in lines]
    return ("\n".join(kept), len(given) - len(kept)) if len(kept) < len(given) else (text, 0)


def remove_lines(df: DataFrame, lines: DataFrame, text: str = "text", most: int = BROADCAST_LINES) -> DataFrame:
    """``df`` with the lines gone from its texts, and ``n_lines_removed``.

    Up to ``most`` lines go to all tasks, and no text moves; more are joined with the lines of each text.
    """
    given = [c for c in df.columns if c != "n_lines_removed"]
    rows = df.select(*(F.col(f"`{c}`") for c in given))
    if lines.count() > most:
        return _remove_by_join(rows, lines, text)
    known = {r["line"] % (1 << 64) for r in lines.collect()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 1024):
            cuts = [(None, 0) if t is None else cut(t, known) for t in batch.column(text).to_pylist()]
            columns = [batch.column(c) for c in given]
            columns[given.index(text)] = pa.array([t for t, _ in cuts], batch.column(text).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in cuts], pa.int64())], names=[*given, "n_lines_removed"])

    return rows.mapInArrow(run, StructType([*rows.schema, StructField("n_lines_removed", LongType())]))


def _remove_by_join(df: DataFrame, lines: DataFrame, text: str) -> DataFrame:
    given = df.columns
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in given)).alias("row")).withColumn("t", F.xxhash64(F.col("row")[text]))
    of = F.split(F.col("row")[text], "\n")
    found = rows.select("t", F.explode(F.transform(of, lambda a: F.xxhash64(_strip(a)))).alias("line")).distinct()
    drops = found.join(lines, "line", "left_semi").groupBy("t").agg(F.collect_set("line").alias("drop"))
    out = rows.join(drops, "t", "left")
    kept = F.filter(of, lambda a: ~F.array_contains("drop", F.xxhash64(_strip(a))))
    common = F.col("drop").isNotNull()
    new_text = F.when(common, F.array_join(kept, "\n")).otherwise(F.col("row")[text])
    removed = F.when(common, F.size(of) - F.size(kept)).otherwise(0).cast("bigint")
    return out.select(*((new_text if c == text else F.col("row")[c]).alias(c) for c in given), removed.alias("n_lines_removed"))


def line_dedup(df: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    return remove_lines(df, boilerplate(df, text, site, min_sites), text)


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more sites, and as many texts, share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup(docs).select("doc_id", "text", F.length("text").cast("bigint").alias("n_chars"), "n_lines_removed")


def line_dedup_sql(documents: str) -> str:
    """The same in DuckDB SQL over a table with all columns of documents: its rows with text and n_lines_removed."""
    strip = "trim(a, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))"
    return f"""
SELECT doc_id, lang, source,
  CASE WHEN n > 0 THEN array_to_string(list_transform(list_filter(marked, lambda m: NOT m.d), lambda m: m.a), chr(10)) ELSE text END AS text,
  CAST(n AS BIGINT) AS n_lines_removed
FROM (
  SELECT *, coalesce(len(list_filter(marked, lambda m: m.d)), 0) AS n
  FROM (
    SELECT d.*, list_transform(string_split(text, chr(10)), lambda a: {{'a': a, 'd': list_contains(b.lines, {strip})}}) AS marked
    FROM {documents} d, (
      SELECT coalesce(list(line), []) AS lines FROM (
        SELECT {strip} AS line FROM (
          SELECT unnest(string_split(text, chr(10))) AS a, source, text FROM {documents} WHERE source IS NOT NULL
        ) WHERE {strip} <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES} AND count(DISTINCT text) >= {MIN_SITES}
      )
    ) b
  )
)"""


OP4_SQL = f"SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars, n_lines_removed FROM ({line_dedup_sql('documents')})"
