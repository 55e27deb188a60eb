"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from corpusloom.functions.text import render_prompt_response  # noqa: E402
from corpusloom.operators import vocab  # noqa: E402
from corpusloom.operators.encode import encode  # noqa: E402
from corpusloom.operators.model_inputs import close_sequences, pad_and_label, prepare  # noqa: E402
from corpusloom.plans.batch_plan import batch_plan  # noqa: E402
from corpusloom.queries import EPOCH_SHAPE, QUERIES, table  # noqa: E402
from corpusloom.schemas import DEFAULT_MAX_LENGTH  # noqa: E402
from corpusloom.sinks.scratch import scratch_path  # noqa: E402
from corpusloom.sources.spread import spread  # noqa: E402

HEADLINE = [
    "render_instruction_input",
    "stage_union",
    "message_assembly",
    "corpus_vocab",
    "encode_corpus_vocab",
    "encode_compat_vocab",
    "encode_pair",
    "decode_roundtrip",
    "pad_truncate",
    "label_mask",
    "model_inputs",
    "length_stats_padded",
    "length_stats_real",
    "batch_plan",
    "batch_plan_epochs",
    "shard_export",
    "batch_responses",
    "loss_metrics",
    "loss_metrics_stream",
    "uri_parts",
    "sequence_stats",
]


def run(make: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stages(spark: SparkSession, sf_dir: str, cpus: str) -> dict[str, dict[str, int]]:
    """Rows and characters per second of the steps on the way from documents to model inputs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "bench")
    spread(docs, int(cpus)).write.parquet(f"{path}/documents")
    docs = spark.read.parquet(f"{path}/documents")
    rows, chars = docs.agg(F.count("*"), F.sum(F.length("text"))).first()
    entries = vocab.reachable_entries(vocab.corpus_vocab(docs))
    encode(docs, entries, max_tokens=DEFAULT_MAX_LENGTH - 1).select("doc_id", "ids").write.parquet(f"{path}/ids")
    closed = close_sequences(spark.read.parquet(f"{path}/ids"))
    steps = {
        "render": lambda: docs.select("doc_id", render_prompt_response("source", "text")),
        "count_characters": lambda: vocab.token_counts(docs),
        "encode": lambda: encode(docs, entries, max_tokens=DEFAULT_MAX_LENGTH - 1).select("doc_id", "ids"),
        "pad_and_label": lambda: pad_and_label(closed, keep=["doc_id"]),
        "length_stats": lambda: closed.agg(F.min(F.size("ids")), F.max(F.size("ids")), F.avg(F.size("ids"))),
        "prepare": lambda: prepare(docs, lambda: F.col("text"), entries, keep=["doc_id"]),
        "batch_plan": lambda: batch_plan(docs, "doc_id", EPOCH_SHAPE),
    }
    out = {}
    for name, make in steps.items():
        best = min(run(make) for _ in range(3))
        out[name] = {"rows_per_sec": round(rows / best), "chars_per_sec": round(chars / best)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="corpusloom-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Start the JVM code paths and the Python workers outside the measured time.
    run(lambda: vocab.token_counts(table(spark, sf_dir, "benchmark").repartition(int(cpus))))

    # The median of three rounds over all queries: single runs differ by up to a second.
    rounds = [{name: run(lambda: QUERIES[name](spark, sf_dir)) for name in HEADLINE} for _ in range(3)]
    seconds = {name: round(median(r[name] for r in rounds), 3) for name in HEADLINE}

    # Once more over the same rows in as many files as there are cores: a small source is often one row group, hence one task.
    over = scratch_path(spark, "bench-spread")
    for name in ("documents", "conversations", "events", "pages", "benchmark"):
        spread(table(spark, sf_dir, name), int(cpus)).write.parquet(f"{over}/{name}.parquet")
    spread_seconds = {name: round(run(lambda: QUERIES[name](spark, over)), 3) for name in HEADLINE}

    throughput = stages(spark, sf_dir, cpus)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "queries_over_spread_files": spread_seconds,
                "value_over_spread_files": round(sum(spread_seconds.values()), 3),
                "throughput": throughput,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
