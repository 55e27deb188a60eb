"""Metric extraction from log lines; the same columns serve batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric names and the patterns the job definitions use. The pattern stops at an
# exponent ('2e-05' gives 2), takes '1.2.3' whole (null after the cast) and misses quoted keys.
COMPAT_METRICS = (
    ("train:loss", r"train_loss: ([0-9\.]+)"),
    ("eval:loss", r"eval_loss: ([0-9\.]+)"),
)

# Accepts a sign, an exponent and quotes around the key.
FLOAT_METRICS = (
    ("train:loss", r"""['"]?train_loss['"]?: ([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"""),
    ("eval:loss", r"""['"]?eval_loss['"]?: ([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"""),
)


def captured(line: Column | str, pattern: str) -> Column:
    """First capture group of the first match, null when the line does not match."""
    c = F.col(line) if isinstance(line, str) else line
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def metric_entries(line: Column | str, definitions: Sequence[tuple[str, str]] = COMPAT_METRICS) -> Column:
    """Array with one (metric, value) per definition that matches the line."""
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), captured(line, pattern).alias("captured"))
            for name, pattern in definitions
        ]
    )
    return F.transform(
        F.filter(entries, lambda e: e["captured"].isNotNull()),
        lambda e: F.struct(
            e["metric"].alias("metric"), e["captured"].try_cast("double").alias("value")
        ),
    )
