"""Folder for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that `spark.checkpoint.dir` names.

    Where it is unset, a session of one process gets one folder of its own; any other session fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").split("[")[0] == "local":
        application = spark.conf.get("spark.app.id", "")
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="corpusloom-")
        return _own_folders[application]
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch root; nothing is created yet.

    Tables there belong to the job: later steps read them lazily, so they may go when it has ended.
    """
    return f"{scratch_root(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
