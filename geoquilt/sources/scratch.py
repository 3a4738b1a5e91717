"""Files that a query writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_path(spark: SparkSession, name: str) -> str:
    """A path that is not in use, under ``spark.checkpoint.dir``; a temporary folder only for local sessions."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(named)
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
