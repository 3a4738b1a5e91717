"""What the corpus operators share: written intermediate tables, global running totals, import paths."""

from __future__ import annotations

import ctypes
import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A side of at most so many rows of a few numbers may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package as the driver does.

    On a cluster the package is installed or sent with ``--py-files`` as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = f"{environment.get('PYTHONPATH', '')}:{os.environ.get('PYTHONPATH', '')}".split(":")
    if spark.sparkContext.master.startswith("local") and root not in known:
        environment["PYTHONPATH"] = ":".join(x for x in (root, environment.get("PYTHONPATH", "")) if x)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task. After the last one what it has freed goes back to the system, as its worker stays for other tasks and stages."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
            trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where a local session names none."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(named)
        folder = context.getCheckpointDir()
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_not(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most so many rows; df must be cheap to count (a written table)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def smallest_hashed(df: DataFrame, key: str, rows: int, by: str | None = None) -> DataFrame:
    """The ``rows`` rows whose hashed keys are smallest, of each value of ``by`` if that is named; with ``place``, from 1.

    Rows are counted first, and those whose hash is clearly too large are left out before the window,
    so what goes to one task is little more than what it keeps, however many rows or tasks there are.
    """
    group = [F.col(by)] if by else [F.lit(1).alias("all")]
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("hashed_n"))
    counted = df.join(small_or_not(written(counts, "counts")), by) if by else df.crossJoin(F.broadcast(counts.select("hashed_n")))
    hashed = F.xxhash64(key)
    share = (rows + 8 * math.sqrt(rows) + 40) / F.col("hashed_n")
    likely = counted.where(hashed.cast("double") / float(1 << 64) + 0.5 <= share).drop("hashed_n")
    order = Window.partitionBy(*([by] if by else [F.lit(1)])).orderBy(hashed, key)
    return likely.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows)


def running_total(df: DataFrame, order: list, value: str, total: str, name: str) -> DataFrame:
    """df with ``total``, the sum of ``value`` over all rows up to and including each one in ``order``.

    Rows are range-partitioned, so no task holds more than its range; the only thing that goes over
    all partitions is one sum for each. ``order`` must be total, or tied rows get totals in any order.
    The sorted rows are written once, as their partition numbers must not change between two uses.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("part_no", F.spark_partition_id())
    ranged = written(ranged, name)
    sums = ranged.groupBy("part_no").agg(F.sum(value).alias("part_sum"))
    before = Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part_no", F.coalesce(F.sum("part_sum").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row for each partition of the shuffle: a bound that does not grow with the rows.
    return ranged.join(F.broadcast(starts), "part_no").withColumn(total, F.sum(value).over(within) + F.col("part_start")).drop("part_no", "part_start")
