"""Occurrence records as a stream. The row-wise filters of ``operators.occurrences`` take a stream as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_of_each(occ: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    """Records without repetitions of an id within the delay; state older than the watermark is dropped."""
    key = F.coalesce(F.nullif(F.col("gbif_id"), F.lit("")), F.nullif(F.col("occurrence_id"), F.lit("")))
    return occ.withColumn("record_key", key).where("record_key is not null").withWatermark(time, delay).dropDuplicatesWithinWatermark(["record_key"]).drop("record_key")


def counts(occ: DataFrame, time: str, window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Records for each time window; late ones count until the watermark has passed."""
    return occ.withWatermark(time, delay).groupBy(F.window(time, window)).count().select(F.col("window.start").alias("start"), F.col("count").alias("n"))
