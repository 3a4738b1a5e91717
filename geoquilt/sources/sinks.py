"""What leaves: layers, bands, features and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, spectral
from ..plans import tracking

LAYER = ("variable", "year", "season", "aoi")


def write_layer(layer: DataFrame, path: str, values: list[str]) -> None:
    """A partition for each variable, year, season and area; only those written are replaced, missing values leave as -9999.

    A layer's pixels are dealt by ranges of a space-filling key, so that a large layer takes several tasks and files, each of
    neighbouring pixels. Files come into place when the job commits, so a failed run leaves no half of one.
    """
    out = layer.withColumns({v: spectral.null_to_missing(v) for v in values}).withColumn("z_key", geometry.z_order(F.col("col"), F.col("row")))
    parts = int(layer.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = out.repartitionByRange(parts, *LAYER, "z_key").sortWithinPartitions(*LAYER, "z_key").drop("z_key")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYER).parquet(path)


def write_observations(obs: DataFrame, path: str, parts: int | None = None) -> None:
    """Observations by month, and within a month in files of neighbouring pixels: a range of a space-filling key each.

    So ``readers.observations`` opens the months that it needs, and of their files skips those whose rows and columns, by the
    statistics of the files, are outside a box. Rows without a date go to a month of their own.
    """
    parts = parts or int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = obs.withColumns({"month": F.date_format("obs_date", "yyyy-MM"), "z_key": geometry.z_order(F.col("col"), F.col("row"))})
    dealt = keyed.repartitionByRange(parts, "month", "z_key").sortWithinPartitions("month", "z_key").drop("z_key")
    dealt.write.mode("overwrite").partitionBy("month").parquet(path)


def write_bands(layer: DataFrame, path: str, bands: list[str]) -> None:
    """One partition for each band of a multi-band layer (row, col, bands)."""
    long = layer.unpivot(["row", "col"], bands, "variable", "value")
    long.withColumn("value", spectral.null_to_missing("value")).write.mode("overwrite").partitionBy("variable").parquet(path)


def write_features(points: DataFrame, path: str, x: str = "lon", y: str = "lat") -> None:
    """A GeoJSON feature for each line; all other columns are its properties."""
    rest = [c for c in points.columns if c not in (x, y)]
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates")).alias("geometry"), F.struct(*rest).alias("properties"))
    points.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def write_reports(outputs: DataFrame, path: str) -> None:
    """A run's record as JSON, its outputs as CSV with a header, and a summary as text, for all runs."""
    runs = tracking.documents(outputs)
    runs.write.mode("overwrite").json(f"{path}/json")
    tracking.flat(runs).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    tracking.text_report(runs).select(F.col("report").alias("value")).write.mode("overwrite").text(f"{path}/text")
