"""Observation tables (a row for each pixel and scene): filters, masks, composites and indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import spectral
from ..sources import scratch
from . import grids, ranks

PIXEL = ("row", "col")
BANDS = ("b02", "b03", "b04", "b08", "b11")


def scan(obs: DataFrame, bands: list[str], start: str, end: str, box: tuple | None = None, max_cloud: float | None = None) -> DataFrame:
    """The bands of the observations from start to end, both included, in the box, of scenes below the cloud limit.

    All of it is filters and a selection, which reach the Parquet scan. Scenes whose cloud is unknown
    are left out where there is a limit.
    """
    out = obs.where(F.col("obs_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if box is not None:
        out = out.where((F.col("col") + 0.5).between(box[0], box[2]) & (F.col("row") + 0.5).between(box[1], box[3]))
    if max_cloud is not None:
        out = out.where(F.col("cloud") < max_cloud)
    return out.select("obs_id", *PIXEL, "obs_date", *bands, "scl", "cloud")


def mask_classes(obs: DataFrame, bands: list[str], masked: tuple[int, ...] = spectral.MASKED_CLASSES) -> DataFrame:
    """obs with bands NULL where the scene class hides the ground, without the class."""
    return obs.withColumns({b: spectral.unless_masked(b, masked=masked) for b in bands}).drop("scl")


def composite(obs: DataFrame, bands: list[str], how: str = "median") -> DataFrame:
    """One value for each pixel and band over time: median, mean, or the first observation."""
    if how == "first":
        first = F.min_by(F.struct(*bands), F.struct("obs_date", "obs_id"))
        return obs.groupBy(*PIXEL).agg(first.alias("b")).select(*PIXEL, *[F.col(f"b.{b}").alias(b) for b in bands])
    reduce = {"median": F.median, "mean": F.avg}[how]
    return obs.groupBy(*PIXEL).agg(*[reduce(b).alias(b) for b in bands])


def reduced(obs: DataFrame, band: str, wanted: dict[str, str]) -> DataFrame:
    """(row, col) with a band over time by several names at once: mean, median, or the mean of one date (``1996-07-16``); one scan, one aggregate."""
    of_date = lambda day: F.avg(F.when(F.col("obs_date") == F.lit(day).cast("date"), F.col(band)))
    how = {"mean": F.avg(band), "median": F.median(band)}
    return obs.groupBy(*PIXEL).agg(*[(how[x] if x in how else of_date(x)).alias(name) for name, x in wanted.items()])


def split_median(obs: DataFrame, bands: list[str], by: tuple[str, ...] = PIXEL) -> DataFrame:
    """The median of each band for each pixel (or other keys), picked by rank: observations of one pixel are spread over tasks, however many it has."""
    long = obs.select(*by, F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).cast("double").alias("of_band")) for b in bands])).alias("b"))
    found = ranks.quantiles(long.select(*by, "b.band", "b.of_band"), "of_band", {"median": 0.5}, (*by, "band"))
    every = obs.select(*by).distinct()
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("band") == b, F.col("median"))).alias(b) for b in bands])
    return every.join(wide, list(by), "left")


def index_composite(obs: DataFrame, indices: list[str]) -> DataFrame:
    """Indices of the median bands: one scan and one aggregate for any number of indices."""
    bands = spectral.required_bands(indices)
    return composite(obs, bands).select(*PIXEL, *[spectral.INDICES[x]().alias(x) for x in indices])


def median_of_index(obs: DataFrame, index: str) -> DataFrame:
    """The median over time of an index of each observation, which is not the index of the medians."""
    return obs.groupBy(*PIXEL).agg(F.median(spectral.INDICES[index]()).alias(index))


def percentiles(values: DataFrame, column: str, low: float = 0.05, high: float = 0.95, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, low, high): percentiles with linear interpolation, picked by rank from ranges of the counted values; of all rows or of each key."""
    return ranks.quantiles(values, column, {"low": low, "high": high}, by)


def _joined(df: DataFrame, small: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """df with the columns of a table of one row, or of one for each key; null is a key."""
    if not by:
        return df.crossJoin(F.broadcast(small))
    named = small.withColumnsRenamed({c: f"{c}_of_key" for c in by})
    on = [F.col(c).eqNullSafe(F.col(f"{c}_of_key")) for c in by]
    return df.join(grids.few(named), on, "left").drop(*[f"{c}_of_key" for c in by])


def fractional_cover(ndvi: DataFrame, column: str = "ndvi", by: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """ndvi with fvc: the index stretched from its 5th to its 95th percentile, of all rows or of each key, to 0 and 1.

    NULL stays, and where all values are one there is none; with ``strict`` that, and no value at all, is an error. The index
    is written once and read for the percentiles and the result.
    """
    spark = ndvi.sparkSession
    path = scratch.new_path(spark, "index")
    ndvi.write.parquet(path)
    ndvi = spark.read.schema(ndvi.schema).parquet(path)
    found = _joined(ndvi, percentiles(ndvi, column, by=by), by)
    wide = F.coalesce(F.col("high") > F.col("low"), F.lit(False))
    if strict:
        wide = F.when(wide, True).otherwise(F.raise_error(F.lit("the percentiles are one value, or there is none")).cast("boolean"))
    share = spectral.clip01((F.col(column) - F.col("low")) / (F.col("high") - F.col("low")))
    return found.withColumn("fvc", F.when(wide & F.col(column).isNotNull(), share)).drop("low", "high")


def scale_reflectance(df: DataFrame, bands: list[str], scales: dict[str, tuple[float, float]] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Bands as reflectance: by their own scale and offset if any has one, otherwise a 10000th where the largest valid value, of all rows or of a key, is above 1.5."""
    own = {b: s for b, s in (scales or {}).items() if s != (1.0, 0.0) and b in bands}
    if own:
        return df.withColumns({b: F.col(b) * s + o for b, (s, o) in own.items()})
    most = df.where(spectral.all_valid(*bands)).groupBy(*by).agg(F.max(F.greatest(*bands)).alias("most"))
    return _joined(df, most, by).withColumns({b: F.when(F.col("most") > 1.5, F.col(b) / 10000.0).otherwise(F.col(b)) for b in bands}).drop("most")


def rgba(df: DataFrame, red: str = "b04", green: str = "b03", blue: str = "b02") -> DataFrame:
    """r, g, b, a as bytes; a pixel that lacks a band is transparent black."""
    valid = spectral.all_valid(red, green, blue)
    colors = spectral.true_color(red, green, blue)
    out = {k: F.when(valid, spectral.to_byte(x)).otherwise(0).cast("short").alias(k) for k, x in colors.items()}
    return df.select(*PIXEL, *out.values(), F.when(valid, 255).otherwise(0).cast("short").alias("a"))


def coverage(df: DataFrame, valid: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, inside, valid, ratio, complete) of the pixels of an area, 0 and false if there are none, or of each key that has any."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("inside"), F.count_if(valid).alias("valid"))
    ratio = F.coalesce(F.try_divide(F.col("valid").cast("double"), F.col("inside").cast("double")), F.lit(0.0))
    return counts.withColumn("ratio", ratio).withColumn("complete", (F.col("inside") > 0) & (F.col("inside") == F.col("valid")))


def mosaic(candidates: DataFrame, bands: list[str], rank: str = "rank") -> DataFrame:
    """Each pixel from the first candidate, in order of rank, in which all its bands are valid; NULL if there is none."""
    valid = spectral.all_valid(*bands)
    best = F.min_by(F.when(valid, F.struct(rank, *bands)), F.when(valid, F.col(rank)))
    return candidates.groupBy(*PIXEL).agg(best.alias("b")).select(*PIXEL, F.col(f"b.{rank}").alias(rank), *[F.col(f"b.{b}").alias(b) for b in bands])


def mosaic_stop(candidates: DataFrame, pixels: DataFrame, bands: list[str], least: float = 0.999, most_dates: int = 5, rank: str = "rank", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, stop_rank, kind, ratio): where a search, or the search of each key, through candidates in rank order ends.

    A candidate that covers the share ``least`` of the pixels by itself ends it and is used alone
    (single); otherwise candidates that add anything valid are collected until together they cover
    as much or are ``most_dates`` (mosaic). Candidates without a valid pixel are passed over. The
    running part has one row for each candidate.
    """
    valid = candidates.where(spectral.all_valid(*bands)).select(*by, rank, *PIXEL).distinct()
    own = valid.groupBy(*by, rank).agg(F.count(F.lit(1)).alias("own"))
    new = valid.groupBy(*by, *PIXEL).agg(F.min(rank).alias(rank)).groupBy(*by, rank).agg(F.count(F.lit(1)).alias("new"))
    total = pixels.select(*by, *PIXEL).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy(*by).orderBy(rank)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    steps = _joined(own.join(new, [*by, rank], "left"), total, by).withColumn("covered", F.sum(F.coalesce("new", F.lit(0))).over(so_far)).withColumn("dates", F.row_number().over(in_order))
    alone = F.col("own") >= F.col("n") * least
    ends = steps.where(alone | (F.col("covered") >= F.col("n") * least) | (F.col("dates") >= most_dates))
    pick = F.min_by(F.struct(F.when(alone, "single").otherwise("mosaic").alias("kind"), (F.when(alone, F.col("own")).otherwise(F.col("covered")) / F.col("n")).alias("ratio")), rank)
    return ends.groupBy(*by).agg(F.min(rank).alias("stop_rank"), pick.alias("p")).select(*by, "stop_rank", "p.kind", "p.ratio")
