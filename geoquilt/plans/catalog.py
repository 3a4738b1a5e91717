"""What variables there are, when and at which resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEASON_ORDER = ("winter", "spring", "summer", "autumn", "annual", "static")
_FIVE = ("winter", "spring", "summer", "autumn", "annual")
_DATED = ("winter", "spring", "summer", "autumn", "static")
# Name, native resolution in metres, first year, last year (None: present), temporal resolution, seasons. No years: static.
VARIABLES = (
    ("ndvi", 10, 2017, None, "5_day", _FIVE),
    ("fvc", 10, 2017, None, "seasonal", _FIVE),
    ("ndmi", 20, 2017, None, "5_day", _FIVE),
    ("msi", 20, 2017, None, "5_day", _FIVE),
    ("bsi", 20, 2017, None, "5_day", _FIVE),
    ("rgb", 10, 2017, None, "5_day", _DATED),
    ("rgb_raw", 10, 2017, None, "5_day", _DATED),
    ("swi", 1000, 2015, None, "daily_or_static", _DATED),
    ("alpha_earth", 10, 2017, None, "annual", ("annual",)),
    ("clcplus", 10, 2018, 2023, "static", ("annual",)),
    ("bdod", 250, 0, 0, "static", ("annual",)),
    ("clay", 250, 0, 0, "static", ("annual",)),
    ("cfvo", 250, 0, 0, "static", ("annual",)),
    ("sand", 250, 0, 0, "static", ("annual",)),
    ("silt", 250, 0, 0, "static", ("annual",)),
    ("cec", 250, 0, 0, "static", ("annual",)),
    ("gbif_occurrences", None, 1900, None, "event", _FIVE),
)
SOIL = ("bdod", "clay", "cfvo", "sand", "silt", "cec")
OCCURRENCES = "gbif_occurrences"
#: Indices that read one 20 m band; two or more of them share a scan.
SHARED = ("ndmi", "msi", "bsi")


def variables(spark: SparkSession) -> DataFrame:
    """(name, native_resolution_m, start_year, end_year, temporal_resolution, season_options, is_static, is_present, ext, timed)."""
    rows = [(n, r, None if s == 0 else s, None if s == 0 else e, t, list(o), s == 0, e is None and s != 0, "geojson" if n == OCCURRENCES else "tif", n not in (*SOIL, OCCURRENCES)) for n, r, s, e, t, o in VARIABLES]
    return spark.createDataFrame(rows, "name string, native_resolution_m int, start_year int, end_year int, temporal_resolution string, season_options array<string>, is_static boolean, is_present boolean, ext string, timed boolean")


def lookup(requested: DataFrame, column: str = "variable") -> tuple[DataFrame, DataFrame]:
    """Requested names with what the catalogue knows of them, ignoring case; and the names that it doesn't know."""
    known = variables(requested.sparkSession)
    key = F.lower(F.col(column))
    return requested.join(F.broadcast(known), key == F.col("name")), requested.join(F.broadcast(known), key == F.col("name"), "left_anti")


def common_years(requested: DataFrame, as_of: int, by: str) -> DataFrame:
    """(by, year): the years that all variables of a request cover; a request of static ones only has the current year."""
    known, _ = lookup(requested)
    end = F.when(F.col("is_present"), as_of).otherwise(F.col("end_year"))
    spans = known.groupBy(by).agg(F.coalesce(F.max("start_year"), F.lit(as_of)).alias("first"), F.coalesce(F.min(F.when(~F.col("is_static"), end)), F.lit(as_of)).alias("last"))
    return spans.where("first <= last").select(by, F.explode(F.sequence("first", "last")).alias("year"))


def common_seasons(requested: DataFrame, by: str) -> DataFrame:
    """(by, seasons): the seasons that all variables of a request have, in canonical order; annual if there are none."""
    known, _ = lookup(requested.select(by, "variable").distinct())
    total = known.groupBy(by).agg(F.count(F.lit(1)).alias("wanted"))
    each = known.select(by, F.explode("season_options").alias("season")).groupBy(by, "season").agg(F.count(F.lit(1)).alias("have"))
    shared = each.join(total, by).where("have = wanted").groupBy(by).agg(F.collect_set("season").alias("s"))
    order = F.array(*map(F.lit, SEASON_ORDER))
    out = total.select(by).join(shared, by, "left").select(by, F.filter(order, lambda x: F.array_contains(F.coalesce(F.col("s"), F.array().cast("array<string>")), x)).alias("seasons"))
    return out.withColumn("seasons", F.when(F.size("seasons") == 0, F.array(F.lit("annual"))).otherwise(F.col("seasons")))


def effective_resolution(requested: DataFrame, by: str, asked: str = "resolution") -> DataFrame:
    """(by, resolution): what was asked for, else the coarsest native one of the variables."""
    known, _ = lookup(requested)
    return known.groupBy(by).agg(F.coalesce(F.max(asked), F.max("native_resolution_m")).alias("resolution"))
