"""Extraction plans: jobs as rows, tasks as rows, and what of them is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import catalog


def plan(jobs: DataFrame) -> DataFrame:
    """(job, aoi, season, year, task_type, variables) for jobs (job, aois, seasons, years, variables: arrays).

    Lists lose repeated values. Soil variables are one task for each area (static, annual), occurrences
    too (all, all); two or more indices that share a band are one task.
    """
    each = jobs.select("job", F.explode(F.array_distinct("aois")).alias("aoi"), F.array_distinct("seasons").alias("seasons"), F.array_distinct("years").alias("years"), F.array_distinct(F.transform("variables", F.lower)).alias("variables"))
    fixed = F.array(*map(F.lit, (*catalog.SOIL, catalog.OCCURRENCES)))
    shared = F.array(*map(F.lit, catalog.SHARED))
    once = each.select("job", "aoi", F.explode(F.array_intersect("variables", fixed)).alias("v"))
    occurrences = F.col("v") == catalog.OCCURRENCES
    once = once.select("job", "aoi", F.when(occurrences, "all").otherwise("annual").alias("season"), F.when(occurrences, "all").otherwise("static").alias("year"), F.lit("single").alias("task_type"), F.array("v").alias("variables"))
    dated = each.select("job", "aoi", F.explode("seasons").alias("season"), "years", "variables").select("job", "aoi", "season", F.explode("years").alias("year"), "variables").withColumn("year", F.col("year").cast("string"))
    dated = dated.withColumn("many", F.array_intersect("variables", shared)).withColumn("rest", F.array_except("variables", fixed))
    group = F.size("many") >= 2
    tasks = F.when(group, F.concat(F.array(F.col("many")), F.transform(F.array_except("rest", "many"), lambda v: F.array(v)))).otherwise(F.transform("rest", lambda v: F.array(v)))
    dated = dated.select("job", "aoi", "season", "year", F.explode(tasks).alias("variables"))
    dated = dated.select("job", "aoi", "season", "year", F.when(F.size("variables") > 1, "multi_index").otherwise("single").alias("task_type"), "variables")
    return once.unionByName(dated)


def missing(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """(aoi, season, year, variable, filename): planned single outputs that are not among outputs (aoi, season, year, variable)."""
    planned = tasks.select("aoi", "season", "year", F.explode("variables").alias("variable")).distinct()
    known, _ = catalog.lookup(planned)
    gone = known.join(outputs, ["aoi", "season", "year", "variable"], "left_anti")
    name = text.output_name(text.slug(F.col("variable")), F.col("year"), text.slug(F.col("season")), text.slug(F.col("aoi")), F.col("ext"), F.col("timed"))
    return gone.select("aoi", "season", "year", "variable", name.alias("filename"))


def first_positions(df: DataFrame, by: list[str], array: str) -> DataFrame:
    """The distinct values of lists, each with its first position: (by, value, position)."""
    return df.select(*by, F.posexplode(array).alias("position", "value")).groupBy(*by, "value").agg(F.min("position").alias("position"))
