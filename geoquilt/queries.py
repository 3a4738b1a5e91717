"""Registered queries of the geospatial operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import queries_areas, queries_grids, queries_keyed, queries_plans, queries_rasters, queries_shapes, queries_sources  # noqa: F401  they register themselves
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship_ndvi_summer"](spark, sf_dir)
