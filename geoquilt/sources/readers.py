"""Files as tables: every reader has a fixed schema, so nothing is inferred and no extra pass is made."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry

BOX = ("xmin", "ymin", "xmax", "ymax")
_POINT = "array<array<array<double>>>"
FEATURES = f"crs struct<properties:struct<name:string>>, features array<struct<properties:struct<id:bigint>, geometry:struct<type:string, coordinates:{_POINT}>>>"
ITEMS = f"features array<struct<id:bigint, bbox:array<double>, geometry:struct<type:string, coordinates:{_POINT}>, properties:struct<datetime:string, start_datetime:string, `eo:cloud_cover`:double, cloudCover:double, `s2:cloud_coverage`:double>>>"
# The fields of an occurrence record, in their order.
RECORD_FIELDS = (
    "gbifID", "occurrenceID", "datasetKey", "basisOfRecord", "occurrenceStatus", "scientificName", "species", "speciesKey", "genus", "genusKey",
    "family", "familyKey", "order", "orderKey", "class", "classKey", "phylum", "phylumKey", "kingdom", "kingdomKey", "taxonRank", "taxonKey",
    "eventDate", "year", "month", "day", "country", "countryCode", "stateProvince", "locality", "decimalLatitude", "decimalLongitude",
    "coordinateUncertaintyInMeters", "elevation", "depth", "recordedBy", "identifiedBy", "institutionCode", "collectionCode", "catalogNumber",
    "license", "rightsHolder", "references", "lastInterpreted", "issues",
)
_TEXT = "string"
_NOT_TEXT = dict.fromkeys(("year", "month", "day"), "int") | dict.fromkeys(("decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters", "elevation", "depth"), "double") | {"issues": "array<string>"}
RECORDS = f"results array<struct<key:bigint, {', '.join(f'`{name}`:{_NOT_TEXT.get(name, _TEXT)}' for name in RECORD_FIELDS)}>>"
#: Names used here for fields of a record.
RECORD_NAMES = {"gbifID": "gbif_id", "occurrenceID": "occurrence_id", "decimalLongitude": "lon", "decimalLatitude": "lat", "kingdomKey": "kingdom_key", "classKey": "class_key", "eventDate": "event_date", "scientificName": "scientific_name"}
RUNS = "job_info struct<job_name:string, ts:string, git_commit:string>, execution struct<total_outputs:int, successful_outputs:int, failed_outputs:int>, outputs array<struct<output_id:bigint, variable:string, year:string, season:string, gcs_uri:string>>"
HISTORY = "job_name string, ts string, git_commit string, output_id bigint, variable string, year string, season string, gcs_uri string"


def _ring(coordinates):
    return F.transform(F.element_at(coordinates, 1), lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y")))


def features(spark: SparkSession, path: str, crs: str | None = None, lines: bool = False) -> DataFrame:
    """(crs, feature_id, ring) of GeoJSON feature collections: a file each or, with ``lines``, a line each.

    ``crs`` is taken where a file names none; without it such a file is an error, as is one without features.
    """
    read = spark.read.option("multiLine", not lines).schema(FEATURES).json(path)
    name = F.coalesce("crs.properties.name", F.lit(crs))
    if crs is None:
        name = F.when(name.isNull(), F.raise_error(F.lit("a file names no coordinate system"))).otherwise(name)
        read = read.withColumn("features", F.when(F.size("features") > 0, F.col("features")).otherwise(F.raise_error(F.lit("a file has no features")).cast(read.schema["features"].dataType)))
    return read.select(name.alias("crs"), F.explode("features").alias("f")).select("crs", F.col("f.properties.id").alias("feature_id"), _ring(F.col("f.geometry.coordinates")).alias("ring"))


def polygons(spark: SparkSession, path: str, crs: str | None = None, lines: bool = False) -> DataFrame:
    """(crs, feature_id, rings) of GeoJSON Polygon and MultiPolygon features: all rings of all parts, holes among them.

    Other kinds of geometry have no rings (NULL). Files as in ``features``: a file each or, with ``lines``, a line each; one
    that names no system takes ``crs``, without which it is an error, as is one without features.
    """
    shape = "crs struct<properties:struct<name:string>>, features array<struct<properties:struct<id:bigint>, geometry:struct<type:string, coordinates:string>>>"
    read = spark.read.option("multiLine", not lines).schema(shape).json(path)
    name = F.coalesce("crs.properties.name", F.lit(crs))
    if crs is None:
        name = F.when(name.isNull(), F.raise_error(F.lit("a file names no coordinate system"))).otherwise(name)
        read = read.withColumn("features", F.when(F.size("features") > 0, F.col("features")).otherwise(F.raise_error(F.lit("a file has no features")).cast(read.schema["features"].dataType)))
    point = lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y"))
    text = F.col("f.geometry.coordinates")
    whole = F.when(F.col("f.geometry.type") == "Polygon", F.from_json(text, _POINT)).when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(F.from_json(text, f"array<{_POINT}>")))
    return read.select(name.alias("crs"), F.explode("features").alias("f")).select("crs", F.col("f.properties.id").alias("feature_id"), F.transform(whole, lambda r: F.transform(r, point)).alias("rings"))


def scene_items(spark: SparkSession, path: str) -> DataFrame:
    """(scene_id, acq_date, xmin … ymax, cloud) of catalogue pages: the box of the geometry, else the bbox; the first date and cloud that are given."""
    item = spark.read.schema(ITEMS).json(path).select(F.explode("features").alias("f")).select("f.*")
    p = F.col("properties")
    date = F.substring(F.coalesce(p["datetime"], p["start_datetime"]), 1, 10).try_cast("date")
    ring = _ring(F.col("geometry.coordinates"))
    side = lambda pick, axis, place: F.coalesce(pick(F.transform(ring, lambda q: q[axis])), F.try_element_at("bbox", F.lit(place))).alias(("x" if axis == "x" else "y") + ("min" if pick is F.array_min else "max"))
    return item.select(F.col("id").alias("scene_id"), date.alias("acq_date"), side(F.array_min, "x", 1), side(F.array_min, "y", 2), side(F.array_max, "x", 3), side(F.array_max, "y", 4), F.coalesce(p["eo:cloud_cover"], p["cloudCover"], p["s2:cloud_coverage"]).alias("cloud")).where("acq_date is not null")


def occurrence_pages(spark: SparkSession, path: str) -> DataFrame:
    """Records of result pages with all their fields, the most used ones (RECORD_NAMES) by the names used here."""
    r = spark.read.schema(RECORDS).json(path).select(F.explode("results").alias("r")).select("r.*")
    return r.withColumnsRenamed(RECORD_NAMES)


def run_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).json(path)


def run_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(HISTORY).csv(path)


def listing_links(pages: DataFrame, pattern: str = r'href="([^"]*)"', html: str = "html", required: bool = False) -> DataFrame:
    """(link): the distinct targets of links in HTML listings, in their order. With ``required`` it is an error to find none."""
    links = pages.select(F.explode(F.regexp_extract_all(html, F.lit(pattern), 1)).alias("link")).distinct().orderBy("link")
    if required and links.isEmpty():
        raise ValueError("the listings hold no link")
    return links


def observations(spark: SparkSession, path: str, start: str, end: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """What ``sinks.write_observations`` wrote, from start to end, both included, of pixels whose centre is in a box, borders included.

    Months are partitions; dates, rows and columns are plain comparisons, by which files are skipped.
    """
    out = spark.read.parquet(path).where((F.col("month") >= start[:7]) & (F.col("month") <= end[:7]))
    out = out.where(F.col("obs_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if box is not None:
        low, high = (lambda v: math.ceil(v - 0.5)), (lambda v: math.floor(v - 0.5))
        out = out.where(F.col("col").between(low(box[0]), high(box[2])) & F.col("row").between(low(box[1]), high(box[3])))
    return out.drop("month")


def tile_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, number) of the Parquet files under a path, by the number in their names; only names are read from the rows."""
    from ..operators.rasters import tile_number

    file = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path")).distinct()
    return file.withColumn("number", tile_number(F.col("path")))


def annual_layer(embeddings: DataFrame, year: int, label: str = "year") -> DataFrame:
    """The rows of one year; years are half-open, from January 1 to before the next."""
    return embeddings.where((F.col(label) >= year) & (F.col(label) < year + 1))


def annual_images(images: DataFrame, areas: DataFrame, year: int, date: str = "image_date", key: str = "image_id", required: bool = False) -> DataFrame:
    """For each area (aoi_id, ring) the first image (date, then key) of a year whose box meets it; a year ends before January 1 of the next.

    The dates are plain filters and reach the scan. With ``required`` an area without an image is an error.
    """
    of_year = images.where((F.col(date) >= F.lit(f"{year}-01-01").cast("date")) & (F.col(date) < F.lit(f"{year + 1}-01-01").cast("date")))
    columns = [c for c in images.columns if c != "aoi_id"]
    rings = areas.select("aoi_id", "ring").distinct()
    box = geometry.ring_box(F.col("ring"))
    boxed = rings.select("aoi_id", "ring", *[box[c].alias(f"a_{c}") for c in BOX])
    size = geometry.cell_size(boxed, tuple(f"a_{c}" for c in BOX))
    keyed = geometry.with_box_cells(boxed, tuple(f"a_{c}" for c in BOX), size)
    met = geometry.with_box_cells(of_year, BOX, size).join(geometry.small_or_not(keyed), ["cell_x", "cell_y"])
    met = met.where(geometry.ring_meets_box(F.col("ring"), tuple(map(F.col, BOX))))
    first = met.groupBy("aoi_id").agg(F.min_by(F.struct(*columns), F.struct(date, key)).alias("image"))
    if required:
        missing = rings.select("aoi_id").distinct().join(first, "aoi_id", "left_anti").limit(1).collect()
        if missing:
            raise ValueError(f"no image of {year} for area {missing[0].aoi_id}")
    return first.select("aoi_id", "image.*")


def raster_catalog(files: DataFrame, patterns: tuple[str, ...] = ("*.tif", "*.tiff", "*.vrt"), required: bool = False) -> DataFrame:
    """(path, xmin, ymin, xmax, ymax, resolution): the rasters whose file name fits a pattern, each path once, in order of the path.

    ``files`` has path, the sides of the box, width and height in pixels. The resolution is the longer side of a pixel, NULL
    where a side is 0. With ``required`` it is an error to find none.
    """
    name = F.element_at(F.split("path", "/"), -1)
    fits = F.lit(False)
    for p in patterns:
        fits = fits | name.like(p.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%").replace("?", "_"))
    wide, high = F.abs(F.try_divide(F.col("xmax") - F.col("xmin"), F.col("width"))), F.abs(F.try_divide(F.col("ymax") - F.col("ymin"), F.col("height")))
    found = files.where(fits).dropDuplicates(["path"]).select("path", *BOX, F.when((wide > 0) & (high > 0), F.greatest(wide, high)).alias("resolution")).orderBy("path")
    if required and found.isEmpty():
        raise ValueError(f"no file fits {', '.join(patterns)}")
    return found
