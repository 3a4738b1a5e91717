"""Species occurrence records: filters, clean-up, duplicates, areas and counting tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry, text
from ..sources.readers import RECORD_FIELDS, RECORD_NAMES
from . import areas as area_tests

# Names of taxon keys.
KINGDOMS = {1: "Animalia", 2: "Archaea", 3: "Bacteria", 4: "Chromista", 5: "Fungi", 6: "Plantae", 7: "Protozoa", 8: "Viruses"}
CLASSES = {212: "Aves", 359: "Mammalia"}
TAXON_KEYS = ("taxon_key", "species_key", "genus_key", "family_key", "order_key", "class_key", "phylum_key", "kingdom_key")
_FIELD_OF = {ours: field for field, ours in RECORD_NAMES.items()} | {"dataset_key": "datasetKey", "basis_of_record": "basisOfRecord", "occurrence_status": "occurrenceStatus", "taxon_key": "taxonKey"}


def select_taxa(occ: DataFrame, kingdoms: list[int] | None = None, classes: list[int] | None = None) -> DataFrame:
    """Records with coordinates, of the kingdoms, and of the classes where the kingdom is 1.

    Keys that are no whole number drop the record. Classes count only where kingdoms are named.
    """
    out = occ.where(F.col("lon").try_cast("double").isNotNull() & F.col("lat").try_cast("double").isNotNull())
    if kingdoms:
        kingdom = F.col("kingdom_key").try_cast("int")
        out = out.where(kingdom.isin(*kingdoms))
        if classes:
            out = out.where((kingdom != 1) | F.coalesce(F.col("class_key").try_cast("int").isin(*classes), F.lit(False)))
    return out


def requested(occ: DataFrame, taxon: int | None = None, dataset: str | None = None, basis: str | None = None, status: str | None = None) -> DataFrame:
    """Records with coordinates that a request names: of a taxon (their own key or one above it), a dataset, a basis of record and a status.

    Basis and status are compared in upper case; what is not named, or blank, does not filter.
    """
    out = occ.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    if taxon is not None:
        keys = [c for c in TAXON_KEYS if c in occ.columns]
        of = F.lit(False)
        for c in keys:
            of = of | F.coalesce(F.col(c).try_cast("int") == taxon, F.lit(False))
        out = out.where(of)
    for column, wanted in (("dataset_key", dataset), ("basis_of_record", (basis or "").upper()), ("occurrence_status", (status or "").upper())):
        if wanted and wanted.strip():
            have = F.col(column) if column == "dataset_key" else F.upper(column)
            out = out.where(have == wanted.strip())
    return out


def as_records(occ: DataFrame, *also: str) -> DataFrame:
    """Normalized records with the published fields, in their order and by their names; fields that occ lacks are NULL, other columns go but those named."""
    done = normalize(occ)
    known = {field: F.col(f"`{name}`") for name in done.columns for field in [_FIELD_OF.get(name, name)] if field in RECORD_FIELDS}
    return done.select(*also, *[known.get(field, F.lit(None).cast("string")).alias(field) for field in RECORD_FIELDS])


def allowed_licenses(occ: DataFrame, allowed: list[str]) -> DataFrame:
    return occ.where(text.license_allowed(F.col("license"), allowed))


def normalize(occ: DataFrame) -> DataFrame:
    """Records with species, year and issues filled in: species from the scientific name, year from the event date, issues as one text."""
    out = occ.withColumn("species", F.coalesce(F.nullif(F.col("species"), F.lit("")), F.col("scientific_name")))
    out = out.withColumn("year", F.coalesce(F.nullif(F.col("year"), F.lit(0)), text.first_year(F.col("event_date"))))
    if "issues" in occ.columns:
        out = out.withColumn("issues", F.array_join(F.array_compact("issues"), ";"))
    if "key" in occ.columns:
        out = out.withColumn("gbif_id", F.coalesce(F.nullif(F.col("gbif_id"), F.lit("")), F.col("key").cast("string")))
    return out


def with_labels(occ: DataFrame, key: str, labels: dict[int, str], name: str) -> DataFrame:
    """occ with the name of a taxon key; a key without a name gives its own text."""
    dimension = occ.sparkSession.createDataFrame(list(labels.items()), f"label_key int, {name} string")
    joined = occ.join(F.broadcast(dimension), F.col(key).try_cast("int") == F.col("label_key"), "left")
    return joined.withColumn(name, F.coalesce(name, F.col(key).cast("string"))).drop("label_key")


def first_of_each(occ: DataFrame, order: list[str]) -> DataFrame:
    """The first record, in order, of each id (gbif_id, else occurrence_id); records without either all stay."""
    key = F.coalesce(F.concat(F.lit("g:"), F.nullif(F.col("gbif_id"), F.lit(""))), F.concat(F.lit("o:"), F.nullif(F.col("occurrence_id"), F.lit(""))))
    keyed = occ.withColumn("record_key", key)
    known = keyed.where("record_key is not null").withColumn("n", F.row_number().over(Window.partitionBy("record_key").orderBy(*order))).where("n = 1").drop("n")
    return known.unionByName(keyed.where("record_key is null")).drop("record_key")


def capped(occ: DataFrame, most: int, order: list[str]) -> DataFrame:
    """The first ``most`` records in order."""
    return occ.orderBy(*order).limit(most)


def in_areas(points: DataFrame, areas: DataFrame, x: str = "lon", y: str = "lat", edge: bool = True) -> DataFrame:
    """Points inside an area or, with ``edge``, on its border: each once, however many features hold it. See ``areas.tagged`` for which."""
    return area_tests.inside_any(points, areas, x, y, edge)


def kingdom_union(occ: DataFrame, classes: list[int], others: list[int], order: list[str]) -> DataFrame:
    """Animals of some classes together with other kingdoms: one pass with an OR instead of two searches, each id once."""
    kingdom = F.col("kingdom_key").try_cast("int")
    animals = (kingdom == 1) & F.coalesce(F.col("class_key").try_cast("int").isin(*classes), F.lit(False)) if classes else kingdom == 1
    return first_of_each(occ.where(animals | kingdom.isin(*others)), order)


def tile_counts(points: DataFrame, size: float, x: str = "lon", y: str = "lat") -> DataFrame:
    """(cell_x, cell_y, n): points in each half-open cell."""
    return geometry.with_point_cells(points.where(F.col(x).isNotNull() & F.col(y).isNotNull()), x, y, size).groupBy("cell_x", "cell_y").agg(F.count(F.lit(1)).alias("n"))


def quadtree(points: DataFrame, box: tuple[float, float, float, float], target: int, depth: int = 6, x: str = "x", y: str = "y", max_records: int | None = None, limit: int = 200_000) -> DataFrame:
    """(depth, ix, iy, n): the boxes that come from cutting a box in four until it holds at most ``target`` points.

    Points are counted once, at the deepest level; counts of larger boxes are sums of these. Empty boxes are left out.
    A request for at most ``target`` records (``max_records``) is one box, whatever it holds. A box of the deepest level
    with more than ``limit`` points, which no page of a source reaches, fails the job.
    """
    target = max(1, target)
    if max_records is not None and max_records <= target:
        inside = points.where(F.col(x).between(box[0], box[2]) & F.col(y).between(box[1], box[3]))
        whole = inside.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        return whole.select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("ix"), F.lit(0).cast("long").alias("iy"), "n")
    side = 1 << depth
    place = lambda c, low, high: F.least(F.floor((F.col(c) - low) / (high - low) * side), F.lit(side - 1)).cast("long")
    deep = points.where(F.col(x).between(box[0], box[2]) & F.col(y).between(box[1], box[3])).select(place(x, box[0], box[2]).alias("ix"), place(y, box[1], box[3]).alias("iy")).groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n"))
    level = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth")
    rolled = deep.select("ix", "iy", "n", level).select("depth", "n", F.expr(f"shiftright(ix, {depth} - depth)").alias("jx"), F.expr(f"shiftright(iy, {depth} - depth)").alias("jy"))
    counts = rolled.groupBy("depth", F.col("jx").alias("ix"), F.col("jy").alias("iy")).agg(F.sum("n").alias("n"))
    above = counts.select((F.col("depth") + 1).alias("depth"), F.col("ix").alias("px"), F.col("iy").alias("py"), F.col("n").alias("parent"))
    joined = counts.withColumn("px", F.expr("ix div 2")).withColumn("py", F.expr("iy div 2")).join(above, ["depth", "px", "py"], "left")
    leaf = (F.col("n") <= target) | (F.col("depth") == depth)
    leaves = joined.where(leaf & (F.col("parent").isNull() | (F.col("parent") > target)))
    beyond = (F.col("depth") == depth) & (F.col("n") > max(target, limit))
    n = F.when(beyond, F.raise_error(F.lit(f"a box of the deepest level holds more than {limit} points")).cast("long")).otherwise(F.col("n"))
    return leaves.select("depth", "ix", "iy", n.alias("n"))
