"""Queries over readers and sinks: files are made from the derived views, written, and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import geometry, spectral, text
from .operators import observations as ob
from .operators import rasters as ra
from .plans import tracking
from .registry import query, rounded
from .sources import readers, scratch, sinks
from .sources.views import aoi, view
from .streaming import occurrences as stream

BOX = ["xmin", "ymin", "xmax", "ymax"]


def _ring():
    return F.array(*[F.array(x, y) for x, y in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin"))])


def _collections(spark, d, crs):
    """Tiles as feature collections, a line for every hundred."""
    polygon = F.struct(F.lit("Polygon").alias("type"), F.array(_ring()).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("tile_id").alias("id")).alias("properties"), polygon.alias("geometry"))
    grouped = view(spark, d, "tiles").groupBy(F.expr("tile_id div 100").alias("part")).agg(F.collect_list(feature).alias("features"))
    whole = F.struct(F.lit("FeatureCollection").alias("type"), *([F.struct(F.struct(F.lit(crs).alias("name")).alias("properties")).alias("crs")] if crs else []), "features")
    path = scratch.new_path(spark, "features")
    grouped.select(F.to_json(whole).alias("value")).write.text(path)
    return path


FEATURES_SQL = "select tile_id as feature_id, '{crs}' as crs, cast(5 as integer) as vertices, xmin, ymin, xmax, ymax from tiles"


def _described(df):
    return df.select("feature_id", "crs", F.size("ring").alias("vertices"), geometry.ring_box(F.col("ring")).alias("b")).select("feature_id", "crs", "vertices", "b.*")


@query("s1_aoi_features", FEATURES_SQL.format(crs="EPSG:3857"))
def s1_aoi_features(spark, d):
    return _described(readers.features(spark, _collections(spark, d, "EPSG:3857"), lines=True))


@query("s11_vector_scan", FEATURES_SQL.format(crs="EPSG:4326"))
def s11_vector_scan(spark, d):
    """Collections that name no coordinate system are in degrees."""
    return _described(readers.features(spark, _collections(spark, d, None), crs="EPSG:4326", lines=True))


@query("s3_scene_catalog", "select scene_id, cast(acq_date as varchar) as acq_date, xmin, ymin, xmax, ymax, cloud from scenes")
def s3_scene_catalog(spark, d):
    s, odd = view(spark, d, "scenes"), F.col("scene_id") % 2 == 1
    time = F.concat(F.col("acq_date").cast("string"), F.lit("T10:30:00Z"))
    third = lambda k: F.when(F.col("scene_id") % 3 == k, F.col("cloud"))
    properties = F.struct(F.when(odd, time).alias("datetime"), F.when(~odd, time).alias("start_datetime"), third(0).alias("eo:cloud_cover"), third(1).alias("cloudCover"), third(2).alias("s2:cloud_coverage"))
    polygon = F.struct(F.lit("Polygon").alias("type"), F.array(_ring()).alias("coordinates"))
    item = F.struct(F.col("scene_id").alias("id"), F.when(odd, F.array(*BOX)).alias("bbox"), F.when(~odd, polygon).alias("geometry"), properties.alias("properties"))
    path = scratch.new_path(spark, "items")
    s.groupBy(F.expr("scene_id div 100").alias("page")).agg(F.collect_list(item).alias("features")).select(F.to_json(F.struct("features")).alias("value")).write.text(path)
    return readers.scene_items(spark, path).withColumn("acq_date", F.col("acq_date").cast("string"))


@query("s4_occurrence_pages", "select gbif_id, occurrence_id, lon, lat, kingdom_key, license, year, pos as key from occ")
def s4_occurrence_pages(spark, d):
    names = {"gbif_id": "gbifID", "occurrence_id": "occurrenceID", "lon": "decimalLongitude", "lat": "decimalLatitude", "kingdom_key": "kingdomKey", "class_key": "classKey", "event_date": "eventDate", "scientific_name": "scientificName", "pos": "key"}
    raw = view(spark, d, "occ").withColumnsRenamed(names)
    path = scratch.new_path(spark, "pages")
    raw.groupBy(F.expr("key div 100").alias("page")).agg(F.collect_list(F.struct(*raw.columns)).alias("results")).select(F.to_json(F.struct("results")).alias("value")).write.text(path)
    return readers.occurrence_pages(spark, path).select("gbif_id", "occurrence_id", "lon", "lat", "kingdom_key", "license", "year", "key")


@query("s6_listing_links", """select distinct unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as link from pages""")
def s6_listing_links(spark, d):
    return readers.listing_links(spark.read.parquet(f"{d}/pages.parquet"))


FILES_SQL = "select distinct 'data/' || path || case raster_id % 5 when 0 then '.tif' when 1 then '.tiff' when 2 then '.vrt' when 3 then '.txt' else '_tif' end as path, xmin, ymin, xmax, ymax, greatest((xmax - xmin) / (raster_id % 7 + 1), (ymax - ymin) / (raster_id % 3 + 1)) as resolution from rasters where raster_id % 5 < 3"


@query("s7_raster_catalog", FILES_SQL)
def s7_raster_catalog(spark, d):
    """Rasters whose file names fit a pattern, each once, with the longer side of their pixels; every file is listed twice."""
    end = F.element_at(F.array(*map(F.lit, (".tif", ".tiff", ".vrt", ".txt", "_tif"))), (F.col("raster_id") % 5 + 1).cast("int"))
    files = view(spark, d, "rasters").withColumns({"path": F.concat(F.lit("data/"), "path", end), "width": F.col("raster_id") % 7 + 1, "height": F.col("raster_id") % 3 + 1})
    return readers.raster_catalog(files.unionByName(files))


IMAGES_SQL = "select vec_id as image_id, make_date(2017 + vec_id % 5, 1 + vec_id % 12, 1 + vec_id % 28) as image_date, cast(vec_id * 7 % 20 as double) as xmin, cast(vec_id * 11 % 20 as double) as ymin from emb_px"
FIRST_SQL = "select image_id, image_date, row_number() over (order by image_date, image_id) as n from images where image_date >= date '2019-01-01' and image_date < date '2020-01-01' and xmin <= 12 and xmin + 3 >= 4 and ymin <= 12 and ymin + 3 >= 4"


@query("s8_first_image", "select 'A' as aoi_id, image_id, cast(image_date as varchar) as image_date from first where n = 1", images=IMAGES_SQL, first=FIRST_SQL)
def s8_first_image(spark, d):
    """The first image of a year over an area."""
    low = lambda k: (F.col("vec_id") * k % 20).cast("double")
    date = F.make_date((F.lit(2017) + F.col("vec_id") % 5).cast("int"), (F.col("vec_id") % 12 + 1).cast("int"), (F.col("vec_id") % 28 + 1).cast("int"))
    images = view(spark, d, "emb_px").select(F.col("vec_id").alias("image_id"), date.alias("image_date"), low(7).alias("xmin"), low(11).alias("ymin"), (low(7) + 3).alias("xmax"), (low(11) + 3).alias("ymax"))
    return readers.annual_images(images, aoi(spark, "A"), 2019).select("aoi_id", "image_id", F.col("image_date").cast("string").alias("image_date"))


@query("s8_embedding_scan", "select tile, min(vec_id) as vec_id from emb_px where year = 2019 group by tile")
def s8_embedding_scan(spark, d):
    """The first layer of a year for each tile."""
    return readers.annual_layer(view(spark, d, "emb_px"), 2019).groupBy("tile").agg(F.min("vec_id").alias("vec_id"))


@query("s9_tile_files", "select tile_id, cast(case when tile_id % 3 = 0 then 0 else tile_id end as integer) as number from tiles")
def s9_tile_files(spark, d):
    name = F.when(F.col("tile_id") % 3 == 0, F.concat(F.lit("/data/"), F.col("relpath"), F.lit(".tif"))).otherwise(F.concat(F.lit("/data/tile_v2_tile"), F.col("tile_id"), F.lit(".tif")))
    return view(spark, d, "tiles").select("tile_id", ra.tile_number(name).alias("number"))


HISTORY_SQL = "select 'json' as source, job_name, count(*) as n, count(gcs_uri) as stored from outputs group by job_name union all select 'csv', job_name, count(*), count(gcs_uri) from outputs group by job_name"


@query("s10_run_history", HISTORY_SQL)
def s10_run_history(spark, d):
    path = scratch.new_path(spark, "history")
    outputs = view(spark, d, "outputs")
    tracking.documents(outputs).write.json(f"{path}/json")
    outputs.write.option("header", True).csv(f"{path}/csv")
    parts = [("json", tracking.flat(readers.run_records(spark, f"{path}/json"))), ("csv", readers.run_history(spark, f"{path}/csv"))]
    counted = [df.groupBy("job_name").agg(F.count(F.lit(1)).alias("n"), F.count("gcs_uri").alias("stored")).select(F.lit(k).alias("source"), "job_name", "n", "stored") for k, df in parts]
    return counted[0].unionByName(counted[1])


@query("k1_write_layer", "select row, col, round(coalesce(avg(b04), -9999), 9) as value, case when row % 2 = 0 then 'ndvi' else 'msi' end as variable, cast(1996 as integer) as year, 'summer' as season, 'a' as aoi from obs where scl = 4 group by row, col")
def k1_write_layer(spark, d):
    layer = view(spark, d, "obs").where("scl = 4").groupBy("row", "col").agg(F.avg("b04").alias("value"))
    layer = layer.select("row", "col", "value", F.when(F.col("row") % 2 == 0, "ndvi").otherwise("msi").alias("variable"), F.lit("1996").alias("year"), F.lit("summer").alias("season"), F.lit("a").alias("aoi"))
    path = scratch.new_path(spark, "layers")
    sinks.write_layer(layer, path, ["value"])
    return rounded(spark.read.parquet(path), "value")


@query("k2_split_bands", ", m as (select row, col, median(b04) as b04, median(b08) as b08 from obs where scl = 4 group by row, col) select row, col, 'b04' as variable, coalesce(b04, -9999) as value from m union all select row, col, 'b08', coalesce(b08, -9999) from m")
def k2_split_bands(spark, d):
    path = scratch.new_path(spark, "bands")
    sinks.write_bands(ob.composite(view(spark, d, "obs").where("scl = 4"), ["b04", "b08"]), path, ["b04", "b08"])
    return spark.read.parquet(path)


@query("k3_write_vector", "select pos, lon, lat from occ where lon is not null")
def k3_write_vector(spark, d):
    path = scratch.new_path(spark, "points")
    sinks.write_features(view(spark, d, "occ").where("lon is not null"), path)
    read = spark.read.schema("geometry struct<coordinates:array<double>>, properties struct<pos:bigint>").json(path)
    return read.select("properties.pos", F.col("geometry.coordinates")[0].alias("lon"), F.col("geometry.coordinates")[1].alias("lat"))


@query("k4_write_run_report", "select job_name, count(*) as n, count(distinct (job_name, ts, git_commit)) as runs from outputs group by job_name")
def k4_write_run_report(spark, d):
    path = scratch.new_path(spark, "reports")
    sinks.write_reports(view(spark, d, "outputs"), path)
    flat = spark.read.option("header", True).schema("job_name string, ts string, git_commit string, total_outputs int, successful_outputs int, failed_outputs int, output_id bigint, variable string, year string, season string, gcs_uri string").csv(f"{path}/csv")
    return flat.groupBy("job_name").agg(F.count("output_id").alias("n"), F.count_distinct("job_name", "ts", "git_commit").alias("runs"))


@query("k4_run_records_read_back", "select job_name, count(*) as n, count(distinct (ts, git_commit)) as runs, count(gcs_uri) as stored from outputs group by job_name")
def k4_run_records_read_back(spark, d):
    """The JSON of the reports, read by the reader of run records."""
    path = scratch.new_path(spark, "reports")
    sinks.write_reports(view(spark, d, "outputs"), path)
    runs = readers.run_records(spark, f"{path}/json")
    stored = F.size(F.filter("outputs", lambda o: o["gcs_uri"].isNotNull()))
    return runs.groupBy("job_info.job_name").agg(F.sum(F.size("outputs")).alias("n"), F.count(F.lit(1)).alias("runs"), F.sum(stored).alias("stored"))


@query("s2_pruned_scan", "select obs_id, row, col, cast(obs_date as varchar) as obs_date, b04 from obs where obs_date between date '1996-06-10' and date '1996-08-20' and col + 0.5 between 4 and 12 and row + 0.5 between 4 and 12")
def s2_pruned_scan(spark, d):
    """Observations written by month and neighbourhood, and a box of some months read again."""
    path = scratch.new_path(spark, "observations")
    sinks.write_observations(view(spark, d, "obs"), path)
    found = readers.observations(spark, path, "1996-06-10", "1996-08-20", (4, 4, 12, 12))
    return found.select("obs_id", "row", "col", F.col("obs_date").cast("string").alias("obs_date"), "b04")


COLLECTION_SQL = "case event_id % 7 when 0 then 'SENTINEL2_L2A' when 1 then 'my_sentinel2_l2a' when 2 then 'Sentinel2-L1C' when 3 then 'landsat_l2a' when 4 then '' when 5 then null else 'SENTINEL2_L2A_SENTINELHUB' end"


@query("fn_catalogue_id", f"select event_id, case when c like '%SENTINEL2%' then case when c like '%L2A%' then 'sentinel-2-l2a' when c like '%L1C%' then 'sentinel-2-l1c' end end as catalogue_id, case when event_id % 3 = 0 and trim(coalesce(raw, '')) <> '' then raw when event_id % 5 <> 0 then 'from settings' else 'SENTINEL2_L2A' end as collection from (select event_id, {COLLECTION_SQL} as raw, upper({COLLECTION_SQL}) as c from events)")
def fn_catalogue_id(spark, d):
    """Catalogue ids of collections; and the collection of a job: its argument, else the settings', else the usual one."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.expr(COLLECTION_SQL).alias("raw"))
    given = text.first_given(F.when(F.col("event_id") % 3 == 0, F.col("raw")), F.when(F.col("event_id") % 5 == 0, F.lit("  ")).otherwise(F.lit("from settings")), F.lit("SENTINEL2_L2A"))
    return events.select("event_id", text.catalogue_id(F.col("raw")).alias("catalogue_id"), given.alias("collection"))


@query("fn_slug_and_paths", "select output_id, trim(regexp_replace(lower(job_name || ' / ' || variable), '[^a-z0-9]+', '_', 'g'), '_') as slug, variable || '_' || year || '_' || season || '_' || lower(job_name) || '.tif' as name, 'base/' || variable || '/' || year as path from outputs")
def fn_slug_and_paths(spark, d):
    o = view(spark, d, "outputs")
    name = text.output_name(F.col("variable"), F.col("year"), F.col("season"), text.slug(F.col("job_name")), F.lit(".tif"), F.lit(True))
    return o.select("output_id", text.slug(F.concat_ws(" / ", "job_name", "variable")).alias("slug"), name.alias("name"), text.path_join(F.lit("/base/"), F.col("variable"), F.lit(" "), F.lit(None), F.col("year")).alias("path"))


@query("fn_lists", "select p_partkey as id, p_name as parts, p_size as number, 'Q0.' || p_size as stat, p_size || '-30cm' as depth from part")
def fn_lists(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    listed = F.concat(F.lit(" ,"), F.col("p_name"), F.lit(", ,"))
    numbers = text.numbers_of(F.concat(F.lit("x, "), F.col("p_size"), F.lit(",y")))
    return part.select(F.col("p_partkey").alias("id"), F.array_join(text.list_of(listed), ",").alias("parts"), F.element_at(numbers, 1).alias("number"), text.statistic_name(F.concat(F.lit("q0."), F.col("p_size"))).alias("stat"), text.depth_name(F.concat(F.col("p_size"), F.lit(" - 30"))).alias("depth"))


@query("stream_occurrence_counts", "select cast(cast(ts as date) as varchar) as day, count(*) as n from events group by 1")
def stream_occurrence_counts(spark, d):
    """A stream of records, counted by day as far as the watermark has passed and then to the end of the input."""
    schema = spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts").schema
    name = f"counts_{scratch.new_path(spark, 'x').rsplit('-', 1)[1]}"
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    started = stream.counts(rows, "ts").writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).option("checkpointLocation", scratch.new_path(spark, "stream")).start()
    started.awaitTermination()
    return spark.table(name).select(F.col("start").cast("date").cast("string").alias("day"), "n")
