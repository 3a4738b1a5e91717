"""Queries over areas of several parts with holes: tags, clips, overlaps, footprints and tilings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import areas as ar
from .registry import query, rounded
from .sources import readers, scratch
from .sources.views import shapes, view

METRES = 100_000.0
PARITY = "(select count(*) from shape_edges e where e.aoi_id = a.aoi_id and (e.y1 > {y}) <> (e.y2 > {y}) and {x} < (e.x2 - e.x1) * ({y} - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1"
ON_EDGE = "exists (select 1 from shape_edges e where e.aoi_id = a.aoi_id and (e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1) and {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2) and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2))"
NAMES = "select distinct aoi_id from shape_edges"
TAGGED_SQL = f"select o.pos, a.aoi_id from occ o, names a where {PARITY.format(x='o.lon', y='o.lat')} or {ON_EDGE.format(x='o.lon', y='o.lat')}"


@query("j1_points_tagged", TAGGED_SQL, names=NAMES)
def j1_points_tagged(spark, d):
    """Records with the areas that they are in, holes and several parts among them, in one pass."""
    return ar.tagged(view(spark, d, "occ"), shapes(spark)).select("pos", "aoi_id")


@query("j1_points_tagged_metres", TAGGED_SQL, names=NAMES)
def j1_points_tagged_metres(spark, d):
    """The same in numbers a hundred thousand times as large: cells follow the areas, not a fixed size."""
    occ = view(spark, d, "occ").withColumns({"x": F.col("lon") * METRES, "y": F.col("lat") * METRES})
    return ar.tagged(occ, shapes(spark, METRES), "x", "y").select("pos", "aoi_id")


@query("j2_pixels_tagged", f"select a.aoi_id, o.row, o.col, count(*) as n from obs o, names a where {PARITY.format(x='(o.col + 0.5)', y='(o.row + 0.5)')} group by all", names=NAMES)
def j2_pixels_tagged(spark, d):
    return ar.clip(view(spark, d, "obs"), shapes(spark)).groupBy("aoi_id", "row", "col").agg(F.count(F.lit(1)).alias("n"))


# The area that rings and a box share, as the integral along the edges of their height above the box's lower side; holes turn the other way.
UNDER = "case when {u} <= 0 then 0 when {u} <= h then {u} * {u} / 2 else h * {u} - h * h / 2 end"
CUT = "select r.path, r.ymax - r.ymin as h, e.aoi_id, sign(e.x2 - e.x1) as s, (e.y2 - e.y1) / (e.x2 - e.x1) as m, greatest(least(e.x1, e.x2), r.xmin) as l, least(greatest(e.x1, e.x2), r.xmax) as r, e.x1, e.y1 - r.ymin as v1 from rasters r, shape_edges e where e.x1 <> e.x2"
PARTS = "select *, v1 + m * (l - x1) as ul, v1 + m * (r - x1) as ur from cut where l < r"
SHARED = f"select aoi_id, path, round(abs(sum(s * case when m = 0 then greatest(0, least(h, ul)) * (r - l) else ({UNDER.format(u='ur')} - ({UNDER.format(u='ul')})) / m end)), 9) as area from parts group by aoi_id, path"
BEST = "select aoi_id, path, area from (select *, row_number() over (partition by aoi_id order by area desc, path) as n from shared where area > 0) where n = 1"


@query("j4_best_overlap_parts", BEST, cut=CUT, parts=PARTS, shared=SHARED)
def j4_best_overlap_parts(spark, d):
    """The raster that shares most with each area, holes not counted."""
    return ar.best_overlap(view(spark, d, "rasters"), shapes(spark), required=True)


# Footprints lean: their corners are on the sides of the scenes' boxes.
FOOT_POINTS = f"select scene_id, k, list_extract(p, k)[1] as x1, list_extract(p, k)[2] as y1, list_extract(p, k % 4 + 1)[1] as x2, list_extract(p, k % 4 + 1)[2] as y2 from (select scene_id, [[xmin + 2, ymin], [xmax, ymin + 3], [xmax - 2, ymax], [xmin, ymax - 3]] as p, unnest([1, 2, 3, 4]) as k from scenes)"
SIDE = "sign(({a}.x2 - {a}.x1) * ({b}.y{k} - {a}.y1) - ({a}.y2 - {a}.y1) * ({b}.x{k} - {a}.x1))"
CROSSING = f"""select distinct f.scene_id, e.aoi_id from foot f join shape_edges e on least(f.x1, f.x2) <= greatest(e.x1, e.x2) and least(e.x1, e.x2) <= greatest(f.x1, f.x2) and least(f.y1, f.y2) <= greatest(e.y1, e.y2) and least(e.y1, e.y2) <= greatest(f.y1, f.y2)
 and {SIDE.format(a='f', b='e', k=1)} * {SIDE.format(a='f', b='e', k=2)} <= 0 and {SIDE.format(a='e', b='f', k=1)} * {SIDE.format(a='e', b='f', k=2)} <= 0"""
IN_SHAPE = f"select distinct f.scene_id, a.aoi_id from foot f, names a where {PARITY.format(x='f.x1', y='f.y1')}"
IN_FOOT = "select scene_id, aoi_id from (select f.scene_id, c.aoi_id, c.x1, c.y1, count(*) as n from foot f join shape_edges c on (f.y1 > c.y1) <> (f.y2 > c.y1) and c.x1 < (f.x2 - f.x1) * (c.y1 - f.y1) / (f.y2 - f.y1) + f.x1 group by all) where n % 2 = 1"


@query("j5_footprints_touch", "select scene_id, aoi_id from crossing union select scene_id, aoi_id from in_shape union select scene_id, aoi_id from in_foot", foot=FOOT_POINTS, names=NAMES, crossing=CROSSING, in_shape=IN_SHAPE, in_foot=IN_FOOT)
def j5_footprints_touch(spark, d):
    """Scenes with leaning footprints and the areas that these touch, by the shapes of both."""
    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    corners = [(x0 + 2, y0), (x1, y0 + 3), (x1 - 2, y1), (x0, y1 - 3), (x0 + 2, y0)]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])
    scenes = view(spark, d, "scenes").select("scene_id", F.array(ring).alias("footprint"))
    return ar.touching_footprints(scenes, shapes(spark)).select("scene_id", "aoi_id")


@query("j3_tiles_touching", f"""select t.tile_id, a.aoi_id from tiles t, names a where exists (select 1 from shape_edges e where e.aoi_id = a.aoi_id and least(e.x1, e.x2) <= t.xmax and greatest(e.x1, e.x2) >= t.xmin and least(e.y1, e.y2) <= t.ymax and greatest(e.y1, e.y2) >= t.ymin
 and abs(list_sum([sign(v) for v in [(e.x2 - e.x1) * (t.ymin - e.y1) - (e.y2 - e.y1) * (t.xmin - e.x1), (e.x2 - e.x1) * (t.ymin - e.y1) - (e.y2 - e.y1) * (t.xmax - e.x1), (e.x2 - e.x1) * (t.ymax - e.y1) - (e.y2 - e.y1) * (t.xmin - e.x1), (e.x2 - e.x1) * (t.ymax - e.y1) - (e.y2 - e.y1) * (t.xmax - e.x1)]])) < 4)
 or {PARITY.format(x='t.xmin', y='t.ymin')}""", names=NAMES)
def j3_tiles_touching(spark, d):
    """Tiles with each area that they touch."""
    return ar.touching(view(spark, d, "tiles"), shapes(spark)).select("tile_id", "aoi_id")


# Each tile is an area with a hole, and every third one has a second part beside it.
STEPS = "select *, xmin + (xmax - xmin) * 1.5e0 as far from tiles"
TILED = """select *, least(xmin + i * 0.75e0, xr) as x0, least(ymin + j * 0.75e0, ymax) as y0, least(xmin + (i + 1) * 0.75e0, xr) as x1, least(ymin + (j + 1) * 0.75e0, ymax) as y1
 from (select *, unnest(range(cast(ceil((xr - xmin) / 0.75) as bigint))) as i from (select *, case when tile_id % 3 = 0 then far + 1 else xmax end as xr from steps)), lateral (select unnest(range(cast(ceil((ymax - ymin) / 0.75) as bigint))) as j)"""


def _common_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"greatest(least(x1, {x1}) - greatest(x0, {x0}), 0) * greatest(least(y1, {y1}) - greatest(y0, {y0}), 0)"


TILE_AREAS = f"select tile_id, i, j, x0, y0, round({_common_sql('xmin', 'ymin', 'xmax', 'ymax')} - {_common_sql('xmin + 0.25', 'ymin + 0.25', 'xmax - 0.25', 'ymax - 0.25')} + case when tile_id % 3 = 0 then {_common_sql('far', 'ymin', 'far + 1', 'ymax')} else 0 end, 6) as area from tiled"


@query("t1_grid_tiles_holed", "select tile_id, cast(i as integer) as i, cast(j as integer) as j, round(x0, 9) as x0, round(y0, 9) as y0, area from tile_areas where area > 0", steps=STEPS, tiled=TILED, tile_areas=TILE_AREAS)
def t1_grid_tiles_holed(spark, d):
    """Boxes of each area, with what they share with it: holes and second parts count."""
    out = ar.grid_tiles(holed_tiles(spark, d).withColumnRenamed("tile_id", "aoi_id"), 0.75)
    named = out.select(F.col("aoi_id").alias("tile_id"), "i", "j", F.col("xmin").alias("x0"), F.col("ymin").alias("y0"), F.round("area", 6).alias("area"))
    return rounded(named, "x0", "y0").where("area > 0")


def holed_tiles(spark, d):
    def box(x0, y0, x1, y1):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])

    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    far = x0 + (x1 - x0) * 1.5
    rings = F.array(box(x0, y0, x1, y1), box(x0 + 0.25, y0 + 0.25, x1 - 0.25, y1 - 0.25))
    second = F.when(F.col("tile_id") % 3 == 0, F.array(box(far, y0, far + 1, y1))).otherwise(F.array().cast(ar.RINGS))
    return view(spark, d, "tiles").select("tile_id", F.concat(rings, second).alias("rings"))


@query("s1_polygons", "select tile_id as feature_id, case when tile_id % 3 = 0 then 3 else 2 end as n_rings, round((xmax - xmin) * (ymax - ymin) - (xmax - xmin - 0.5) * (ymax - ymin - 0.5) + case when tile_id % 3 = 0 then ymax - ymin else 0 end, 6) as area, case when tile_id % 3 = 0 then far + 1 else xmax end as xmax from steps", steps=STEPS)
def s1_polygons(spark, d):
    """GeoJSON polygons with a hole and multipolygons, written and read again."""
    point = lambda p: F.array(p["x"], p["y"])
    nested = F.transform("rings", lambda r: F.transform(r, point))
    text = F.when(F.col("tile_id") % 3 == 0, F.to_json(F.array(F.slice(nested, 1, 2), F.slice(nested, 3, 1)))).otherwise(F.to_json(nested))
    line = F.concat(F.lit('{"crs": {"properties": {"name": "EPSG:4326"}}, "features": [{"properties": {"id": '), F.col("tile_id").cast("string"), F.lit('}, "geometry": {"type": "'), F.when(F.col("tile_id") % 3 == 0, "MultiPolygon").otherwise("Polygon"), F.lit('", "coordinates": '), text, F.lit("}}]}"))
    path = scratch.new_path(spark, "polygons")
    holed_tiles(spark, d).select(line).write.text(path)
    read = readers.polygons(spark, path, lines=True)
    everything = tuple(F.lit(x) for x in (-1e6, -1e6, 1e6, 1e6))
    return read.select("feature_id", F.size("rings").alias("n_rings"), F.round(ar.shared_area(F.col("rings"), everything), 6).alias("area"), ar.box_of(F.col("rings"))["xmax"].alias("xmax"))
