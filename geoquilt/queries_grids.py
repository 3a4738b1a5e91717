"""Queries over layers: rasters that come with their grids, reprojected between systems, merged by their corners."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from .functions import crs
from .operators import grids as gr
from .registry import query
from .sources.views import view

SIDE = 8
LINES_A_TASK = 200_000
# Each part has a grid of 8 x 8 cells of a tenth of a degree in Iberia, and pixels from its order lines.
PX_SQL = "select l_partkey as grid_id, l_suppkey % 8 as row, l_orderkey % 8 as col, cast(max(l_quantity) as double) as v from lineitem where l_orderkey % 5 <> 0 group by all"
DEGREES_SQL = "select p_partkey as grid_id, -9 + (p_partkey * 7) % 50 * 0.2e0 as x0, 44 - (p_partkey * 13) % 60 * 0.1e0 as y0 from part"
E2 = 0.006694380022903416
LAEA_Q = "((1 - {e2}) * ({s} / (1 - {e2} * {s} * {s}) - 1 / (2 * {e}) * ln((1 - {e} * {s}) / (1 + {e} * {s}))))"


def _q(sine: str) -> str:
    return LAEA_Q.format(s=sine, e2=repr(E2), e=repr(math.sqrt(E2)))


CONSTANTS = f"select {_q('1e0')} as qp, asin({_q('sin(radians(52))')} / {_q('1e0')}) as b0, 6378137e0 * sqrt({_q('1e0')} / 2) as rq"
CONSTANTS_D = f"select *, 6378137e0 * cos(radians(52)) / sqrt(1 - {E2!r} * sin(radians(52)) * sin(radians(52))) / (rq * cos(b0)) as dd from constants"
# The middle of each grid, and from it the corner of a grid of 10 km cells in EPSG:3035.
MIDDLE = f"select grid_id, x0, y0, qp, b0, rq, dd, radians(x0 + 0.4 - 10) as d, asin({_q('sin(radians(y0 - 0.4))')} / qp) as beta from degrees, constants_d"
TARGET = "select *, floor((rq * sqrt(2 / (1 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(d))) * dd * cos(beta) * sin(d) + 4321000) / 1000) * 1000 - 40000 as tx, floor((rq * sqrt(2 / (1 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(d))) / dd * (cos(b0) * sin(beta) - sin(b0) * cos(beta) * cos(d)) + 3210000) / 1000) * 1000 + 40000 as ty from middle"
EVERY = "select t.*, r.range as row, c.range as col, (tx + (c.range + 0.5) * 10000 - 4321000) / dd as ex, (ty - (r.range + 0.5) * 10000 - 3210000) * dd as ey from target t, range(8) r, range(8) c"
BACK = "select *, sqrt(ex * ex + ey * ey) as rho, 2 * asin(sqrt(ex * ex + ey * ey) / (2 * rq)) as c from every_cell"
BETA = "select *, asin(cos(c) * sin(b0) + ey * sin(c) * cos(b0) / rho) as bb, 10 + degrees(atan2(ex * sin(c), rho * cos(b0) * cos(c) - ey * sin(b0) * sin(c))) as lon from back"
E4, E6 = E2 * E2, E2**3
LAT = f"select grid_id, row, col, x0, y0, lon, degrees(bb + sin(2 * bb) * {E2 / 3 + 31 * E4 / 180 + 517 * E6 / 5040!r} + sin(4 * bb) * {23 * E4 / 360 + 251 * E6 / 3780!r} + sin(6 * bb) * {761 * E6 / 45360!r}) as lat from beta"
FOUND = "select grid_id, row, col, (lon - x0) / 0.1e0 as u, (y0 - lat) / 0.1e0 as v from lat"
TO_3035 = {"px": PX_SQL, "degrees": DEGREES_SQL, "constants": CONSTANTS, "constants_d": CONSTANTS_D, "middle": MIDDLE, "target": TARGET, "every_cell": EVERY, "back": BACK, "beta": BETA, "lat": LAT, "found": FOUND}
FOUR_SQL = """, four as (select grid_id, row, col, cast(floor(u - 0.5) as bigint) + i.range as sc, cast(floor(v - 0.5) as bigint) + j.range as sr,
 (case when i.range = 1 then u - 0.5 - floor(u - 0.5) else 1 - (u - 0.5 - floor(u - 0.5)) end) * (case when j.range = 1 then v - 0.5 - floor(v - 0.5) else 1 - (v - 0.5 - floor(v - 0.5)) end) as w
 from found, range(2) i, range(2) j where u >= 0 and u < 8 and v >= 0 and v < 8), sampled as (select f.grid_id, f.row, f.col, sum(w * p.v) / sum(w) as v from four f join px p on p.grid_id = f.grid_id and p.row = sr and p.col = sc group by f.grid_id, f.row, f.col)
select c.grid_id, c.row, c.col, round(s.v, 6) as v from found c left join sampled s on s.grid_id = c.grid_id and s.row = c.row and s.col = c.col"""


def line_pixels(spark, d):
    """A pixel of each order line, so that places repeat: of those of one place the largest value counts."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    # Dealt out by their part, of which there are some thirty lines: what is done by grid later on needs no other shuffle.
    # Over a number of tasks, as Spark would go by bytes, and its last few tasks would wait for each other.
    kept = lines.where("l_orderkey % 5 <> 0").select(F.col("l_partkey").alias("grid_id"), (F.col("l_suppkey") % SIDE).alias("row"), (F.col("l_orderkey") % SIDE).alias("col"), F.col("l_quantity").cast("double").alias("v"))
    return kept.repartition(gr.tasks(lines.count(), LINES_A_TASK), "grid_id")


def degree_layer(spark, d, repeated: bool = False) -> gr.Layer:
    """The grids of the parts in degrees, each meant for the target grid of its own name; its pixels once, or as ``repeated`` as the lines."""
    lines, key = line_pixels(spark, d), F.col("p_partkey")
    px = lines if repeated else lines.groupBy("grid_id", "row", "col").agg(F.max("v").alias("v"))
    grids = spark.read.parquet(f"{d}/part.parquet").select(key.alias("grid_id"), F.lit("EPSG:4326").alias("crs"), (key * 7 % 50 * 0.2 - 9).alias("x0"), (F.lit(44) - key * 13 % 60 * 0.1).alias("y0"), F.lit(0.1).alias("dx"), F.lit(-0.1).alias("dy"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), key.alias("target_id"))
    return gr.Layer(px, grids)


def equal_area_grids(layer: gr.Layer):
    x, y = crs.transform(F.col("x0") + 0.4, F.col("y0") - 0.4, "EPSG:4326", "EPSG:3035")
    return layer.grids.select("grid_id", F.lit("EPSG:3035").alias("crs"), (F.floor(x / 1000) * 1000 - 40000.0).alias("x0"), (F.floor(y / 1000) * 1000 + 40000.0).alias("y0"), F.lit(10000.0).alias("dx"), F.lit(-10000.0).alias("dy"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"))


@query("j9_reproject_to_3035", "select f.grid_id, f.row, f.col, p.v from found f left join px p on p.grid_id = f.grid_id and p.row = cast(floor(f.v) as bigint) and p.col = cast(floor(f.u) as bigint)", **TO_3035)
def j9_reproject_to_3035(spark, d):
    """Grids of degrees on grids of an equal-area system, a pair of each part, by the nearest cell."""
    source = degree_layer(spark, d, repeated=True)
    return gr.reproject(source, equal_area_grids(source), ["v"]).pixels


@query("j10_reproject_to_3035", FOUR_SQL, **TO_3035)
def j10_reproject_to_3035(spark, d):
    source = degree_layer(spark, d)
    return gr.reproject(source, equal_area_grids(source), ["v"], "bilinear").pixels.withColumn("v", F.round("v", 6))


# Transverse Mercator of zone 30 by Krueger's series, as published, in the third flattening.
N = (1 / 298.257222101) / (2 - 1 / 298.257222101)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
SCALE = 0.9996 * 6378137.0 / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
# Sources are grids of 2 km in EPSG:25830, targets of 3 km in EPSG:3857 from a corner near by.
UTM_SQL = "select p_partkey as grid_id, 400000 + (p_partkey * 7) % 50 * 3000e0 as x0, 4600000 - (p_partkey * 13) % 60 * 4000e0 as y0 from part"
WEB_SQL = "select *, floor((-334000 + (x0 - 500000) * 1.31e0) / 100) * 100 as tx, floor((4950000 + (y0 - 4490000) * 1.3e0) / 100) * 100 as ty from utm"
WEB_CELLS = "select *, r.range as row, c.range as col, (tx + (c.range + 0.5) * 3000) / 6378137e0 as lam, 2 * atan(exp((ty - (r.range + 0.5) * 3000) / 6378137e0)) - pi() / 2 as phi from web, range(8) r, range(8) c"
TM1 = f"select *, lam - radians(-3) as d, sinh(atanh(sin(phi)) - {math.sqrt(E2)!r} * atanh({math.sqrt(E2)!r} * sin(phi))) as t from web_cells"
TM2 = "select *, atan2(t, cos(d)) as xi, atanh(sin(d) / sqrt(1 + t * t)) as eta from tm1"
NORTH = " + ".join(["xi", *(f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1))])
EAST = " + ".join(["eta", *(f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1))])
TM3 = f"select grid_id, row, col, (500000 + {SCALE!r} * ({EAST}) - x0) / 2000e0 as u, (y0 - {SCALE!r} * ({NORTH})) / 2000e0 as v from tm2"


@query("j9_reproject_to_3857", "select f.grid_id, f.row, f.col, p.v from tm3 f left join px p on p.grid_id = f.grid_id and p.row = cast(floor(f.v) as bigint) and p.col = cast(floor(f.u) as bigint)", px=PX_SQL, utm=UTM_SQL, web=WEB_SQL, web_cells=WEB_CELLS, tm1=TM1, tm2=TM2, tm3=TM3)
def j9_reproject_to_3857(spark, d):
    """Grids of a transverse Mercator zone on grids of web Mercator."""
    px, key = line_pixels(spark, d), F.col("p_partkey")
    grids = spark.read.parquet(f"{d}/part.parquet").select(key.alias("grid_id"), key.alias("target_id"), F.lit("EPSG:25830").alias("crs"), (key * 7 % 50 * 3000.0 + 400000).alias("x0"), (F.lit(4600000) - key * 13 % 60 * 4000.0).alias("y0"), F.lit(2000.0).alias("dx"), F.lit(-2000.0).alias("dy"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"))
    x, y = F.floor(((F.col("x0") - 500000) * 1.31 - 334000) / 100) * 100.0, F.floor(((F.col("y0") - 4490000) * 1.3 + 4950000) / 100) * 100.0
    target = grids.select("grid_id", F.lit("EPSG:3857").alias("crs"), x.alias("x0"), y.alias("y0"), F.lit(3000.0).alias("dx"), F.lit(-3000.0).alias("dy"), "width", "height")
    return gr.reproject(gr.Layer(px, grids), target, ["v"]).pixels


# Tiles of 8 x 8 cells of 250 m with their own corners, a mosaic for each brand.
CORNERS = "select p_partkey as grid_id, p_brand as brand, (p_partkey * 7) % 30 * 500e0 as x0, 40000 - (p_partkey * 13) % 30 * 750e0 as y0 from part"
EDGE = "select brand, min(x0) as mx, max(y0) as my from corners group by brand"


@query(
    "w9_tile_mosaic_by_corner",
    "select c.brand as mosaic, cast(p.row + (my - c.y0) / 250 as bigint) as row, cast(p.col + (c.x0 - mx) / 250 as bigint) as col, arg_min(p.v, c.grid_id) as v from px p join corners c on c.grid_id = p.grid_id join edge e on e.brand = c.brand group by all",
    px=PX_SQL, corners=CORNERS, edge=EDGE,
)
def w9_tile_mosaic_by_corner(spark, d):
    """Tiles merged by their corners, a mosaic for each brand of parts, the first tile that has a value in each cell."""
    key = F.col("p_partkey")
    grids = spark.read.parquet(f"{d}/part.parquet").select(key.alias("grid_id"), F.col("p_brand").alias("brand"), F.lit("EPSG:3857").alias("crs"), (key * 7 % 30 * 500.0).alias("x0"), (F.lit(40000) - key * 13 % 30 * 750.0).alias("y0"), F.lit(250.0).alias("dx"), F.lit(-250.0).alias("dy"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"))
    merged = gr.mosaic(gr.Layer(degree_layer(spark, d).pixels, grids), ["v"], by="brand")
    return merged.pixels.select(F.col("grid_id").alias("mosaic"), "row", "col", "v")


@query("p21_north_up_layer", "select tile_ord as grid_id, case when tile_ord % 2 = 1 then 19 - row else row end as row, col, v, cast(300 as double) as y0, cast(-10 as double) as dy from tile_px")
def p21_north_up_layer(spark, d):
    """Grids with rows from the south, as a layer: pixels and grids are turned together."""
    px = view(spark, d, "tile_px").withColumnRenamed("tile_ord", "grid_id")
    south = F.col("grid_id") % 2 == 1
    grids = spark.range(6).select(F.col("id").alias("grid_id"), F.lit("EPSG:3857").alias("crs"), F.lit(0.0).alias("x0"), F.when(south, 100.0).otherwise(300.0).alias("y0"), F.lit(10.0).alias("dx"), F.when(south, 10.0).otherwise(-10.0).alias("dy"), F.lit(20).alias("width"), F.lit(20).alias("height"))
    turned = gr.north_up(gr.Layer(px, grids))
    return turned.pixels.join(gr.few(turned.grids.select("grid_id", "y0", "dy")), "grid_id").select("grid_id", "row", "col", "v", "y0", "dy")


MERCATOR = "6378137e0 * ln(tan(pi() / 4 + radians({y}) / 2))"


@query("t6_native_layer", f"select grid_id, 'EPSG:3857' as crs, round(6378137e0 * radians(x0), 4) as x0, round({MERCATOR.format(y='y0')}, 4) as y0, round(6378137e0 * radians(0.8) / 8, 4) as dx, round(({MERCATOR.format(y='y0 - 0.8')} - {MERCATOR.format(y='y0')}) / 8, 4) as dy, 8 as width, 8 as height from degrees", degrees=DEGREES_SQL)
def t6_native_layer(spark, d):
    """Grids of degrees as grids of web Mercator with as many cells."""
    out = gr.native(degree_layer(spark, d).grids, "EPSG:3857")
    return out.withColumns({c: F.round(c, 4) for c in ("x0", "y0", "dx", "dy")})


@query("j7_grid_align_layer", "select t.grid_id, r.range as row, c.range as col, p.v from part_grids t cross join range(4) r cross join range(4) c left join px p on p.grid_id = t.grid_id and p.row = r.range * 2 + 1 and p.col = c.range * 2 + 1", px=PX_SQL, part_grids="select p_partkey as grid_id from part")
def j7_grid_align_layer(spark, d):
    """Grids of half as many cells in the same system and place: each takes the fine cell that begins in its middle."""
    source = degree_layer(spark, d, repeated=True)
    coarse = source.grids.select("grid_id", "crs", (F.col("x0") + 0.01).alias("x0"), (F.col("y0") - 0.01).alias("y0"), (F.col("dx") * 2).alias("dx"), (F.col("dy") * 2).alias("dy"), F.lit(4).alias("width"), F.lit(4).alias("height"))
    return gr.reproject(source, coarse, ["v"]).pixels
