"""Areas with holes, grids as data and ranks by key against slow versions and awkward rows."""

import random
import re

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from geoquilt import queries_grids
from geoquilt.functions import crs, geometry
from geoquilt.operators import areas as ar
from geoquilt.operators import grids as gr
from geoquilt.operators import observations as ob
from geoquilt.operators import ranks
from geoquilt.plans import plugins
from geoquilt.queries import QUERIES
from geoquilt.sources import readers
from geoquilt.sources.views import SHAPES, shapes, view

AREA = "aoi_id string, rings array<array<struct<x:double,y:double>>>"


def odd(x, y, rings):
    """Whether a point is inside an odd number of rings."""
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            n += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return n % 2 == 1


def stars(n=12):
    """Areas of very different sizes: star-shaped rings with a hole of the same shape, some with a second part."""
    rnd, out = random.Random(3), []
    for k in range(n):
        size = 10.0 ** (k % 5 - 2)
        cx, cy = rnd.uniform(-5, 5), rnd.uniform(-5, 5)
        angles = sorted(rnd.uniform(0, 6.28) for _ in range(7))
        far = [rnd.uniform(0.4, 1) * size for _ in angles]
        ring = [(cx + r * np.cos(a), cy + r * np.sin(a)) for a, r in zip(angles, far, strict=True)]
        hole = [(cx + (x - cx) * 0.5, cy + (y - cy) * 0.5) for x, y in ring]
        rings = [ring + ring[:1], hole[::-1] + hole[-1:]]
        if k % 3 == 0:
            rings.append([(x + 3 * size, y) for x, y in rings[0]])
        out.append((f"a{k}", [[(float(x), float(y)) for x, y in r] for r in rings]))
    return out


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_points_are_tagged_once_for_each_area(spark, scale):
    made = [(name, [[(x * scale, y * scale) for x, y in r] for r in rings]) for name, rings in stars()]
    rnd = random.Random(1)
    points = [(i, rnd.gauss(0, 4) * scale, rnd.gauss(0, 4) * scale) for i in range(800)] + [(900, None, 1.0), (901, None, None)]
    table = spark.createDataFrame(points + points[:5], "id long, lon double, lat double").withColumns({"level": F.lit("mine"), "cell_y": F.lit(1)})
    got = sorted((r.id, r.aoi_id) for r in ar.tagged(table.drop("level", "cell_y"), spark.createDataFrame(made, AREA), edge=False).collect())
    assert got == sorted((i, name) for i, x, y in points + points[:5] for name, rings in made if x is not None and odd(x, y, rings))
    assert ar.tagged(table.drop("level", "cell_y"), spark.createDataFrame(made, AREA).where("false")).count() == 0


def test_an_area_takes_few_cells_in_any_unit(spark):
    for scale in (1e-4, 1.0, 1e6):
        boxed = ar.with_box(spark.createDataFrame([(n, [[(x * scale, y * scale) for x, y in r] for r in rings]) for n, rings in stars()], AREA))
        boxed = boxed.withColumn("own", ar.level_of(*[F.col(f"a_{c}") for c in ar.BOX]))
        most = ar._covered(boxed, tuple(f"a_{c}" for c in ar.BOX), F.array("own")).groupBy("aoi_id").count().agg(F.max("count")).first()[0]
        assert most <= 25


def test_few_areas_leave_points_where_they_are_and_their_box_reaches_the_scan(spark):
    plan = QUERIES["j1_points_tagged"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan
    cells = view(spark, SF, "tiles").select("tile_id", "xmin", "ymin")
    cells.write.mode("overwrite").parquet(path := f"{readers_folder(spark)}/cells")
    tagged = ar.tagged(spark.read.parquet(path), shapes(spark), "xmin", "ymin")
    assert "GreaterThanOrEqual(xmin" in tagged._jdf.queryExecution().executedPlan().toString()


def readers_folder(spark):
    from geoquilt.sources import scratch

    return scratch.new_path(spark, "test")


def test_boxes_of_any_size_meet_areas_once(spark):
    made, rnd = stars(), random.Random(2)
    boxes = []
    for i in range(300):
        x, y, w, h = rnd.gauss(0, 4), rnd.gauss(0, 4), 10 ** rnd.uniform(-3, 2), 10 ** rnd.uniform(-3, 2)
        boxes.append((i, x, y, x + w, y + h))
    table = spark.createDataFrame(boxes, "id long, xmin double, ymin double, xmax double, ymax double")
    around = {n: (min(x for r in rings for x, _ in r), min(y for r in rings for _, y in r), max(x for r in rings for x, _ in r), max(y for r in rings for _, y in r)) for n, rings in made}
    got = sorted((r.id, r.aoi_id) for r in ar.tagged_boxes(table, spark.createDataFrame(made, AREA)).collect())
    assert got == sorted((i, n) for i, *b in boxes for n, a in around.items() if b[0] <= a[2] and b[2] >= a[0] and b[1] <= a[3] and b[3] >= a[1])


def test_shared_area_is_that_of_counted_points(spark):
    made = stars(6)
    boxes = [(k, -3.0 + k, -2.0, 2.0 + k, 3.0) for k in range(4)]
    pairs = spark.createDataFrame(made, AREA).crossJoin(spark.createDataFrame(boxes, "id long, xmin double, ymin double, xmax double, ymax double"))
    for r in pairs.withColumn("area", ar.shared_area(F.col("rings"), tuple(map(F.col, ar.BOX)))).collect():
        u, v = np.meshgrid((np.arange(250) + 0.5) / 250, (np.arange(250) + 0.5) / 250)
        n = sum(odd(r.xmin + 5 * x, r.ymin + 5 * y, [[(p.x, p.y) for p in ring] for ring in r.rings]) for x, y in zip(u.ravel()[::25], v.ravel()[::25], strict=True))
        assert abs(r.area - 25 * n / 2500) < 0.6


def test_turning_rings_round_changes_no_area(spark):
    turned = [(n, [r[::-1] if k % 2 else r for k, r in enumerate(rings)]) for n, rings in SHAPES.items()]
    as_floats = [(n, [[(float(x), float(y)) for x, y in r] for r in rings]) for n, rings in turned]
    box = tuple(map(F.lit, (0.0, 0.0, 20.0, 20.0)))
    areas = [{r.aoi_id: r.area for r in df.withColumn("area", ar.shared_area(F.col("rings"), box)).collect()} for df in (shapes(spark), spark.createDataFrame(as_floats, AREA))]
    assert areas[0] == areas[1] == {"H": 196.0 - 49 + 4, "M": 21.0 + 54 - 10, "N": 5.0}


def test_an_area_without_a_raster_is_an_error_where_one_is_required(spark):
    rasters = spark.createDataFrame([("p", 100.0, 100.0, 101.0, 101.0)], "path string, xmin double, ymin double, xmax double, ymax double")
    assert ar.best_overlap(rasters, shapes(spark)).count() == 0
    with pytest.raises(ValueError, match="no raster overlaps area"):
        ar.best_overlap(rasters, shapes(spark), required=True)


def test_polygons_of_other_kinds_and_files_without_a_system(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"crs": {"properties": {"name": "EPSG:4326"}}, "features": [{"properties": {"id": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": {"id": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 2], [0, 0]]], [[[5, 5], [6, 5], [6, 6.5], [5, 5]]]]}}]}')
    found = {r.feature_id: r.rings for r in readers.polygons(spark, str(tmp_path / "a.json")).collect()}
    assert found[1] is None and [len(r) for r in found[2]] == [4, 4] and found[2][1][2].y == 6.5
    (tmp_path / "b.json").write_text('{"features": [{"properties": {"id": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}')
    assert readers.polygons(spark, str(tmp_path / "b.json"), crs="EPSG:3857").first().crs == "EPSG:3857"
    with pytest.raises(Exception, match="names no coordinate system"):
        readers.polygons(spark, str(tmp_path / "b.json")).collect()


# Grids

GRIDS = "grid_id long, crs string, x0 double, y0 double, dx double, dy double, width int, height int, target_id long, ord int"


def test_reprojection_equals_cell_by_cell(spark):
    rnd = np.random.default_rng(1)
    made = [(1, "EPSG:4326", -4.0, 43.0, 0.05, -0.05, 20, 16, 9, 2), (2, "EPSG:25830", 420000.0, 4750000.0, 4000.0, -4000.0, 15, 15, 9, 1)]
    values = {(g[0], r, c): None if rnd.random() < 0.2 else float(rnd.integers(1, 99)) for g in made for r in range(g[7]) for c in range(g[6])}
    pixels = spark.createDataFrame([(*k, v) for k, v in values.items()], "grid_id long, row long, col long, v double")
    target = spark.createDataFrame([(9, "EPSG:3857", -445000.0, 5310000.0, 5000.0, -5000.0, 18, 14)], "grid_id long, crs string, x0 double, y0 double, dx double, dy double, width int, height int")
    layer = gr.Layer(pixels, spark.createDataFrame(made, GRIDS))
    centres = gr.cells(target).join(target, "grid_id").withColumns(dict(zip(("px", "py"), gr.centre(F.col("row"), F.col("col")), strict=True)))
    where = {}
    for g in made:
        for r in crs.with_transformed(centres, "px", "py", "EPSG:3857", g[1], "x", "y").collect():
            where[r.row, r.col, g[0]] = ((r.x - g[2]) / g[4], (r.y - g[3]) / g[5])

    def sample(row, col, how):
        for g in sorted(made, key=lambda g: g[9]):
            u, v = where[row, col, g[0]]
            if not (0 <= u < g[6] and 0 <= v < g[7]):
                continue
            if how == "nearest":
                found = values.get((g[0], int(np.floor(v)), int(np.floor(u))))
            else:
                u, v, total, weight = u - 0.5, v - 0.5, 0.0, 0.0
                for i in (0, 1):
                    for j in (0, 1):
                        x = values.get((g[0], int(np.floor(v)) + j, int(np.floor(u)) + i))
                        w = (u - np.floor(u) if i else 1 - u + np.floor(u)) * (v - np.floor(v) if j else 1 - v + np.floor(v))
                        if x is not None:
                            total, weight = total + w * x, weight + w
                found = total / weight if weight else None
            if found is not None:
                return found
        return None

    for how in ("nearest", "bilinear"):
        got = gr.reproject(layer, target, ["v"], how).pixels.collect()
        assert len(got) == 18 * 14 and any(r.v is not None for r in got)
        for r in got:
            wanted = sample(r.row, r.col, how)
            assert (r.v is None) == (wanted is None) and (wanted is None or abs(r.v - wanted) < 1e-6)
    nothing = gr.reproject(gr.Layer(pixels.where("false"), layer.grids), target, ["v"]).pixels
    assert nothing.count() == 18 * 14 and nothing.where("v is not null").count() == 0


def many_grids(spark, n):
    """A layer of n grids of 8 x 8 cells out of one partition, each with a target grid of its own."""
    key = F.col("id")
    grids = spark.range(n).coalesce(1).select(key.alias("grid_id"), F.lit("EPSG:3857").alias("crs"), (key * 100.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(10.0).alias("dx"), F.lit(-10.0).alias("dy"), F.lit(8).alias("width"), F.lit(8).alias("height"), key.alias("target_id"))
    pixels = grids.select("grid_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("row")).select("grid_id", "row", F.col("row").alias("col"), F.col("row").cast("double").alias("v"))
    return gr.Layer(pixels, grids)


@pytest.mark.parametrize("how", ["nearest", "bilinear"])
def test_cells_are_never_broadcast_however_small_their_grids_look(spark, how):
    layer = many_grids(spark, 300)
    out = gr.reproject(layer, layer.grids.drop("target_id"), ["v"], how).pixels
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "SortMergeJoin" in plan  # the grids, which were counted
    assert out.count() == 300 * 64 and out.where("v = row and row = col").count() == 300 * 8
    # More than few grids are not left to the size of their file.
    assert "merge" in gr.few(layer.grids, 299)._jdf.queryExecution().logical().toString()


@pytest.mark.parametrize("how", ["nearest", "bilinear"])
def test_no_cell_is_shuffled_where_sources_are_less_than_a_block(spark, how):
    layer = many_grids(spark, 300)
    out = gr.reproject(layer, layer.grids.drop("target_id"), ["v"], how).pixels
    above, shuffle, _ = out._jdf.queryExecution().executedPlan().toString().partition("Exchange")
    assert shuffle and above.count("Generate explode") == 2 and "Join" not in above  # rows and columns come after the last shuffle


@pytest.mark.parametrize("how", ["nearest", "bilinear"])
def test_sources_that_are_one_block_give_what_those_met_by_cells_give(spark, how, monkeypatch):
    rnd, side = np.random.default_rng(2), gr.BLOCK
    sizes = [(side - 1, side - 1), (side, 3), (3, side), (side + 4, side + 4), (1, 1), (5, 0)]
    made = [(k, "EPSG:4326", -4.0 + k / 10, 43.0, 0.05, -0.05, w, h, 10 + k // 2, 9 - k) for k, (w, h) in enumerate(sizes)]
    points = [(k, r, c, float(rnd.integers(1, 99)) if rnd.random() < 0.8 else None) for k, (w, h) in enumerate(sizes) for r in range(-1, h + 1) for c in range(-1, w + 1)]
    pixels = spark.createDataFrame([*points, *points[::7], (0, None, 1, 5.0), (None, 1, 1, 5.0)], "grid_id long, row long, col long, v double")
    target = spark.createDataFrame([(10 + k, "EPSG:3857", -445000.0 + 20000 * k, 5310000.0, 5000.0, -5000.0, 25, 25) for k in range(4)], "grid_id long, crs string, x0 double, y0 double, dx double, dy double, width int, height int")
    if how == "bilinear":
        pixels = pixels.where("row is not null")

    def found(several):
        grids = spark.createDataFrame(made, GRIDS)
        return {(r.grid_id, r.row, r.col): r.v for r in gr.reproject(gr.Layer(pixels, grids if several else grids.where("grid_id % 2 = 0")), target, ["v"], how).pixels.collect()}

    whole = [found(True), found(False)]
    monkeypatch.setattr(gr, "BLOCK", 1)
    for a, b in zip(whole, [found(True), found(False)], strict=True):
        assert a.keys() == b.keys() and len(a) == 4 * 625 and sum(v is not None for v in a.values()) > 100
        assert all((a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) < 1e-9) for k in a)


def test_cells_of_many_grids_in_one_file_are_made_by_many_tasks(spark):
    cells = gr.cells(many_grids(spark, 10_000).grids)
    tasks = cells.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 3 and sum(r["count"] for r in tasks) == 640_000 and max(r["count"] for r in tasks) < 320_000
    wide = spark.createDataFrame([(1, 70_000, 3), (2, 5, 30_000), (3, 0, 9)], "grid_id long, width int, height int")
    assert {(r.grid_id, r[1], r[2], r[3]) for r in gr.cells(wide).groupBy("grid_id").agg(F.count_distinct("row", "col"), F.max("row"), F.max("col")).collect()} == {(1, 210_000, 2, 69_999), (2, 150_000, 29_999, 4)}


def test_lines_of_one_file_are_gathered_by_many_tasks_and_merged_once(spark, monkeypatch):
    monkeypatch.setattr(queries_grids, "LINES_A_TASK", 500, raising=False)
    assert len(queries_grids.degree_layer(spark, SF).pixels.select(F.spark_partition_id()).distinct().collect()) >= 8
    for name in ("j9_reproject_to_3857", "j9_reproject_to_3035", "j7_grid_align_layer"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Aggregate \[", plan)) == 2  # repeated pixels, and blocks


def test_all_pairs_of_grids_are_looked_at_once(spark):
    layer = many_grids(spark, 100)
    spark.sparkContext.setJobGroup("pairs", "the jobs that a reprojection runs before its own")
    gr.reproject(layer, layer.grids.drop("target_id"), ["v"])
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("pairs"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs <= 5, jobs


def test_series_of_multiples_give_the_points_of_the_plain_ones(spark):
    points = spark.range(2_000).select((F.col("id") % 50 * 0.4 - 13).alias("x"), (F.expr("id div 50") * 2.0 - 40).alias("y"))
    for zone in ("EPSG:25829", "EPSG:25830", "EPSG:25831"):
        out = crs.with_transformed(points, "x", "y", "EPSG:4326", zone, "east", "north").withColumns(dict(zip(("e", "n"), crs.transform(F.col("x"), F.col("y"), "EPSG:4326", zone), strict=True)))
        back = crs.with_transformed(out, "east", "north", zone, "EPSG:4326", "lon", "lat").withColumns(dict(zip(("x2", "y2"), crs.transform(F.col("east"), F.col("north"), zone, "EPSG:4326"), strict=True)))
        far = back.agg(*[F.max(F.abs(F.col(a) - F.col(b))) for a, b in (("east", "e"), ("north", "n"), ("lon", "x2"), ("lat", "y2"))]).first()
        assert far[0] < 1e-7 and far[1] < 1e-7 and far[2] < 1e-12 and far[3] < 1e-12
        plan = out.select("east", "north")._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"COSH\(", plan)) == 1 and len(re.findall(r"COS\(\(tm", plan)) == 1


def test_bilinear_meets_each_target_cell_once_and_across_blocks(spark):
    n = 2 * gr.BLOCK + 5
    grids = spark.createDataFrame([(1, "EPSG:3857", 0.0, 0.0, 1.0, -1.0, n, n, 1, 0)], GRIDS)
    pixels = spark.range(n * n).select(F.lit(1).cast("long").alias("grid_id"), F.expr(f"id div {n}").alias("row"), (F.col("id") % n).alias("col")).withColumn("v", F.col("row") * 100.0 + F.col("col"))
    target = grids.drop("target_id", "ord").withColumns({"x0": F.lit(0.25), "y0": F.lit(-0.25)})
    out = gr.reproject(gr.Layer(pixels.unionByName(pixels.where("row = 3")), grids), target, ["v"], "bilinear").pixels
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "explode(array(struct(i" not in plan  # cells with blocks: no row for each of four cells
    got = {(r.row, r.col): r.v for r in out.collect()}
    assert len(got) == n * n
    for (row, col), v in got.items():
        if row not in (2, 3) and max(row, col) < n - 1:  # repeated pixels weigh more
            assert abs(v - (row * 100 + 25 + col + 0.25)) < 1e-9
    assert abs(got[2, 0] - (0.75 * 200 + 2 * 0.25 * 300) / (0.75 + 2 * 0.25) - 0.25) < 1e-9


def test_areas_of_one_file_are_cut_into_boxes_by_many_tasks(spark, monkeypatch):
    from geoquilt.operators import rasters as ra

    for module in (ar, ra):
        monkeypatch.setattr(module, "AREAS_A_TASK", 10, raising=False)
    corners = [F.struct((F.col("id") + x).cast("double").alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0.0), (2, 0.0), (2, 1.0), (0, 1.0), (0, 0.0))]
    areas = spark.range(80).coalesce(1).select(F.col("id").alias("aoi_id"), F.array(*corners).alias("ring"))
    for out, area in ((ra.area_tiles(areas, 0.5), F.aggregate("parts", F.lit(0.0), lambda s, r: s + geometry.ring_area(r))), (ar.grid_tiles(areas, 0.5), F.col("area"))):
        found = out.select("aoi_id", area.alias("area"), F.spark_partition_id().alias("task")).collect()
        assert len({r.task for r in found}) >= 4 and len(found) == 80 * 8 and {r.area for r in found} == {0.25}


def test_mosaic_of_tiles_with_rows_from_south_or_north_and_of_unlike_tiles(spark):
    grids = spark.createDataFrame([(1, "EPSG:3857", 0.0, 0.0, 10.0, 10.0, 2, 2, 0, 1), (2, "EPSG:3857", 10.0, 10.0, 10.0, 10.0, 2, 2, 0, 2)], GRIDS)
    pixels = spark.createDataFrame([(g, r, c, None if (g, r, c) == (1, 1, 1) else float(g * 10 + r * 2 + c)) for g in (1, 2) for r in (0, 1) for c in (0, 1)], "grid_id long, row long, col long, v double")
    south = gr.mosaic(gr.Layer(pixels, grids), ["v"], order="ord")
    assert {(r.row, r.col): r.v for r in south.pixels.collect()} == {(0, 0): 10.0, (0, 1): 11.0, (1, 0): 12.0, (1, 1): 20.0, (1, 2): 21.0, (2, 1): 22.0, (2, 2): 23.0}
    north = gr.mosaic(gr.north_up(gr.Layer(pixels, grids)), ["v"], order="ord")
    assert {(2 - r.row, r.col): r.v for r in north.pixels.collect()} == {(r.row, r.col): r.v for r in south.pixels.collect()}
    g = north.grids.first()
    assert (g.x0, g.y0, g.dx, g.dy, g.width, g.height) == (0.0, 30.0, 10.0, -10.0, 3, 3)
    with pytest.raises(Exception, match="tiles of one mosaic differ in dx"):
        gr.mosaic(gr.Layer(pixels, grids.withColumn("dx", F.col("dx") * F.col("grid_id"))), ["v"]).pixels.collect()


def test_plug_ins_may_return_layers(spark):
    grids = spark.createDataFrame([(1, "EPSG:3857", 0.0, 0.0, 10.0, -10.0, 2, 2, 0, 1)], GRIDS)
    layer = gr.Layer(spark.createDataFrame([(1, 0, 0, 2.0)], "grid_id long, row long, col long, v double"), grids)
    known = plugins.Variables()
    known.add("height", plugins.Variable(lambda options: lambda areas, year, season, resolution: layer, lambda options: lambda df: df.withColumn("v", F.col("v") * 2)))
    found, resolution = known.layer("HEIGHT", None, 2020, "static")
    assert found.pixels.first().v == 4.0 and found.grids is grids and resolution is None


# Ranks by key


def test_quantiles_and_medians_by_key(spark):
    rnd = np.random.default_rng(5)
    rows = [(str(rnd.choice(["a", "b", "c"], p=[0.9, 0.09, 0.01])), None if rnd.random() < 0.1 else float(rnd.integers(0, 40))) for _ in range(900)] + [("empty", None), (None, 3.0), (None, 4.0), ("one", 7.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    of = {}
    for k, v in rows:
        if v is not None:
            of.setdefault(k, []).append(v)
    got = {r.k: (r.low, r.mid) for r in ranks.quantiles(df, "v", {"low": 0.05, "mid": 0.5}, ("k",)).collect()}
    assert got == {k: tuple(np.quantile(v, [0.05, 0.5])) for k, v in of.items()}
    upper = {r.k: r.v for r in ranks.upper_medians(df, ["v"], ("k",)).collect()}
    assert upper == {k: sorted(v)[len(v) // 2] for k, v in of.items()}


def test_cover_of_keys_without_a_range(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 3.0), (None, 1.0), (None, 5.0)], "k string, ndvi double")
    got = {(r.k, r.ndvi): r.fvc for r in ob.fractional_cover(df, by=("k",)).collect()}
    assert got == {("a", 1.0): 0.0, ("a", 2.0): 1.0, ("a", None): None, ("b", 3.0): None, (None, 1.0): 0.0, (None, 5.0): 1.0}
    with pytest.raises(Exception, match="the percentiles are one value"):
        ob.fractional_cover(df, by=("k",), strict=True).collect()


# Layout


def scanned(df):
    """Rows and files that a query's scan gives, after it ran."""
    execution = df._jdf.queryExecution()
    leaf = execution.executedPlan().collectLeaves().head()
    execution.toRdd().count()
    return {k: leaf.metrics().get(k).get().value() for k in ("numOutputRows", "numFiles")}


def test_a_box_of_a_month_reads_few_files_and_rows(spark, tmp_path):
    obs = spark.range(200_000).select(F.col("id").alias("obs_id"), (F.col("id") % 400).alias("col"), (F.expr("id div 400") % 500).alias("row"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 360).cast("int")).alias("obs_date"))
    from geoquilt.sources import sinks

    sinks.write_observations(obs, str(tmp_path / "obs"), 96)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = scanned(spark.read.parquet(str(tmp_path / "obs")))
        month = scanned(readers.observations(spark, str(tmp_path / "obs"), "2020-03-01", "2020-03-31"))
        box = readers.observations(spark, str(tmp_path / "obs"), "2020-03-01", "2020-03-31", (100, 100, 150, 150))
        some = scanned(box)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert whole["numOutputRows"] == 200_000 and month["numFiles"] < whole["numFiles"] / 8
    assert some["numOutputRows"] < month["numOutputRows"] / 2  # files outside the box are skipped by their statistics
    assert box.count() == obs.where("col between 100 and 149 and row between 100 and 149 and obs_date between '2020-03-01' and '2020-03-31'").count()


def test_neighbours_are_near_in_the_space_filling_key(spark):
    from geoquilt.functions import geometry

    cells = [(x, y) for x in range(-8, 8) for y in range(-8, 8)]
    keys = spark.createDataFrame(cells, "x long, y long").select("x", "y", geometry.z_order(F.col("x"), F.col("y")).alias("z")).collect()
    interleave = lambda x, y: sum(((x + 2**30) >> b & 1) << 2 * b | ((y + 2**30) >> b & 1) << 2 * b + 1 for b in range(31))
    assert all(r.z == interleave(r.x, r.y) for r in keys)
