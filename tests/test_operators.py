"""Edge cases and properties that the queries over the driver's tables do not show."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoquilt.functions import crs, geometry, spectral, text
from geoquilt.operators import observations as ob
from geoquilt.operators import occurrences as oc
from geoquilt.operators import rasters as ra
from geoquilt.operators import scenes as sc
from geoquilt.sources import readers
from geoquilt.sources.views import aoi


def test_projections_meet_published_points(spark):
    """The national mapping agencies' check point of EPSG:3035; the central meridian and equator of the others."""
    points = spark.createDataFrame([(5.0, 50.0)], "lon double, lat double")
    x, y = crs.transform(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:3035")
    assert points.select(x, y).first() == pytest.approx((3962799.451, 2999718.853), abs=1e-3)
    origin = spark.createDataFrame([(3.0, 0.0), (10.0, 52.0)], "lon double, lat double")
    x, y = crs.transform(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:25831")
    assert origin.select(x, y).first() == pytest.approx((500000.0, 0.0), abs=1e-6)
    x, y = crs.transform(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:3035")
    assert origin.select(x, y).collect()[1] == pytest.approx((4321000.0, 3210000.0), abs=1e-6)
    with pytest.raises(ValueError):
        crs.transform(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:27700")


def test_transverse_mercator_keeps_shapes(spark):
    """Small steps north and east have one scale and a right angle, and the scale on the meridian is 0.9996."""
    lon, lat, h = 3.0, 45.0, 1e-4
    points = spark.createDataFrame([(lon, lat), (lon, lat + h), (lon + h, lat)], "lon double, lat double")
    (x0, y0), (x1, y1), (x2, y2) = points.select(*crs.transform(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:25831")).collect()
    s = math.sin(math.radians(lat))
    meridian = crs.A * (1 - crs.E2) / (1 - crs.E2 * s * s) ** 1.5 * math.radians(h)
    parallel = crs.A / math.sqrt(1 - crs.E2 * s * s) * math.cos(math.radians(lat)) * math.radians(h)
    assert math.hypot(x1 - x0, y1 - y0) / meridian == pytest.approx(0.9996, abs=1e-6)
    assert math.hypot(x2 - x0, y2 - y0) / parallel == pytest.approx(0.9996, abs=1e-6)


def test_true_color_like_numpy(spark):
    v = np.linspace(-0.1, 3.2, 40)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(v, v[::-1], np.roll(v, 7), strict=True)], "r double, g double, b double")
    got = np.array(df.select(*spectral.true_color("r", "g", "b").values()).collect())

    def tone(a):
        x, t = np.clip(a / 3.0, 0, 1), 0.13 / 3.0
        c = x * (x * t - 1) / (x * (2 * t - 1) - t)
        return ((c + 0.01) ** 2.3 - 0.01**2.3) / (1.01**2.3 - 0.01**2.3)

    tones = [tone(a - h) for a, h in zip((v, v[::-1], np.roll(v, 7)), (0.013, 0.024, 0.041), strict=True)]
    grey = sum(tones) / 3 * (1 - 1.3)
    linear = [np.clip(grey + t * 1.3, 0, 1) for t in tones]
    wanted = np.stack([np.where(x <= 0.0031308, 12.92 * x, 1.055 * x**0.41666666666 - 0.055) for x in linear], axis=1)
    assert np.allclose(got, wanted, atol=1e-12)


def test_rings_with_repeated_vertices_and_edges(spark):
    points = spark.createDataFrame([(6.0, 8.0), (8.0, 8.0), (10.0, 10.0), (10.1, 8.0)], "lon double, lat double")
    assert {tuple(r) for r in oc.in_areas(points, aoi(spark, "D")).collect()} == {(6.0, 8.0), (8.0, 8.0), (10.0, 10.0)}
    assert oc.in_areas(points, aoi(spark, "C")).count() == 0
    assert oc.in_areas(points, aoi(spark, "A")).count() == 4  # the polygon is there twice, the points once
    ring = aoi(spark, "B").select(geometry.ring_area(F.col("ring"))).first()[0]
    assert ring == pytest.approx(14 * 12 - 0.5 * 14 * 8)


def test_all_touched_is_asked_for(spark):
    pixels = spark.createDataFrame([(4, 3), (4, 4), (3, 3), (0, 0)], "row long, col long")
    assert {tuple(r) for r in ra.clip(pixels, aoi(spark, "A")).collect()} == {(4, 4)}
    assert {tuple(r) for r in ra.clip(pixels, aoi(spark, "A"), touched=True).collect()} == {(4, 3), (4, 4), (3, 3)}


TRIANGLE = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (0.0, 0.0)]


def areas_of(spark, *rings):
    return spark.createDataFrame([("t", i, ring) for i, ring in enumerate(rings)], "aoi_id string, feature_id int, ring array<struct<x:double,y:double>>")


def test_a_thin_area_touches_whole_pixels(spark):
    strip = [(0.2, 0.7), (3.8, 0.7), (3.8, 0.75), (0.2, 0.75), (0.2, 0.7)]
    pixels = spark.createDataFrame([(r, c) for r in range(3) for c in range(-1, 6)] + [(0, 2), (None, 1)], "row long, col long")
    touched = ra.clip(pixels, areas_of(spark, strip, strip), touched=True)
    assert sorted(tuple(r) for r in touched.collect()) == [(0, 0), (0, 1), (0, 2), (0, 2), (0, 3)]
    assert ra.clip(pixels, areas_of(spark, strip)).count() == 0


def test_the_best_raster_is_that_of_the_polygon_not_of_its_box(spark):
    rasters = spark.createDataFrame([("corner", 5.0, 5.0, 10.0, 10.0), ("inside", 1.0, 1.0, 5.0, 5.0), ("cut", 0.0, 4.0, 4.0, 9.0)], "path string, xmin double, ymin double, xmax double, ymax double")
    assert [tuple(r) for r in ra.best_overlap(rasters, areas_of(spark, TRIANGLE, TRIANGLE)).collect()] == [("t", "inside", 16.0)]
    assert ra.best_overlap(rasters.where("path = 'corner'"), areas_of(spark, TRIANGLE)).count() == 0
    two = areas_of(spark, TRIANGLE, [(20.0, 20.0), (21.0, 20.0), (21.0, 21.0), (20.0, 21.0), (20.0, 20.0)])
    wide = spark.createDataFrame([("all", -5.0, -5.0, 30.0, 30.0)], "path string, xmin double, ymin double, xmax double, ymax double")
    assert ra.best_overlap(wide, two).first()["area"] == pytest.approx(51.0)


def test_tiles_of_an_area_that_is_no_box(spark):
    triangle = [(x * 0.4, y * 0.4) for x, y in TRIANGLE]
    tiles = ra.area_tiles(areas_of(spark, triangle, triangle), 1.0).collect()
    assert {(r.i, r.j) for r in tiles} == {(i, j) for i in range(4) for j in range(4) if i + j <= 4}
    areas = ra.area_tiles(areas_of(spark, triangle), 1.0).select("i", "j", F.aggregate("parts", F.lit(0.0), lambda s, r: s + geometry.ring_area(r)).alias("a")).collect()
    assert {(r.i, r.j): round(r.a, 9) for r in areas} == {(i, j): 1.0 if i + j < 3 else 0.5 if i + j == 3 else 0.0 for i in range(4) for j in range(4) if i + j <= 4}


def test_footprints_beside_a_slope_are_not_in_the_area(spark):
    scenes = spark.createDataFrame([(1, 6.0, 6.0, 9.0, 9.0), (2, 5.0, 5.0, 9.0, 9.0), (3, 1.0, 1.0, 2.0, 2.0), (4, -5.0, -5.0, 20.0, 20.0), (5, None, 1.0, 2.0, 2.0)], "scene_id int, xmin double, ymin double, xmax double, ymax double")
    assert sorted(r[0] for r in sc.scenes_in_area(scenes, areas_of(spark, TRIANGLE)).select("scene_id").collect()) == [2, 3, 4]


def test_points_stay_where_they_are_for_few_areas(spark):
    points = spark.range(1000).select((F.col("id") % 17).cast("double").alias("lon"), (F.col("id") % 13).cast("double").alias("lat"))
    plan = oc.in_areas(points, aoi(spark, "B"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" not in plan


def test_reprojecting_onto_the_same_grid_changes_nothing(spark):
    source = spark.createDataFrame([(r, c, float(r * 3 + c)) for r in range(3) for c in range(3)], "row long, col long, v double")
    grid = ra.target_grid(spark, 3, 3)
    for f in (ra.reproject_nearest, ra.reproject_bilinear):
        assert sorted(map(tuple, f(source, grid, 1.0).collect())) == sorted(map(tuple, source.collect()))


def test_cover_of_one_value_or_none(spark):
    one = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5), (0, 2, None)], "row long, col long, ndvi double")
    assert [r.fvc for r in ob.fractional_cover(one).collect()] == [None] * 3
    assert ob.fractional_cover(one.limit(0)).count() == 0


def test_unknown_values_are_errors():
    with pytest.raises(ValueError):
        spectral.required_bands(["evi"])


def test_unknown_license_list(spark):
    with pytest.raises(ValueError):
        text.license_allowed(F.lit("x"), ["all rights reserved"])
    df = spark.createDataFrame([("CC0",), (None,), ("",)], "license string")
    assert df.where(text.license_allowed(F.col("license"), [])).count() == 3
    assert df.where(text.license_allowed(F.col("license"), ["CC0"])).count() == 1


def brute_stop(found, n, least, most):
    """The search through candidates as a loop."""
    covered, dates = set(), 0
    for rank in sorted({r for r, _ in found}):
        own = {p for r, p in found if r == rank}
        covered, dates = covered | own, dates + 1
        if len(own) >= n * least:
            return rank, "single", len(own) / n
        if len(covered) >= n * least or dates >= most:
            return rank, "mosaic", len(covered) / n
    return None


@pytest.mark.parametrize("seed", range(4))
def test_mosaic_stop_is_the_sequential_search(spark, seed):
    random = np.random.default_rng(seed)
    found = [(int(r), int(p)) for r in range(8) for p in random.choice(20, random.integers(1, 14), replace=False)]
    df = spark.createDataFrame([(r, 0, p, 1.0) for r, p in found], "rank int, row long, col long, b04 double")
    pixels = spark.createDataFrame([(0, p) for p in range(20)], "row long, col long")
    wanted = brute_stop(found, 20, 0.8, 5)
    got = ob.mosaic_stop(df, pixels, ["b04"], 0.8, 5).first()
    assert (got.stop_rank, got.kind) == wanted[:2] and got.ratio == pytest.approx(wanted[2])


def test_quadtree_leaves_hold_every_point_once(spark):
    random = np.random.default_rng(3)
    points = spark.createDataFrame([(float(x), float(y)) for x, y in random.random((500, 2)) ** 3], "x double, y double")
    leaves = oc.quadtree(points, (0.0, 0.0, 1.0, 1.0), 20).collect()
    assert sum(r.n for r in leaves) == 500 and all(r.n <= 20 or r.depth == 6 for r in leaves)
    assert {(r.depth, r.ix, r.iy) for r in oc.quadtree(points.repartition(7), (0.0, 0.0, 1.0, 1.0), 20).collect()} == {(r.depth, r.ix, r.iy) for r in leaves}


def test_scene_dates_without_cloud(spark):
    scenes = spark.createDataFrame([("1996-01-01", None), ("1996-01-01", 10.0), ("1996-01-02", None)], "d string, cloud double").select(F.col("d").cast("date").alias("acq_date"), "cloud")
    assert [tuple(r)[1:] for r in sc.date_stats(scenes).orderBy("acq_date").collect()] == [(10.0, 2), (1e9, 1)]
    assert sc.cloud_at_most(scenes, 5.0).count() == 2


def test_footprints_hold_whole_cells_and_are_not_broadcast(spark):
    cells = spark.range(4).select(F.col("id").alias("cell_x"), F.lit(0).cast("long").alias("cell_y"))
    rows = [("a", 0.0, 0.0, 2.0, 1.0), ("a", 1.0, 0.0, 3.0, 9.0), ("b", 0.2, 0.0, 0.8, 1.0), ("c", -5.0, -5.0, 50.0, 50.0), ("d", None, 0.0, 1.0, 1.0), ("e", 6.0, 6.0, 9.0, 9.0)]
    out = sc.footprint_coverage(spark.createDataFrame(rows, "acq_date string, xmin double, ymin double, xmax double, ymax double"), cells)
    assert {r.acq_date: (r.ratio, r.covers) for r in out.collect()} == {"a": (0.75, False), "c": (1.0, True)}
    assert sc.footprint_coverage(spark.createDataFrame(rows, "acq_date string, xmin double, ymin double, xmax double, ymax double"), cells.where("false")).count() == 0
    from geoquilt.queries import QUERIES

    plan = QUERIES["a9_footprint_coverage"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "BuildLeft" not in plan


def test_feature_files_need_a_system_and_features(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features": [{"properties": {"id": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}')
    with pytest.raises(Exception, match="coordinate system"):
        readers.features(spark, str(tmp_path / "a.json")).collect()
    assert readers.features(spark, str(tmp_path / "a.json"), crs="EPSG:4326").first().crs == "EPSG:4326"


def test_without_the_corpus_operators_the_rest_imports():
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['geoquilt.llm'] = None; import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op1_') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])


def _points(spark, n, x=0.5, y=0.5):
    return spark.range(n).select(F.lit(x).alias("x"), F.lit(y).alias("y"))


def test_a_full_box_of_the_deepest_level_fails(spark):
    box = (0.0, 0.0, 1.0, 1.0)
    assert oc.quadtree(_points(spark, 30), box, 5, depth=2, limit=30).collect()[0].n == 30
    with pytest.raises(Exception, match="more than 29 points"):
        oc.quadtree(_points(spark, 30), box, 5, depth=2, limit=29).collect()
    assert [tuple(r) for r in oc.quadtree(_points(spark, 30), box, 5, depth=2, max_records=5).collect()] == [(0, 0, 0, 30)]
    assert oc.quadtree(_points(spark, 0), box, 5, max_records=5).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000])
def test_quantiles_like_numpy(spark, n):
    from geoquilt.operators import ranks

    values = np.random.default_rng(n).integers(0, max(1, n // 3), n) / 7
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    row = ranks.quantiles(df, "v", {"low": 0.05, "high": 0.95}).collect()[0]
    if n == 0:
        assert row.low is None and row.high is None
    else:
        assert np.allclose([row.low, row.high], np.percentile(values, [5, 95]))
        assert ranks.upper_medians(df, ["v"]).collect()[0].v == sorted(values)[n // 2]


def test_tile_files_by_their_numbers(spark, tmp_path):
    for name in ("merged_tile10", "merged_tile2", "tilex", "other"):
        spark.range(2).toPandas().to_parquet(tmp_path / f"{name}.parquet")
    found = {r.path.rsplit("/", 1)[1]: r.number for r in readers.tile_files(spark, str(tmp_path)).collect()}
    assert found == {"merged_tile10.parquet": 10, "merged_tile2.parquet": 2, "tilex.parquet": 0, "other.parquet": 0}


def _area(spark, *points):
    return spark.createDataFrame([("a", 0, [(float(x), float(y)) for x, y in points])], "aoi_id string, feature_id int, ring array<struct<x:double,y:double>>")


def test_tiles_by_degrees_only_without_others(spark):
    tiles = spark.createDataFrame([(1, "one", 0.0, 0.0, 1.0, 1.0), (2, "two", 2.0, 0.0, 3.0, 1.0), (3, "", 0.0, 0.0, 1.0, 1.0)], "tile_id int, relpath string, xmin double, ymin double, xmax double, ymax double")
    indexed = ra.tile_index(tiles, "EPSG:3857", 100_000)
    near, far = _area(spark, (0, 0), (1, 0), (1, 1), (0, 0)), _area(spark, (70, 70), (71, 70), (71, 71), (70, 70))
    degrees = _area(spark, (2, 0.1), (2.1, 0.1), (2.1, 0.2), (2, 0.1))
    ids = lambda df: sorted(r.relpath for r in df.collect())
    assert ids(ra.overlapping_tiles(indexed, near, areas_wgs84=degrees)) == ["one"]
    assert ids(ra.overlapping_tiles(indexed, far, areas_wgs84=degrees)) == ["two"]
    assert ids(ra.overlapping_tiles(indexed, far)) == []
    with pytest.raises(ValueError, match="no tile"):
        ra.overlapping_tiles(indexed, far, areas_wgs84=far, required=True)


def test_clip_falls_back_step_by_step(spark):
    pixels = spark.createDataFrame([(r, c) for r in range(4) for c in range(4) if (r, c) != (1, 1)], "row int, col int")
    count = lambda *points: ra.clip_or_whole(pixels, _area(spark, *points)).count()
    assert count((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)) == 1  # one centre
    assert count((2.1, 2.1), (2.2, 2.1), (2.2, 2.2), (2.1, 2.1)) == 1  # no centre, one touched
    assert count((1.4, 1.4), (1.6, 1.4), (1.6, 1.6), (1.4, 1.4)) == 15  # in the gap
    with pytest.raises(ValueError, match="no area meets"):
        count((9, 9), (10, 9), (10, 10), (9, 9))


def test_dimensions_of_any_name(spark):
    cells = spark.createDataFrame([(1, 5, 6, 0.5), (1, 5, 7, 0.5)], "band int, lat int, lon int, v double")
    assert ra.normalize_dims(cells, ["band", "lat", "lon"]).columns == ["y", "x", "v"]
    two = cells.union(cells.selectExpr("2", "lat", "lon", "v"))
    assert ra.normalize_dims(two, ["lat", "lon", "band"]).columns == ["band", "y", "x", "v"]
    named = cells.withColumnsRenamed({"lat": "y", "lon": "x"})
    assert ra.normalize_dims(named, ["band", "x", "y"]).columns == ["y", "x", "v"]
    with pytest.raises(ValueError):
        ra.normalize_dims(cells.select("lat", "v"), ["lat"])


def test_a_year_without_images_is_an_error(spark):
    import datetime

    image = lambda k, *date: (k, datetime.date(*date), 0.0, 0.0, 1.0, 1.0)
    images = spark.createDataFrame([image(1, 2020, 1, 1), image(2, 2019, 12, 31), image(3, 2019, 12, 31), image(4, 2018, 12, 31)], "image_id int, image_date date, xmin double, ymin double, xmax double, ymax double")
    area = _area(spark, (0, 0), (1, 0), (1, 1), (0, 0))
    assert [r.image_id for r in readers.annual_images(images, area, 2019, required=True).collect()] == [2]
    with pytest.raises(ValueError, match="no image of 2021"):
        readers.annual_images(images, area, 2021, required=True)


def test_plugins_by_name_and_their_resolutions(spark):
    from geoquilt.plans import plugins

    known = plugins.Variables()
    found = lambda df: plugins.Variable(lambda options: lambda areas, year, season, resolution: df, ext=lambda options: options.get("format", "tif"))
    known.add("Swi", found(spark.range(3)))
    known.add("own", found((spark.range(2), 7.5)))
    assert known.names() == ["own", "swi"] and known.ext("SWI", {"format": "zarr"}) == "zarr"
    assert known.layer("swi", None, 2020, "summer")[1] == 1000 and known.layer("swi", None, 2020, "summer", 50.0)[1] == 50.0
    assert known.layer("own", None, 2020, "summer", 50.0)[1] == 7.5
    with pytest.raises(ValueError, match="twice"):
        known.add("SWI", found(None))
    with pytest.raises(ValueError, match="unknown variable"):
        known.get("x")


def test_clipped_area_like_the_clipped_ring(spark):
    random = np.random.default_rng(5)
    rings, boxes = [], []
    for i in range(300):
        n = int(random.integers(3, 9))
        turn = np.sort(random.uniform(0, 2 * math.pi, n))[:: 1 if i % 2 else -1]
        far = random.uniform(1, 6, n)
        points = [(float(r * math.cos(t)), float(r * math.sin(t))) for r, t in zip(far, turn, strict=True)]
        points = [(float(round(x)), float(round(y))) for x, y in points] if i % 3 == 0 else points  # edges straight up, flat, on the box
        low, high = random.integers(-5, 0, 2), random.integers(1, 6, 2)
        rings.append([*points, points[0]])
        boxes.append((float(low[0]), float(low[1]), float(high[0]), float(high[1])))
    rows = [(r, *b) for r, b in zip(rings, boxes, strict=True)]
    df = spark.createDataFrame(rows, "ring array<struct<x:double,y:double>>, xmin double, ymin double, xmax double, ymax double")
    box = tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    area, wanted = geometry.clipped_area(F.col("ring"), box), geometry.ring_area(geometry.clipped_ring(F.col("ring"), box))
    for got, want in df.select(area, wanted).collect():
        assert got == pytest.approx(want, abs=1e-9)
    holes = [([(0.0, 0.0), (4.0, None), (4.0, 4.0), (0.0, 0.0)],), ([],)]
    missing = spark.createDataFrame(holes, "ring array<struct<x:double,y:double>>")
    unit = tuple(F.lit(v) for v in (0.0, 0.0, 1.0, 1.0))
    assert [r[0] for r in missing.select(geometry.clipped_area(F.col("ring"), unit)).collect()] == [None, 0.0]
