"""Grids, tiles and rasters: choosing, merging, clipping, resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import crs, geometry
from .areas import AREAS_A_TASK
from .grids import dealt, few
from .ranks import upper_medians

BOX = ("xmin", "ymin", "xmax", "ymax")


def tile_stats(tiles: DataFrame, by: list[str]) -> DataFrame:
    """(by, median_width, median_height): the upper median, the middle value or the higher of the two, picked by rank; no group is held."""
    sized = tiles.select(*by, (F.col("xmax") - F.col("xmin")).alias("median_width"), (F.col("ymax") - F.col("ymin")).alias("median_height"))
    return upper_medians(sized, ["median_width", "median_height"], tuple(by))


def bounds(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def overlapping_tiles(tiles: DataFrame, areas: DataFrame, areas_wgs84: DataFrame | None = None, order: str = "tile_id", required: bool = False) -> DataFrame:
    """(relpath, tile_id, xmin … ymax): the tiles to read for some areas, each relpath once, the first in ``order``.

    These are the tiles that touch the areas' common box, widened by half the median tile; any tile that touches an
    area itself is one of them. If there are none, those whose box in degrees (w_xmin … w_ymax, see ``tile_index``)
    touches the box of ``areas_wgs84``. With ``required`` it is an error to find none. A box is four numbers, which reach
    the scan as filters.
    """
    sized = tiles.withColumn("w", F.col("xmax") - F.col("xmin")).withColumn("h", F.col("ymax") - F.col("ymin"))
    half, box = upper_medians(sized, ["w", "h"]).first(), common_box(areas).first()
    wide = (box.xmin - half.w / 2, box.ymin - half.h / 2, box.xmax + half.w / 2, box.ymax + half.h / 2) if half and half.w is not None and box.xmin is not None else None
    hit = touching_box(tiles, BOX, wide)
    if (areas_wgs84 is not None or required) and hit.isEmpty():
        # No tile touches the widened box, so none touches an area inside it: only boxes in degrees are left.
        if areas_wgs84 is not None:
            degrees = tuple(common_box(areas_wgs84).first())
            hit = touching_box(tiles, tuple(f"w_{c}" for c in BOX), degrees if degrees[0] is not None else None)
        if required and hit.isEmpty():
            raise ValueError("the areas touch no tile")
    first = F.min_by(F.struct("tile_id", *BOX), F.struct(order, "tile_id"))
    return hit.where("relpath <> ''").groupBy("relpath").agg(first.alias("t")).select("relpath", "t.*")


def common_box(areas: DataFrame) -> DataFrame:
    """One row: the box around all rings."""
    return areas.select(geometry.ring_box(F.col("ring")).alias("b")).agg(*[f(f"b.{c}").alias(c) for f, c in zip((F.min, F.min, F.max, F.max), BOX, strict=True)])


def touching_box(tiles: DataFrame, sides: tuple, box: tuple[float, float, float, float] | None) -> DataFrame:
    """The tiles whose box, four named columns, touches a box of four numbers; those without a box touch nothing, nor does no box."""
    return tiles.where(geometry.boxes_touch(sides, tuple(map(F.lit, box))) if box else F.lit(False))


def normalize_dims(raster: DataFrame, dims: list[str]) -> DataFrame:
    """A raster, one row a cell, with the dimensions ``dims`` in their order: the last two become y and x.

    A band or variable dimension of one value is dropped, one of several stays and is no spatial dimension. If x and y
    are among the dimensions nothing is renamed; with fewer than two it is an error.
    """
    one = [d for d in dims if d in ("band", "variable") and raster.select(d).distinct().limit(2).count() == 1]
    left = [d for d in dims if d not in one]
    out = raster.drop(*one)
    if {"x", "y"} <= set(left):
        return out
    spatial = [d for d in left if d not in ("band", "variable")]
    spatial = spatial if len(spatial) >= 2 else left
    if len(spatial) < 2:
        raise ValueError(f"no two spatial dimensions among {dims}")
    return out.withColumnsRenamed({spatial[-2]: "y", spatial[-1]: "x"})


def recode_landcover(pixels: DataFrame, column: str, nodata: int = -9999, missing: int | None = None) -> DataFrame:
    """Land cover classes as whole numbers: 0, NULL and the source's own ``missing`` value become ``nodata``."""
    c = F.col(column)
    none = c.isNull() | (c == 0)
    if missing is not None:
        none = none | (c == missing)
    return pixels.withColumn(column, F.when(none, nodata).otherwise(c).cast("int"))


def best_overlap(rasters: DataFrame, areas: DataFrame) -> DataFrame:
    """(aoi_id, path, area): the raster that shares most with each area, the first path of equals (to nine decimals); none without overlap.

    A ring given twice counts once; an area's different rings must not overlap.
    """
    rings = areas.select("aoi_id", "ring").distinct().withColumn("b", geometry.ring_box(F.col("ring"))).select("aoi_id", "ring", *[F.col(f"b.{x}").alias(f"a_{x}") for x in BOX])
    size = geometry.cell_size(rings, tuple(f"a_{c}" for c in BOX))
    left, right = geometry.with_box_cells(rasters, BOX, size), geometry.with_box_cells(rings, tuple(f"a_{c}" for c in BOX), size)
    met = left.join(geometry.small_or_not(right), ["cell_x", "cell_y"]).where(geometry.boxes_touch(BOX, tuple(f"a_{x}" for x in BOX)))
    once = met.select("aoi_id", "ring", "path", *BOX).distinct()
    shared = geometry.clipped_area(F.col("ring"), tuple(map(F.col, BOX)))
    sums = once.groupBy("aoi_id", "path", *BOX).agg(F.round(F.sum(shared), 9).alias("area")).where("area > 0")
    return sums.groupBy("aoi_id").agg(F.min_by("path", F.struct(-F.col("area"), F.col("path"))).alias("path"), F.max("area").alias("area"))


def tile_mosaic(pixels: DataFrame, order: str = "tile_ord", value: str = "v") -> DataFrame:
    """(row, col, value): each cell from the first tile that has a value there; NULL if none has."""
    return pixels.groupBy("row", "col").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))


def north_up(pixels: DataFrame, grid: DataFrame) -> DataFrame:
    """Pixels whose rows run from north to south: grids (grid_id, height, y0, dy) with dy above 0 are turned."""
    joined = pixels.join(few(grid), "grid_id")
    turned = F.col("dy") > 0
    return joined.withColumns({"row": F.when(turned, F.col("height") - 1 - F.col("row")).otherwise(F.col("row")), "y0": F.when(turned, F.col("y0") + F.col("height") * F.col("dy")).otherwise(F.col("y0")), "dy": -F.abs("dy")})


def clip(pixels: DataFrame, areas: DataFrame, touched: bool = False) -> DataFrame:
    """Pixels whose centre is in an area; with ``touched``, all whose square shares a point with an area.

    ``touched`` is asked for, it is no silent second attempt. Repeated rows stay.
    """
    from .occurrences import in_areas

    if not touched:
        centred = pixels.withColumns({"centre_x": F.col("col") + 0.5, "centre_y": F.col("row") + 0.5})
        return in_areas(centred, areas, "centre_x", "centre_y", edge=False).drop("centre_x", "centre_y")
    # Boxes of areas are wider by one pixel, so that a square's first corner is enough to find them by.
    rings = areas.select("ring").distinct().withColumn("b", geometry.ring_box(F.col("ring")))
    rings = rings.select("ring", (F.col("b.xmin") - 1).alias("a_xmin"), (F.col("b.ymin") - 1).alias("a_ymin"), F.col("b.xmax").alias("a_xmax"), F.col("b.ymax").alias("a_ymax"))
    size = geometry.cell_size(rings, tuple(f"a_{c}" for c in BOX))
    rings = geometry.with_box_cells(rings, tuple(f"a_{c}" for c in BOX), size)
    placed = geometry.with_point_cells(pixels, "col", "row", size)
    square = (F.col("col"), F.col("row"), F.col("col") + 1, F.col("row") + 1)
    on = (placed.cell_x == rings.cell_x) & (placed.cell_y == rings.cell_y) & geometry.ring_meets_box(F.col("ring"), square)
    return placed.join(geometry.small_or_not(rings), on, "left_semi").drop("cell_x", "cell_y")


def clip_or_whole(pixels: DataFrame, areas: DataFrame) -> DataFrame:
    """Pixels whose centre is in an area; if none is, those that an area touches; if none is touched, all of them.

    An area that does not meet the box around the pixels is an error. Each step is tried only when the one before is empty.
    """
    for touched in (False, True):
        found = clip(pixels, areas, touched)
        if not found.isEmpty():
            return found
    box = pixels.agg(F.min("col").alias("xmin"), F.min("row").alias("ymin"), (F.max("col") + 1).alias("xmax"), (F.max("row") + 1).alias("ymax"))
    met = areas.crossJoin(F.broadcast(box)).where(geometry.ring_meets_box(F.col("ring"), tuple(map(F.col, BOX))))  # the box is one row
    if met.isEmpty():
        raise ValueError("no area meets the raster")
    return pixels


def tile_index(tiles: DataFrame, system: str, scale: float = 1.0) -> DataFrame:
    """tiles with w_xmin … w_ymax, the box in degrees around their four corners, and ``crs``; without a box where a corner has no place.

    Tile sides are ``scale`` metres (or degrees) each.
    """
    corners = [crs.transform(F.col(x) * scale, F.col(y) * scale, system, "EPSG:4326") for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
    lons, lats = [c[0] for c in corners], [c[1] for c in corners]
    out_of_place = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    failed = out_of_place(lons[0])
    for v in lons[1:] + lats:
        failed = failed | out_of_place(v)
    box = {"w_xmin": F.least(*lons), "w_ymin": F.least(*lats), "w_xmax": F.greatest(*lons), "w_ymax": F.greatest(*lats)}
    return tiles.withColumns({name: F.when(~failed, value) for name, value in box.items()} | {"crs": F.lit(system)})


def resample_nearest(source: DataFrame, target: DataFrame, ratio: float, bands: list[str]) -> DataFrame:
    """target (row, col) with the bands of the source cell under its centre; source cells are ``ratio`` times as small.

    The source cell is computed, so the join is an equality.
    """
    at = lambda c: F.floor((F.col(c) + 0.5) * ratio).cast("long")
    placed = target.withColumn("source_row", at("row")).withColumn("source_col", at("col"))
    cells = source.select(F.col("row").alias("source_row"), F.col("col").alias("source_col"), *bands)
    return placed.join(cells, ["source_row", "source_col"], "left").drop("source_row", "source_col")


def target_grid(spark, width: int, height: int) -> DataFrame:
    """(row, col) of a grid."""
    rows = spark.range(height).select(F.col("id").alias("row"))
    return rows.select("row", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("col")).withColumn("col", F.col("col").cast("long"))


def reproject_nearest(source: DataFrame, target: DataFrame, step: float, x0: float = 0.0, y0: float = 0.0, value: str = "v") -> DataFrame:
    """target with the value of the source cell in which its centre (x0 + (col + 0.5) step, …) lies."""
    placed = target.withColumn("source_col", F.floor(x0 + (F.col("col") + 0.5) * step).cast("long")).withColumn("source_row", F.floor(y0 + (F.col("row") + 0.5) * step).cast("long"))
    cells = source.select(F.col("row").alias("source_row"), F.col("col").alias("source_col"), value)
    return placed.join(cells, ["source_row", "source_col"], "left").select("row", "col", value)


def reproject_bilinear(source: DataFrame, target: DataFrame, step: float, x0: float = 0.0, y0: float = 0.0, value: str = "v") -> DataFrame:
    """target with the mean of the four source cells about its centre, by nearness; cells without a value don't count.

    Grids that shrink are sampled at four cells as well, not averaged over more.
    """
    at = lambda c, o: F.lit(o) + (F.col(c) + 0.5) * step - 0.5
    placed = target.select("row", "col", at("col", x0).alias("u"), at("row", y0).alias("t"))
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("k")
    four = placed.select("row", "col", "u", "t", F.floor("u").alias("fu"), F.floor("t").alias("ft"), corner)
    part = lambda exact, floor, k: F.when(F.col(k) == 1, F.col(exact) - F.col(floor)).otherwise(F.lit(1.0) - (F.col(exact) - F.col(floor)))
    four = four.select("row", "col", (F.col("fu") + F.col("k.i")).cast("long").alias("source_col"), (F.col("ft") + F.col("k.j")).cast("long").alias("source_row"), (part("u", "fu", "k.i") * part("t", "ft", "k.j")).alias("weight"))
    cells = source.where(F.col(value).isNotNull()).select(F.col("row").alias("source_row"), F.col("col").alias("source_col"), value)
    met = four.join(cells, ["source_row", "source_col"], "left").groupBy("row", "col")
    return met.agg(F.try_divide(F.sum(F.col("weight") * F.col(value)), F.sum(F.when(F.col(value).isNotNull(), F.col("weight")))).alias(value))


def native_grid(grids: DataFrame, source: str, target: str) -> DataFrame:
    """grids (xmin … ymax, width, height) with dx, dy in the target system, width and height kept.

    The box in the target system is that of points along the edges.
    """
    steps = F.explode(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: i / 20.0)).alias("t")
    out = None
    edges = grids.select("grid_id", *BOX, "width", "height", steps)
    points = []
    for fixed, along in (("ymin", "x"), ("ymax", "x"), ("xmin", "y"), ("xmax", "y")):
        moving = F.col(f"{along}min") + (F.col(f"{along}max") - F.col(f"{along}min")) * F.col("t")
        points.append(F.struct(moving.alias("px"), F.col(fixed).alias("py")) if along == "x" else F.struct(F.col(fixed).alias("px"), moving.alias("py")))
    spread = edges.select("grid_id", "width", "height", F.explode(F.array(*points)).alias("p"))
    x, y = crs.transform(F.col("p.px"), F.col("p.py"), source, target)
    out = spread.groupBy("grid_id", "width", "height").agg(F.min(x).alias("x0"), F.max(y).alias("y0"), F.max(x).alias("x1"), F.min(y).alias("y1"))
    return out.select("grid_id", "x0", "y0", ((F.col("x1") - F.col("x0")) / F.col("width")).alias("dx"), ((F.col("y0") - F.col("y1")) / F.col("height")).alias("dy"), "width", "height")


def overviews(pixels: DataFrame, levels: int = 3, block: int = 512) -> DataFrame:
    """Reduced copies by nearest cell, with the block that each cell is stored in: level k keeps every 2^k-th row and column."""
    level = pixels.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumn("by", F.expr("cast(power(2, level) as bigint)"))
    kept = level.where("row % by = 0 and col % by = 0").withColumns({"row": F.expr("row div by"), "col": F.expr("col div by")}).drop("by")
    return kept.withColumns({"block_row": F.floor(F.col("row") / block), "block_col": F.floor(F.col("col") / block)})


def area_tiles(areas: DataFrame, step: float) -> DataFrame:
    """(aoi_id, i, j, xmin … ymax, parts): boxes of ``step`` from the corner of each area's box, cut off at it, of those that meet the area.

    ``parts`` are the rings of what the box and the area's features share; a ring given twice counts
    once. A box that only touches the area stays, its parts have no area. Edges come from the number
    of steps, so they don't drift. Each ring goes to the boxes that its own box touches and is cut there.
    """
    ring = dealt(areas.select("aoi_id", "ring"), AREAS_A_TASK, "aoi_id").distinct().withColumn("b", geometry.ring_box(F.col("ring")))
    box = ring.groupBy("aoi_id").agg(*[f(f"b.{c}").alias(f"a_{c}") for f, c in zip((F.min, F.min, F.max, F.max), BOX, strict=True)])
    last = lambda low, high: F.greatest(F.ceil((F.col(high) - F.col(low)) / step).cast("int") - 1, F.lit(0))
    at = lambda value, low, high, more: F.greatest(F.least(F.floor((F.col(value) - F.col(low)) / step).cast("int") + more, last(low, high)), F.lit(0))
    near = lambda c: F.explode(F.sequence(at(f"b.{c}min", f"a_{c}min", f"a_{c}max", -1), at(f"b.{c}max", f"a_{c}min", f"a_{c}max", 1)))
    edge = lambda low, high, k: F.least(F.col(low) + k * step, F.col(high))
    # Out of generators, else each edge works the ends out again, and each box of a strip the strip.
    ends = lambda c, k: [edge(f"a_{c}min", f"a_{c}max", F.col(k)).alias(f"{c}min"), edge(f"a_{c}min", f"a_{c}max", F.col(k) + 1).alias(f"{c}max")]
    strips = ring.join(box.hint("merge"), "aoi_id").withColumn("i", near("x"))
    strips = strips.select("aoi_id", "ring", "b", "a_ymin", "a_ymax", "i", F.inline(F.array(F.struct(*ends("x", "i")))))
    strips = strips.select("*", F.explode(F.array(geometry.ring_between(F.col("ring"), "x", F.col("xmin"), F.col("xmax"), (F.col("b.xmin"), F.col("b.xmax"))))).alias("strip")).withColumn("j", near("y"))
    placed = strips.select("aoi_id", "ring", "b", "strip", "i", "j", "xmin", "xmax", F.inline(F.array(F.struct(*ends("y", "j")))))
    met = placed.where(geometry.ring_meets_box(F.col("ring"), tuple(map(F.col, BOX))))
    part = geometry.ring_between(F.col("strip"), "y", F.col("ymin"), F.col("ymax"), (F.col("b.ymin"), F.col("b.ymax")))
    return met.groupBy("aoi_id", "i", "j", *BOX).agg(F.sort_array(F.collect_list(part)).alias("parts"))


def tile_shrink(points: DataFrame, start: float, most: int, floor: float, x: str = "x", y: str = "y") -> DataFrame:
    """(step, heaviest): the largest of start, start / 2, … not below ``floor`` at which no tile holds more than ``most`` points, else the last.

    All steps are counted in one pass.
    """
    steps = []
    while start >= floor and start > 0:
        steps.append(start)
        start /= 2
    level = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(s).alias("step")) for i, s in enumerate(steps)])).alias("s")
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y, level).select("s.level", "s.step", F.floor(F.col(x) / F.col("s.step")).alias("i"), F.floor(F.col(y) / F.col("s.step")).alias("j"))
    heavy = placed.groupBy("level", "step", "i", "j").agg(F.count(F.lit(1)).alias("n")).groupBy("level", "step").agg(F.max("n").alias("heaviest"))
    return heavy.groupBy().agg(F.min_by(F.struct("step", "heaviest"), F.struct((F.col("heaviest") > most).alias("over"), F.when(F.col("heaviest") > most, -F.col("level")).otherwise(F.col("level")))).alias("b")).select("b.step", "b.heaviest")


def tile_number(path: Column) -> Column:
    """The number after the last ``tile`` in a file's name, 0 if there is none."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.when(F.contains(stem, F.lit("tile")), F.coalesce(F.element_at(F.split(stem, "tile"), -1).try_cast("int"), F.lit(0))).otherwise(0)
