"""Areas of several parts with holes: inside tests, tags, clips and overlaps in one pass for all areas.

An area is a row (aoi_id, rings): all its rings, closed, outer ones and holes alike. A point is inside
if it is inside an odd number of them, so that neither order nor turning sense matters. Areas are
covered with square cells whose side is a power of two, chosen from the area's own box: at most 25
cells an area, whether its numbers are degrees or metres. Cells of different sides meet by their
common larger one, so that every test is a hash join, and a pair is found in one cell only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from .grids import dealt

BOX = ("xmin", "ymin", "xmax", "ymax")
#: Cells that the longer side of an area's box takes at most, less one.
ACROSS = 4
#: Areas of so many vertices in all are sent to all tasks, so that points stay where they are.
FEW_VERTICES = 1_000_000
#: Areas of a task that cuts them into boxes.
AREAS_A_TASK = 2500
RINGS = "array<array<struct<x:double,y:double>>>"


def with_rings(areas: DataFrame) -> DataFrame:
    """(aoi_id, rings) of areas that are given by rings, or by rows of one ``ring`` each: these become one area, equal rings counted once."""
    if "rings" in areas.columns:
        return areas.select("aoi_id", "rings")
    return areas.groupBy("aoi_id").agg(F.collect_set("ring").alias("rings"))


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, geometry.edges))


def inside(x: Column, y: Column, rings: Column, edge: bool = False) -> Column:
    """Whether a point is inside an odd number of rings; with ``edge``, on one of them as well."""
    return geometry.among_edges(x, y, edges(rings), edge)


def meets_box(rings: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """Whether an area and a box share a point, borders included: an edge touches the box, or the box is as a whole inside."""
    return F.exists(edges(rings), lambda e: geometry.edge_meets_box(e, box)) | inside(box[0], box[1], rings)


def meet(a: Column, b: Column) -> Column:
    """Whether two areas (their rings) share a point, borders included: edges cross or touch, or one has a corner in the other."""
    ea, eb = edges(a), edges(b)
    crossing = F.exists(ea, lambda s: F.exists(eb, lambda t: geometry.edges_meet(s, t)))
    # Without a common border point each part of one is as a whole inside or outside of the other: its first corner tells.
    corner = lambda of, other: F.exists(of, lambda r: inside(r[0]["x"], r[0]["y"], other))
    return crossing | corner(a, b) | corner(b, a)


def box_of(rings: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax> of an area."""
    return geometry.ring_box(F.flatten(rings))


def with_box(areas: DataFrame) -> DataFrame:
    """areas with their boxes; those without a vertex are left out."""
    return areas.withColumn("b", box_of(F.col("rings"))).where("b.xmin is not null").select(*areas.columns, *[F.col(f"b.{c}").alias(f"a_{c}") for c in BOX])


def signed_rings(rings: Column) -> Column:
    """array<struct<ring, sign>>: 1 for what adds to an area, -1 for what is cut out, by how many other rings hold a ring's first corner."""
    depth = lambda r: F.size(F.filter(rings, lambda other: (other != r) & inside(r[0]["x"], r[0]["y"], F.array(other))))
    return F.transform(rings, lambda r: F.struct(r.alias("ring"), F.when(depth(r) % 2 == 0, 1.0).otherwise(-1.0).alias("sign")))


def shared_area(rings: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """How much of an area, whose rings don't cross, is in a box."""
    part = lambda s: s["sign"] * geometry.clipped_area(s["ring"], box)
    return F.aggregate(F.transform(signed_rings(rings), part), F.lit(0.0), lambda total, x: total + x)


def level_of(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The power of two that is the side of a box's cells."""
    side = F.greatest(xmax - xmin, ymax - ymin) / ACROSS
    return F.when(side > 0, F.ceil(F.log2(side))).otherwise(-30).cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


def _covered(df: DataFrame, sides: tuple, levels: Column) -> DataFrame:
    """A row for each cell, at each of the levels, that the box touches."""
    xmin, ymin, xmax, ymax = map(F.col, sides)
    level = F.col("level")
    at = df.withColumn("level", F.explode(levels))
    wide = at.withColumn("cell_x", F.explode(F.sequence(_cell(xmin, level), _cell(xmax, level))))
    return wide.withColumn("cell_y", F.explode(F.sequence(_cell(ymin, level), _cell(ymax, level))))


def _profile(boxed: DataFrame) -> tuple[list[int], int, tuple | None]:
    """The levels of some areas, a few whatever their number, how many vertices they have, and the box around all of them."""
    sides = (F.min("a_xmin"), F.min("a_ymin"), F.max("a_xmax"), F.max("a_ymax"))
    found = boxed.groupBy("own").agg(F.sum(F.size(F.flatten("rings"))).alias("n"), F.array(*sides).alias("box")).collect()
    around = tuple(f(r.box[k] for r in found) for k, f in enumerate((min, min, max, max))) if found else None
    return sorted(r.own for r in found), sum(r.n for r in found), around


def _sized(df: DataFrame, vertices: int) -> DataFrame:
    return F.broadcast(df) if vertices <= FEW_VERTICES else df.hint("shuffle_hash")


def tagged(points: DataFrame, areas: DataFrame, x: str = "lon", y: str = "lat", edge: bool = True) -> DataFrame:
    """points with aoi_id: a row for each area that a point is in or, with ``edge``, on; all areas in one pass.

    A point lies in one cell of an area's side, so a pair is found once. Points outside the box around all areas are left
    out before anything else, by numbers that reach the scan; those without coordinates are in no area. Repeated points stay.
    An area given twice under one name must be one row (see ``with_rings``). No areas give no rows.
    """
    boxed = with_box(with_rings(areas)).withColumn("own", level_of(*[F.col(f"a_{c}") for c in BOX]))
    levels, vertices, around = _profile(boxed)
    if around is None:
        return points.withColumn("aoi_id", F.lit(None).cast(areas.schema["aoi_id"].dataType)).where("false")
    px, py = F.col(x), F.col(y)
    some = points.where(px.between(around[0], around[2]) & py.between(around[1], around[3]))
    placed = some.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    placed = placed.withColumns({"cell_x": _cell(px, F.col("level")), "cell_y": _cell(py, F.col("level"))})
    covered = _covered(boxed, tuple(f"a_{c}" for c in BOX), F.array("own")).drop("own")
    side = F.pow(F.lit(2.0), F.col("level"))
    square = (F.col("cell_x") * side, F.col("cell_y") * side, (F.col("cell_x") + 1) * side, (F.col("cell_y") + 1) * side)
    touched = F.exists(edges(F.col("rings")), lambda e: geometry.edge_meets_box(e, square))
    # Cells outside are dropped, cells inside need no test of their points.
    covered = covered.withColumn("crossed", touched).where(F.col("crossed") | inside(square[0], square[1], F.col("rings")))
    met = placed.join(_sized(covered, vertices * 4), ["level", "cell_x", "cell_y"])
    near = px.between(F.col("a_xmin"), F.col("a_xmax")) & py.between(F.col("a_ymin"), F.col("a_ymax"))
    return met.where(~F.col("crossed") | (near & inside(px, py, F.col("rings"), edge))).select(*points.columns, "aoi_id")


def inside_any(points: DataFrame, areas: DataFrame, x: str = "lon", y: str = "lat", edge: bool = True) -> DataFrame:
    """The points that are in an area or, with ``edge``, on one: each once, however many areas (rows of ``rings``, or of one ``ring``) hold it.

    All areas take cells of one side, that of the widest, so that a point has one cell; few areas are broadcast.
    """
    rows = areas.select("rings") if "rings" in areas.columns else areas.select(F.array("ring").alias("rings"))
    boxed = with_box(rows.distinct()).withColumn("own", level_of(*[F.col(f"a_{c}") for c in BOX]))
    levels, vertices, around = _profile(boxed)
    if around is None:
        return points.where("false")
    px, py, level = F.col(x), F.col(y), F.lit(levels[-1])
    some = points.where(px.between(around[0], around[2]) & py.between(around[1], around[3]))
    placed = some.withColumns({"cell_x": _cell(px, level), "cell_y": _cell(py, level)})
    covered = _covered(boxed, tuple(f"a_{c}" for c in BOX), F.array(level))
    near = px.between(F.col("a_xmin"), F.col("a_xmax")) & py.between(F.col("a_ymin"), F.col("a_ymax"))
    on = (placed.cell_x == covered.cell_x) & (placed.cell_y == covered.cell_y) & near & inside(px, py, F.col("rings"), edge)
    return placed.join(_sized(covered, vertices * 4), on, "left_semi").drop("cell_x", "cell_y")


def tagged_boxes(boxes: DataFrame, areas: DataFrame, sides: tuple = BOX, keep: tuple = ()) -> DataFrame:
    """boxes with aoi_id (and columns ``keep`` of the areas): a row for each area whose box touches a box; all areas in one pass.

    Boxes have levels of their own. A box and an area meet at the larger of their levels, in the cell that holds the lower left
    corner of what their boxes share, so a pair is found once. Boxes without a side are in no pair.
    """
    rows = areas if "rings" in areas.columns else with_rings(areas)
    boxed = with_box(rows).withColumn("own", level_of(*[F.col(f"a_{c}") for c in BOX]))
    levels, vertices, around = _profile(boxed)
    if around is None:
        return boxes.withColumn("aoi_id", F.lit(None).cast(areas.schema["aoi_id"].dataType)).where("false")
    b = [F.col(c) for c in sides]
    some = boxes.where((b[0] <= around[2]) & (b[2] >= around[0]) & (b[1] <= around[3]) & (b[3] >= around[1])).withColumn("box_own", level_of(*b))
    # A box larger than an area comes at its own level, and the area at it too; there are no more levels than exponents.
    of_boxes = sorted(r.box_own for r in some.select("box_own").distinct().collect())
    every = sorted({*levels, *of_boxes})
    from_own = lambda own: F.filter(F.array(*map(F.lit, every)), lambda v: v >= F.col(own))
    left = _covered(some, sides, from_own("box_own"))
    right = _covered(boxed, tuple(f"a_{c}" for c in BOX), from_own("own"))
    met = left.join(_sized(right, vertices * 4 * len(every)), ["level", "cell_x", "cell_y"]).where(F.col("level") == F.greatest("own", "box_own"))
    once = (F.col("cell_x") == _cell(F.greatest(b[0], F.col("a_xmin")), F.col("level"))) & (F.col("cell_y") == _cell(F.greatest(b[1], F.col("a_ymin")), F.col("level")))
    near = (b[0] <= F.col("a_xmax")) & (b[2] >= F.col("a_xmin")) & (b[1] <= F.col("a_ymax")) & (b[3] >= F.col("a_ymin"))
    return met.where(near & once).select(*boxes.columns, "aoi_id", *keep)


def touching(boxes: DataFrame, areas: DataFrame, sides: tuple = BOX) -> DataFrame:
    """boxes with aoi_id of each area that they touch."""
    return tagged_boxes(boxes, areas, sides, ("rings",)).where(meets_box(F.col("rings"), tuple(map(F.col, sides)))).drop("rings")


def touching_footprints(scenes: DataFrame, areas: DataFrame, footprint: str = "footprint") -> DataFrame:
    """scenes, whose footprints are rings like those of areas, with aoi_id of each area that they touch, in their true shape."""
    named = {f"f_{c}": box_of(F.col(footprint))[c] for c in BOX}
    boxed = scenes.withColumns(named).where("f_xmin is not null")
    met = tagged_boxes(boxed, areas, tuple(f"f_{c}" for c in BOX), ("rings",))
    return met.where(meet(F.col(footprint), F.col("rings"))).select(*scenes.columns, "aoi_id")


def clip(pixels: DataFrame, areas: DataFrame) -> DataFrame:
    """pixels (row, col) with aoi_id of each area that their centre is in."""
    centred = pixels.withColumns({"centre_x": F.col("col") + 0.5, "centre_y": F.col("row") + 0.5})
    return tagged(centred, areas, "centre_x", "centre_y", edge=False).drop("centre_x", "centre_y")


def best_overlap(rasters: DataFrame, areas: DataFrame, required: bool = False) -> DataFrame:
    """(aoi_id, path, area): the raster that shares most with each area, the first path of equals (to nine decimals); none without overlap.

    With ``required`` it is an error if an area has none.
    """
    met = tagged_boxes(rasters, areas, BOX, ("rings",))
    shared = met.select("aoi_id", "path", F.round(shared_area(F.col("rings"), tuple(map(F.col, BOX))), 9).alias("area")).where("area > 0")
    best = shared.groupBy("aoi_id").agg(F.min_by("path", F.struct(-F.col("area"), F.col("path"))).alias("path"), F.max("area").alias("area"))
    if required:
        left = areas.select("aoi_id").distinct().join(best, "aoi_id", "left_anti").limit(1).collect()
        if left:
            raise ValueError(f"no raster overlaps area {left[0].aoi_id}")
    return best


def grid_tiles(areas: DataFrame, step: float) -> DataFrame:
    """(aoi_id, i, j, xmin … ymax, area): boxes of ``step`` from the corner of each area's box, cut off at it, of those that meet the area, with what they share.

    Each ring goes to the boxes that its own box touches, and its share is taken there; no row holds an area's boxes or carries
    more than one ring. A box that a ring only touches, or that lies in a hole, stays out; edges come from the number of steps.
    """
    boxed = with_box(with_rings(dealt(areas, AREAS_A_TASK, "aoi_id")))
    ring = boxed.withColumn("s", F.explode(signed_rings(F.col("rings")))).select("aoi_id", *[f"a_{c}" for c in BOX], F.col("s.ring").alias("ring"), F.col("s.sign").alias("sign"))
    ring = ring.withColumn("b", geometry.ring_box(F.col("ring")))
    last = lambda low, high: F.greatest(F.ceil((F.col(high) - F.col(low)) / step).cast("int") - 1, F.lit(0))
    at = lambda value, low, high: F.least(F.floor((value - F.col(low)) / step).cast("int"), last(low, high))
    cells = ring.withColumn("i", F.explode(F.sequence(at(F.col("b.xmin"), "a_xmin", "a_xmax"), at(F.col("b.xmax"), "a_xmin", "a_xmax"))))
    cells = cells.withColumn("j", F.explode(F.sequence(at(F.col("b.ymin"), "a_ymin", "a_ymax"), at(F.col("b.ymax"), "a_ymin", "a_ymax"))))
    edge = lambda low, high, k: F.least(F.col(low) + k * step, F.col(high))
    i, j = F.col("i"), F.col("j")
    cells = cells.withColumns({"xmin": edge("a_xmin", "a_xmax", i), "ymin": edge("a_ymin", "a_ymax", j), "xmax": edge("a_xmin", "a_xmax", i + 1), "ymax": edge("a_ymin", "a_ymax", j + 1)})
    part = F.col("sign") * geometry.clipped_area(F.col("ring"), tuple(map(F.col, BOX)))
    return cells.groupBy("aoi_id", "i", "j", *BOX).agg(F.round(F.sum(part), 9).alias("area")).where("area > 0")
