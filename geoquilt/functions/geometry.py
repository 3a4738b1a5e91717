"""Boxes, closed rings and cell keys as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boxes_touch(a: tuple, b: tuple) -> Column:
    """Whether two boxes (xmin, ymin, xmax, ymax) share a point, edges included."""
    a, b = ([F.col(x) if isinstance(x, str) else F.lit(x) if not isinstance(x, Column) else x for x in v] for v in (a, b))
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def overlap_area(a: tuple, b: tuple) -> Column:
    """The area that two boxes share."""
    a, b = ([F.col(x) if isinstance(x, str) else F.lit(x) if not isinstance(x, Column) else x for x in v] for v in (a, b))
    wide, high = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))


def edges(ring: Column) -> Column:
    """array<struct<a, b>>: the ends of each edge of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def in_ring(x: Column, y: Column, ring: Column, edge: bool = False) -> Column:
    """Whether a point is inside a closed ring, by counting crossed edges; with ``edge``, on it as well.

    Edges of no length cross nothing. What lies on an edge is otherwise inside or not by which side it is.
    """
    return among_edges(x, y, edges(ring), edge)


def among_edges(x: Column, y: Column, lines: Column, edge: bool = False) -> Column:
    """Whether a point is inside what the edges of some closed rings enclose, by counting crossed ones; with ``edge``, on one as well."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"])

    def on(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straight = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        return straight & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    inside = F.size(F.filter(lines, crosses)) % 2 == 1
    return inside | F.exists(lines, on) if edge else inside


def edges_meet(s: Column, t: Column) -> Column:
    """Whether two edges share a point: each has its ends on both sides of the other's line or on it, and their boxes touch."""
    side = lambda e, p: (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"])
    apart = lambda e, f: F.signum(side(e, f["a"])) * F.signum(side(e, f["b"])) > 0
    low, high = (lambda e, c: F.least(e["a"][c], e["b"][c])), (lambda e, c: F.greatest(e["a"][c], e["b"][c]))
    near = (low(s, "x") <= high(t, "x")) & (low(t, "x") <= high(s, "x")) & (low(s, "y") <= high(t, "y")) & (low(t, "y") <= high(s, "y"))
    return near & ~apart(s, t) & ~apart(t, s)


def ring_box(ring: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax> of a ring."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def ring_area(ring: Column) -> Column:
    """The area of a closed ring by the shoelace formula."""
    twice = F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.abs(twice) / 2


def ring_meets_box(ring: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """Whether a closed ring's area and a box share a point, borders included."""
    # Without an edge that touches it, the box is as a whole inside or outside.
    return F.exists(edges(ring), lambda e: edge_meets_box(e, box)) | in_ring(box[0], box[1], ring)


def edge_meets_box(e: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """Whether an edge and a box share a point, borders included."""
    xmin, ymin, xmax, ymax = box
    a, b = e["a"], e["b"]
    near = (F.least(a["x"], b["x"]) <= xmax) & (F.greatest(a["x"], b["x"]) >= xmin) & (F.least(a["y"], b["y"]) <= ymax) & (F.greatest(a["y"], b["y"]) >= ymin)
    sides = [(b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"]) for x in (xmin, xmax) for y in (ymin, ymax)]
    return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def clipped_ring(ring: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """The closed ring of what a ring and a box share, empty if nothing: cut at one side of the box after the other.

    Parts that a box cuts off from each other stay joined along its border, which adds no area.
    """
    return ring_between(ring_between(ring, "x", box[0], box[2]), "y", box[1], box[3])


def ring_between(ring: Column, axis: str, low: Column, high: Column, extent: tuple[Column, Column] | None = None) -> Column:
    """The closed ring of what a ring has between two numbers of one axis, x or y: a strip, of which boxes can be cut.

    With ``extent``, between which the ring is known to be on this axis, it is only cut where it reaches beyond.
    """
    side = lambda sign, c, beyond: F.struct(F.lit(float(sign)).alias("sign"), c.cast("double").alias("c"), beyond.alias("beyond"))
    beyond = (extent[0] < low, extent[1] > high) if extent else (F.lit(True), F.lit(True))
    sides = F.filter(F.array(side(1, low, beyond[0]), side(-1, -high, beyond[1])), lambda s: s["beyond"])
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def cut(ring: Column, s: Column) -> Column:
        depth = lambda p: s["sign"] * p[axis] - s["c"]

        def kept(e: Column) -> Column:
            a, b = e["a"], e["b"]
            share = depth(a) / (depth(a) - depth(b))
            border = point(a["x"] + share * (b["x"] - a["x"]), a["y"] + share * (b["y"] - a["y"]))
            inside = F.when(depth(b) >= 0, F.array(point(b["x"], b["y"]))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
            return F.when((depth(a) >= 0) != (depth(b) >= 0), F.concat(F.array(border), inside)).otherwise(inside)

        left = F.array(F.flatten(F.transform(edges(ring), kept)))  # worked out once
        return F.flatten(F.transform(left, lambda x: F.concat(x, F.slice(x, 1, 1))))

    return F.aggregate(sides, ring, cut)


def clipped_area(ring: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """The area that a closed ring and a box share, in one pass over the edges, without the ring that they share.

    Over each edge stands its height above the lower side, held within the box, times its width in the box; the signs of
    there and back leave what is inside. Edges straight up have no width. NULL where a corner lacks a number.
    """
    xmin, ymin, xmax, ymax = box
    within = lambda v, low, high: F.greatest(F.least(v, high), low)

    def cut(e: Column) -> Column:
        a, b = e["a"], e["b"]
        height = lambda x: a["y"] + (b["y"] - a["y"]) * F.try_divide(x - a["x"], b["x"] - a["x"])
        x = [within(p["x"], xmin, xmax) for p in (a, b)]
        return F.struct((x[1] - x[0]).alias("wide"), height(x[0]).alias("from"), height(x[1]).alias("to"))

    def ordered(e: Column) -> Column:
        low, high = F.least(e["from"], e["to"]), F.greatest(e["from"], e["to"])
        held = [within(v, ymin, ymax).alias(name) for v, name in ((low, "held_low"), (high, "held_high"))]
        return F.struct(e["wide"].alias("wide"), low.alias("low"), high.alias("high"), *held)

    def under(e: Column) -> Column:
        slope = (e["held_high"] - e["held_low"]) * ((e["held_high"] + e["held_low"]) / 2 - ymin)
        above = F.greatest(e["high"] - F.greatest(e["low"], ymax), F.lit(0.0)) * (ymax - ymin)
        flat = F.when(e["high"] == e["low"], e["held_low"] - ymin)
        return e["wide"] * F.when(e["high"] > e["low"], F.try_divide(slope + above, e["high"] - e["low"])).otherwise(flat)

    wide = F.filter(edges(ring), lambda e: ~e["a"]["x"].eqNullSafe(e["b"]["x"]))
    return F.abs(F.aggregate(F.transform(F.transform(wide, cut), ordered), F.lit(0.0), lambda total, e: total + under(e)))


def small_or_not(keyed: DataFrame, ring: str = "ring", vertices: int = 1_000_000) -> DataFrame:
    """Rings with cell keys, marked for broadcast if they have at most so many vertices in all, else for a shuffled hash join."""
    total = keyed.agg(F.sum(F.size(ring))).first()[0] or 0
    return F.broadcast(keyed) if total <= vertices else keyed.hint("shuffle_hash")


def z_order(x: Column, y: Column) -> Column:
    """A number that is near for near cells: the bits of both, which are between -2^30 and 2^30, in turn."""

    def spread(v: Column) -> Column:
        v = v.cast("long") + (1 << 30)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def cell_size(boxed: DataFrame, sides: tuple, across: int = 4) -> float:
    """The power of two of which the widest box takes ``across`` and one more at most: cells follow the areas, in whatever units they are."""
    xmin, ymin, xmax, ymax = map(F.col, sides)
    widest = boxed.agg(F.max(F.greatest(xmax - xmin, ymax - ymin))).first()[0]
    return 2.0 ** math.ceil(math.log2(widest / across)) if widest else 1.0


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("long")


def with_point_cells(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """df with cell_x, cell_y: the cell of each point."""
    return df.withColumns({"cell_x": cell(F.col(x), size), "cell_y": cell(F.col(y), size)})


def with_box_cells(df: DataFrame, box: tuple[str, str, str, str], size: float) -> DataFrame:
    """A row of df for each cell that its box touches, so that an equality can find what overlaps."""
    xmin, ymin, xmax, ymax = map(F.col, box)
    span = lambda low, high: F.sequence(cell(low, size), cell(high, size))
    return df.withColumn("cell_x", F.explode(span(xmin, xmax))).withColumn("cell_y", F.explode(span(ymin, ymax)))


def box_wkt(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A box as a polygon of five vertices, six decimals each."""
    p = "%.6f %.6f"
    return F.format_string(f"POLYGON(({p}, {p}, {p}, {p}, {p}))", xmin, ymin, xmin, ymax, xmax, ymax, xmax, ymin, xmin, ymin)
