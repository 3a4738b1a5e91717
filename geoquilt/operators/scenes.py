"""Scene catalogues: which dates to look at, and how well their footprints cover an area."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry
from .grids import few

BOX = ("xmin", "ymin", "xmax", "ymax")
NO_CLOUD_KNOWN = 1e9


def cloud_at_most(scenes: DataFrame, limit: float) -> DataFrame:
    """Scenes that are not known to be cloudier; unlike the cube's filter this keeps unknown ones."""
    return scenes.where(F.col("cloud").isNull() | (F.col("cloud") <= limit))


def scenes_in_area(scenes: DataFrame, areas: DataFrame) -> DataFrame:
    """Scenes whose footprint touches an area, its border included. Duplicate areas double nothing; scenes without a box touch none.

    A scene stands in one cell, that of its lower left corner, of a level at which it is no wider than a cell; areas stand in
    all cells from which a scene can reach them. So the semi join, on cells, gives each scene once.
    """
    sides = tuple(f"a_{x}" for x in BOX)
    rings = areas.select("ring").distinct().withColumn("b", geometry.ring_box(F.col("ring"))).select("ring", *[F.col(f"b.{x}").alias(f"a_{x}") for x in BOX])
    around = rings.agg(*[f(c) for f, c in zip((F.min, F.min, F.max, F.max), sides, strict=True)]).first()
    if around[0] is None:
        return scenes.where("false")
    base = int(math.log2(geometry.cell_size(rings, sides)))
    xmin, ymin, xmax, ymax = map(F.col, BOX)
    wide = F.greatest(xmax - xmin, ymax - ymin)
    level = F.when(wide > 2.0**base, F.ceil(F.log2(wide) + 1e-9).cast("int")).otherwise(base)
    some = scenes.where((xmin <= around[2]) & (xmax >= around[0]) & (ymin <= around[3]) & (ymax >= around[1])).withColumn("level", level)
    levels = sorted(r.level for r in some.select("level").distinct().collect())  # no more than there are exponents
    cell = lambda value: F.floor(value / F.pow(F.lit(2.0), F.col("level"))).cast("long")
    reach = lambda low, high: F.explode(F.sequence(cell(F.col(low) - F.pow(F.lit(2.0), F.col("level"))), cell(F.col(high))))
    right = rings.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    right = right.withColumn("cell_x", reach("a_xmin", "a_xmax")).withColumn("cell_y", reach("a_ymin", "a_ymax"))
    left = some.withColumns({"cell_x": cell(xmin), "cell_y": cell(ymin)})
    near = geometry.boxes_touch(BOX, sides) & geometry.ring_meets_box(F.col("ring"), tuple(map(F.col, BOX)))
    same = (left.level == right.level) & (left.cell_x == right.cell_x) & (left.cell_y == right.cell_y)
    return left.join(geometry.small_or_not(right), same & near, "left_semi").select(*scenes.columns)


def date_stats(scenes: DataFrame) -> DataFrame:
    """(acq_date, mean_cloud, n_items): clouds that are known are averaged; very cloudy if none is."""
    return scenes.groupBy("acq_date").agg(F.coalesce(F.avg("cloud"), F.lit(NO_CLOUD_KNOWN)).alias("mean_cloud"), F.count(F.lit(1)).alias("n_items"))


def footprint_coverage(scenes: DataFrame, cells: DataFrame, least: float = 0.999) -> DataFrame:
    """(acq_date, ratio, covers): the share of an area's cells (cell_x, cell_y: unit squares) in the union of each date's footprints.

    Exact where footprints end on cell edges.
    """
    area = cells.select("cell_x", "cell_y").distinct()
    n, *around = area.agg(F.count(F.lit(1)), F.min("cell_x"), F.max("cell_x"), F.min("cell_y"), F.max("cell_y")).first()
    if not n:
        return scenes.select("acq_date", F.lit(None).cast("double").alias("ratio"), F.lit(None).cast("boolean").alias("covers")).where("false")
    # Whole cells of each footprint, those within the area's box; each box of a date once, and each cell before it meets the area.
    span = {f"{k}_{c}": v for c, low, high in (("x", *around[:2]), ("y", *around[2:])) for k, v in (("low", F.greatest(F.ceil(f"{c}min"), F.lit(low))), ("high", F.least(F.floor(f"{c}max") - 1, F.lit(high))))}
    boxes = scenes.dropna(subset=list(BOX)).select("acq_date", *[v.alias(k) for k, v in span.items()]).where("low_x <= high_x and low_y <= high_y").distinct()
    whole = boxes.withColumn("cell_x", F.explode(F.sequence("low_x", "high_x"))).select("acq_date", "cell_x", F.explode(F.sequence("low_y", "high_y")).alias("cell_y")).distinct()
    hit = whole.join(few(area), ["cell_x", "cell_y"]).groupBy("acq_date").agg(F.count(F.lit(1)).alias("hit"))
    return hit.select("acq_date", (F.col("hit") / F.lit(n)).alias("ratio")).withColumn("covers", F.col("ratio") >= least)


def ranked_dates(dates: DataFrame, target: str, as_of: str | None = None) -> DataFrame:
    """dates with day_delta and rank: nearest to the target first, then the less cloudy, then the earlier. Dates after as_of are left out."""
    out = dates if as_of is None else dates.where(F.col("acq_date") <= F.lit(as_of).cast("date"))
    out = out.withColumn("day_delta", F.abs(F.datediff("acq_date", F.lit(target).cast("date"))))
    return out.withColumn("rank", F.row_number().over(Window.orderBy("day_delta", "mean_cloud", "acq_date")))


def nearest_dates(dates: DataFrame, targets: DataFrame, days: int = 30) -> DataFrame:
    """(target, acq_date): for each target date the nearest date in the window, the less cloudy and the earlier of equals.

    A key of 2 x days + 1 days makes the window an equality; dates near its ends go to both sides.
    """
    step = 2 * days + 1
    day = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    left = targets.select("target").distinct().withColumn("key", F.explode(F.expr(f"sequence(floor((datediff(target, date'1970-01-01') - {days}) / {step}), floor((datediff(target, date'1970-01-01') + {days}) / {step}))")))
    right = dates.withColumn("key", F.floor(day("acq_date") / step))
    met = left.join(right, "key").withColumn("day_delta", F.abs(F.datediff("acq_date", "target"))).where(F.col("day_delta") <= days)
    return met.groupBy("target").agg(F.min_by("acq_date", F.struct("day_delta", "mean_cloud", "acq_date")).alias("acq_date"))


def day_scan_order(targets: DataFrame, days: int) -> DataFrame:
    """(target, day, place): the target day, then a day before and after, and so on."""
    out = targets.select("target", F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("d")).withColumn("day", F.date_add("target", F.col("d")))
    return out.withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy(F.abs("d"), "d"))).drop("d")
