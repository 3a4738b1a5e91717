"""Rasters with their grids as data: pixels of many grids in one table, and a row for each grid.

A grid has (grid_id, crs, x0, y0, dx, dy, width, height): its system, its corner before the first row
and column, the steps to the next column and row (dy below 0 where rows go south), and its size.
Pixels have (grid_id, row, col) and values. No operator here takes a step, an offset or a ratio.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs

GRID = ("grid_id", "crs", "x0", "y0", "dx", "dy", "width", "height")
#: Grids, at most so many, that are sent to all tasks; beyond it the join shuffles.
FEW = 200_000
#: Cells of a band of a grid's rows, of one row at least, and of a task that makes cells; tasks at most.
BAND, CELLS_A_TASK, MOST_TASKS = 65_536, 200_000, 20_000
#: Source cells across a block. Sources of fewer cells across and down are one block each, which is met before cells are made.
BLOCK = 16


@dataclass(frozen=True)
class Layer:
    """pixels (grid_id, row, col, values) and grids (GRID, and what else a source says of them)."""

    pixels: DataFrame
    grids: DataFrame


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """df marked for broadcast if it has at most so many rows, else for a join by sorting.

    Left to itself Spark goes by the size of files, and takes grids with all their cells for as small as the grids' file.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("merge")


def tasks(count: float, rows: int) -> int:
    """How many tasks of about so many rows that is."""
    return min(max(math.ceil(count / rows), 1), MOST_TASKS)


def dealt(df: DataFrame, rows: int, *names: str) -> DataFrame:
    """df dealt out by some columns over tasks of about so many rows, however few files or bytes it is."""
    return df.repartition(tasks(df.count(), rows), *names)


def _area() -> Column:
    """The number of cells of all grids of a group; sizes of 0 or less are none."""
    return F.coalesce(F.sum(F.when(F.expr("width > 0 and height > 0"), F.col("width").cast("double") * F.col("height"))), F.lit(0.0))


def _all_cells(grids: DataFrame, *names: str, beside: DataFrame | None = None, total: float | None = None) -> DataFrame:
    """grids with row and col: a row for each cell. Bands of rows are dealt out by these columns first, as a file of many grids may be one task.

    Columns of ``beside``, one row for a source_id at most, come along; it is met before there are cells. Cells are counted, unless their ``total`` is known.
    """
    width, height = F.col("width").cast("long"), F.col("height").cast("long")
    total = grids.agg(_area()).first()[0] if total is None else total
    some = grids.where("width > 0 and height > 0")
    some = some if beside is None else some.join(beside.hint("merge"), "source_id", "left")
    high = F.greatest(F.floor(F.lit(BAND) / width), F.lit(1)).cast("long")
    bands = some.withColumn("high", high).withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((height - 1) / F.col("high")))))
    dealt = bands.repartition(tasks(total, CELLS_A_TASK), *names, "band")
    row = F.sequence(F.col("band") * F.col("high"), F.least((F.col("band") + 1) * F.col("high"), height) - 1)
    return dealt.withColumn("row", F.explode(row)).withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), width - 1))).drop("high", "band")


def cells(grids: DataFrame) -> DataFrame:
    """(grid_id, row, col): all cells of the grids."""
    return _all_cells(grids, "grid_id").select("grid_id", "row", "col")


def centre(row: Column, col: Column) -> tuple[Column, Column]:
    """The middle of a cell, by the columns x0, y0, dx and dy."""
    return F.col("x0") + (col + 0.5) * F.col("dx"), F.col("y0") + (row + 0.5) * F.col("dy")


def _paired(sources: DataFrame, target: DataFrame) -> DataFrame:
    """(target_id, the target's grid, source_id, taken, s_crs … s_height, ord): a row for each target and source of it; without a source one of NULLs."""
    source = sources.select("target_id", F.col("grid_id").alias("source_id"), *[F.col(c).alias(f"s_{c}") for c in GRID[1:]], "ord", F.lit(True).alias("taken"))
    return target.select(F.col("grid_id").alias("target_id"), *GRID[1:]).join(few(source), "target_id", "left")


def _carried(pairs: DataFrame, whole: DataFrame) -> tuple[list[DataFrame], DataFrame | None, int]:
    """(target_id, row, col, source_id, ord, place_x, place_y): where the middle of each target cell lies in each of its sources, in cells from the corner.

    Places outside a source are NULL. Sources of one block have it in ``block``, from ``whole``; those of more cells are a table without it.
    Apart from them (target_id, row, col), the cells of targets without a source, and the number of pairs. One job looks at all pairs.
    Systems differ from grid to grid; for each pair of systems that occurs, a few at most, one projection of all its cells.
    """
    one = F.coalesce((F.col("s_width") < BLOCK) & (F.col("s_height") < BLOCK), F.lit(False))
    kinds = pairs.groupBy("taken", "crs", "s_crs", one.alias("one")).agg(_area().alias("total"), F.count("*").alias("pairs")).sort("taken", "crs", "s_crs", "one").collect()  # at most the known systems, squared, twice
    x, y = centre(F.col("row"), F.col("col"))
    placed = []
    for to, of, is_one, total in [(k["crs"], k["s_crs"], k["one"], k["total"]) for k in kinds if k["taken"]]:
        some = pairs.where(F.col("crs").eqNullSafe(to) & F.col("s_crs").eqNullSafe(of) & F.col("taken") & (one == is_one))
        some = _all_cells(some, "target_id", "source_id", beside=whole if is_one else None, total=total)
        moved = crs.with_transformed(some.withColumns({"px": x, "py": y}), "px", "py", to, of, "sx", "sy")
        u, v = (F.col("sx") - F.col("s_x0")) / F.col("s_dx"), (F.col("sy") - F.col("s_y0")) / F.col("s_dy")
        inside = (u >= 0) & (v >= 0) & (u < F.col("s_width")) & (v < F.col("s_height"))
        placed.append(moved.select("target_id", "row", "col", "source_id", "ord", F.when(inside, u).alias("place_x"), F.when(inside, v).alias("place_y"), *["block"] * is_one))
    alone = [k["total"] for k in kinds if not k["taken"]]
    rest = _all_cells(pairs.where("taken is null"), "target_id", total=sum(alone)).select("target_id", "row", "col") if not placed or alone else None
    return placed, rest, sum(k["pairs"] for k in kinds)


def _merged(pixels: DataFrame, values: list[str], how: str) -> tuple[DataFrame, Column]:
    """Pixels of which each place is there once, and what is kept of it: the largest of its values for nearest, their sum and number for bilinear."""
    kept = {v: F.max(v) for v in values} if how == "nearest" else {f"{name}_{v}": f(v) for v in values for name, f in (("sum", F.sum), ("n", F.count))}
    return pixels.groupBy("source_id", "source_row", "source_col").agg(*[c.alias(name) for name, c in kept.items()]), F.struct(*kept)


def _in_block(row: Column, col: Column, block_row: Column | int = 0, block_col: Column | int = 0) -> Column:
    """The place of a cell in a block, of which the first row and column are those before its own first cell."""
    return ((row + 1 - block_row * BLOCK) * (BLOCK + 1) + col + 1 - block_col * BLOCK).cast("int")


def _whole(pixels: DataFrame, values: list[str], how: str) -> DataFrame:
    """(source_id, block): what is kept of each pixel by place, for the first block of each source; for nearest apart for each value."""
    merged, kept = _merged(pixels.where(F.col("source_row").between(-1, BLOCK - 1) & F.col("source_col").between(-1, BLOCK - 1)), values, how)
    by_place = lambda c: F.map_from_entries(F.collect_list(F.struct(_in_block(F.col("source_row"), F.col("source_col")), c)))
    block = F.struct(*[by_place(F.col(v)).alias(v) for v in values]) if how == "nearest" else by_place(kept)
    return merged.groupBy("source_id").agg(block.alias("block"))


def _blocks(pixels: DataFrame, values: list[str]) -> DataFrame:
    """(source_id, block_row, block_col, block): sums and numbers of values by place, for blocks of cells with the cells about them.

    Cell r stands where it is the first or the second of two neighbours: r or r + 1, counted from the pair before the first row.
    """
    sums, kept = _merged(pixels, values, "bilinear")
    of = lambda c: F.explode(F.array_distinct(F.array(*[F.floor((F.col(c) + k) / BLOCK).cast("long") for k in (0, 1)])))
    at = sums.withColumn("block_row", of("source_row")).withColumn("block_col", of("source_col"))
    entry = F.struct(_in_block(*map(F.col, ("source_row", "source_col", "block_row", "block_col"))), kept)
    return at.groupBy("source_id", "block_row", "block_col").agg(F.map_from_entries(F.collect_list(entry)).alias("block"))


def _nearest(carried: DataFrame, pixels: DataFrame, values: list[str]) -> DataFrame:
    placed = carried.withColumns({"source_row": F.floor("place_y").cast("long"), "source_col": F.floor("place_x").cast("long")})
    if "block" in carried.columns:
        place = _in_block(F.col("source_row"), F.col("source_col"))
        return placed.select("target_id", "row", "col", "ord", *[F.col("block")[v][place].alias(v) for v in values])
    once, _ = _merged(pixels, values, "nearest")
    return placed.join(once.hint("merge"), ["source_id", "source_row", "source_col"], "left").select("target_id", "row", "col", "ord", *values)


def _bilinear(carried: DataFrame, pixels: DataFrame, values: list[str]) -> DataFrame:
    first = {"first_row": (F.floor(F.col("place_y") - 0.5) + 1).cast("long"), "first_col": (F.floor(F.col("place_x") - 0.5) + 1).cast("long")}
    block = lambda c: F.floor(F.col(c) / BLOCK).cast("long")
    placed = carried.withColumns(first).withColumns({"block_row": block("first_row"), "block_col": block("first_col")})
    met = placed if "block" in carried.columns else placed.join(_blocks(pixels, values).hint("merge"), ["source_id", "block_row", "block_col"], "left")
    past = lambda c: F.col(c) - 0.5 - F.floor(F.col(c) - 0.5)
    near = lambda c, k: past(c) if k else 1 - past(c)
    at = lambda j, i: _in_block(F.col("first_row") + j - 1, F.col("first_col") + i - 1, F.col("block_row"), F.col("block_col"))
    four = [(near("place_x", i) * near("place_y", j), F.col("block")[at(j, i)]) for i in (0, 1) for j in (0, 1)]
    total = lambda name: reduce(lambda a, b: a + b, [F.coalesce(weight * found[name], F.lit(0.0)) for weight, found in four])
    return met.select("target_id", "row", "col", "ord", *[F.try_divide(total(f"sum_{v}"), total(f"n_{v}")).alias(v) for v in values])


def _taken_from(source: Layer, target: DataFrame) -> DataFrame:
    """The source's grids with target_id and ord: as they say, or each for every target there is if that is one."""
    grids = source.grids
    if "target_id" not in grids.columns:
        grids = grids.crossJoin(F.broadcast(target.select(F.col("grid_id").alias("target_id")).limit(2)))  # one row, or an error
        one = target.limit(2).count()
        if one > 1:
            raise ValueError("with several target grids the source's grids need a target_id")
    return grids if "ord" in grids.columns else grids.withColumn("ord", F.col("grid_id"))


def reproject(source: Layer, target: DataFrame, values: list[str], how: str = "nearest") -> Layer:
    """The source's values on the target grids, whatever the systems of both: every target cell, NULL where the source has none.

    The middle of each target cell is carried into the source's system. ``nearest`` takes the cell in which it lies, ``bilinear``
    the four about it, by nearness, those without a value left out; what lies outside a source grid takes nothing from it.
    Each source grid goes to the target grid that its ``target_id`` names. Of several the first in ``ord`` that has the value
    counts (so a layer of tiles is merged on the way). The source cell is computed, so the join is an equality; grids of less than
    a block meet whole before their cells are made, so that no cell is shuffled. Repeated pixels
    of a grid: the largest of each value for nearest, their mean for bilinear. Empty tables give NULLs or no rows.
    """
    if how not in ("nearest", "bilinear"):
        raise ValueError(f"{how} is neither nearest nor bilinear")
    sources = _taken_from(source, target)
    pixels = source.pixels.select(F.col("grid_id").alias("source_id"), F.col("row").cast("long").alias("source_row"), F.col("col").cast("long").alias("source_col"), *values)
    carried, rest, pairs = _carried(_paired(sources, target), _whole(pixels, values, how))
    sample = _nearest if how == "nearest" else _bilinear
    cell, out = ["target_id", "row", "col"], []
    if carried:
        if pairs > target.count():  # a target has a pair of its own without a source, so some target has several
            met = reduce(DataFrame.unionByName, [sample(some.where("place_x is not null"), pixels, values) for some in carried])
            sampled = met.groupBy(*cell).agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), F.col("ord"))).alias(v) for v in values])
            every = cells(target.join(few(sources.select(F.col("target_id").alias("grid_id")).distinct()), "grid_id", "left_semi")).withColumnRenamed("grid_id", "target_id")
            out.append(every.join(sampled.hint("merge"), cell, "left"))
        else:
            out += [sample(some, pixels, values) for some in carried]
    if rest is not None:
        like = out[0].schema if out else None
        out.append(rest.select(*cell, *[F.lit(None).cast(like[v].dataType if like else "double").alias(v) for v in values]))
    every = reduce(DataFrame.unionByName, [df.select(*cell, *values) for df in out])
    return Layer(every.withColumnRenamed("target_id", "grid_id"), target)


def mosaic(tiles: Layer, values: list[str], by: str | None = None, order: str = "grid_id") -> Layer:
    """Tiles placed by their own corners on the grid around all of them: each cell from the first tile, in order, that has the value.

    Tiles of one mosaic (``by``, a column of the grids; all are one without it) share a system and steps, else it is an error.
    Corners may be off the common steps by less than half a cell. Cells that no tile covers, or only without a value, are left out.
    """
    key = F.col(by) if by else F.lit("mosaic")
    placed = tiles.grids.withColumn("mosaic_id", key.cast("string"))
    far = lambda start, step, n: F.col(start) + F.col(step) * F.col(n)
    corner = lambda start, step, n: F.when(F.min(step) > 0, F.min(F.least(F.col(start), far(start, step, n)))).otherwise(F.max(F.greatest(F.col(start), far(start, step, n))))
    end = lambda start, step, n: F.when(F.min(step) > 0, F.max(far(start, step, n))).otherwise(F.min(far(start, step, n)))
    # The corners carry the check, as nothing reads the pixels of a mosaic without them.
    unlike = F.when(F.min("crs") != F.max("crs"), "crs").when(F.min("dx") != F.max("dx"), "dx").when(F.min("dy") != F.max("dy"), "dy")
    checked = lambda c: F.when(unlike.isNull(), c).otherwise(F.raise_error(F.concat(F.lit("tiles of one mosaic differ in "), unlike)).cast("double"))
    ends = [end("x0", "dx", "width").alias("x1"), end("y0", "dy", "height").alias("y1")]
    common = placed.groupBy("mosaic_id").agg(F.min("crs").alias("crs"), checked(corner("x0", "dx", "width")).alias("x0"), checked(corner("y0", "dy", "height")).alias("y0"), F.min("dx").alias("dx"), F.min("dy").alias("dy"), *ends)
    common = common.select(F.col("mosaic_id").alias("grid_id"), "crs", "x0", "y0", "dx", "dy", F.round((F.col("x1") - F.col("x0")) / F.col("dx")).cast("long").alias("width"), F.round((F.col("y1") - F.col("y0")) / F.col("dy")).cast("long").alias("height"))
    start = few(common.select(F.col("grid_id").alias("mosaic_id"), F.col("x0").alias("m_x0"), F.col("y0").alias("m_y0")))
    shift = placed.join(start, "mosaic_id").select("grid_id", "mosaic_id", F.col(order).alias("ord"), F.round((F.col("x0") - F.col("m_x0")) / F.col("dx")).cast("long").alias("right"), F.round((F.col("y0") - F.col("m_y0")) / F.col("dy")).cast("long").alias("down"))
    moved = tiles.pixels.join(few(shift), "grid_id").select(F.col("mosaic_id").alias("grid_id"), (F.col("row") + F.col("down")).alias("row"), (F.col("col") + F.col("right")).alias("col"), "ord", *values)
    some = F.coalesce(*[F.when(F.col(v).isNotNull(), 1) for v in values]).isNotNull()
    merged = moved.where(some).groupBy("grid_id", "row", "col").agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), F.col("ord"))).alias(v) for v in values])
    return Layer(merged, common)


def north_up(layer: Layer) -> Layer:
    """The layer with rows from north to south: grids whose dy is above 0 are turned."""
    turned = F.col("dy") > 0
    grids = layer.grids.withColumns({"y0": F.when(turned, F.col("y0") + F.col("height") * F.col("dy")).otherwise(F.col("y0")), "dy": -F.abs("dy")})
    height = few(layer.grids.where(turned).select("grid_id", F.col("height").alias("turned_height")))
    pixels = layer.pixels.join(height, "grid_id", "left").withColumn("row", F.coalesce(F.col("turned_height") - 1 - F.col("row"), F.col("row")).cast("long"))
    return Layer(pixels.drop("turned_height").select(*layer.pixels.columns), grids)


def boxes(grids: DataFrame) -> DataFrame:
    """grids with xmin … ymax."""
    x1, y1 = F.col("x0") + F.col("dx") * F.col("width"), F.col("y0") + F.col("dy") * F.col("height")
    return grids.withColumns({"xmin": F.least("x0", x1), "ymin": F.least("y0", y1), "xmax": F.greatest("x0", x1), "ymax": F.greatest("y0", y1)})


def native(grids: DataFrame, target: str) -> DataFrame:
    """The grids in a target system, width and height kept: the box of points along their edges, and rows from north to south."""
    from .rasters import native_grid

    sources, out = [r[0] for r in grids.select("crs").distinct().sort("crs").collect()], None  # at most the known systems
    for source in sources:
        moved = native_grid(boxes(grids.where(F.col("crs") == source)), source, target)
        out = moved if out is None else out.unionByName(moved)
    if out is None:
        return grids.select(*GRID)
    return out.select("grid_id", F.lit(target).alias("crs"), "x0", "y0", "dx", (-F.col("dy")).alias("dy"), "width", "height")
