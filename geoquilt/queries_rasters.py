"""Queries over observations: filters, masks, indices, composites, cover, colour, mosaics and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import dates, spectral
from .operators import observations as ob
from .operators import rasters as ra
from .plans import plugins
from .registry import query, rounded
from .sources.views import aoi, view

SUMMER = ("1996-06-01", "1996-08-31")
SUMMER_SQL = "obs_date between date '1996-06-01' and date '1996-08-31'"
MASKED_SQL = "scl in (0, 1, 3, 8, 9, 10, 11)"
BANDS = list(ob.BANDS)


def keep(b: str) -> str:
    return f"case when {MASKED_SQL} then null else {b} end"


def summer(spark, d, bands=("b02", "b04", "b08", "b11"), cloud=40.0):
    return ob.mask_classes(ob.scan(view(spark, d, "obs"), list(bands), *SUMMER, max_cloud=cloud), list(bands))


SUMMER_MEDIANS = "select row, col, " + ", ".join(f"median({keep(b)}) as {b}" for b in ("b02", "b04", "b08", "b11")) + f" from obs where {SUMMER_SQL} and cloud < 40 group by row, col"


@query("flagship_ndvi_summer", "select row, col, round((b08 - b04) / nullif(b08 + b04, 0), 9) as ndvi from medians", medians=SUMMER_MEDIANS)
def flagship_ndvi_summer(spark, d):
    return rounded(ob.index_composite(summer(spark, d, ("b04", "b08")), ["ndvi"]), "ndvi")


@query("s2_cube_scan", f"select obs_id, row, col, cast(obs_date as varchar) as obs_date, b04, b08, scl, cloud from obs where {SUMMER_SQL} and cloud < 40 and col + 0.5 between 4 and 12 and row + 0.5 between 4 and 12")
def s2_cube_scan(spark, d):
    return ob.scan(view(spark, d, "obs"), ["b04", "b08"], *SUMMER, box=(4, 4, 12, 12), max_cloud=40.0).withColumn("obs_date", F.col("obs_date").cast("string"))


@query("p5_bbox_filter", "select obs_id from obs, (select min(least(x1, x2)) as x0, max(greatest(x1, x2)) as x1, min(least(y1, y2)) as y0, max(greatest(y1, y2)) as y1 from aoi_b) b where col + 0.5 between b.x0 and b.x1 and row + 0.5 between b.y0 and b.y1")
def p5_bbox_filter(spark, d):
    corner = aoi(spark, "B").select(F.explode("ring").alias("p")).agg(F.min("p.x").alias("x0"), F.max("p.x").alias("x1"), F.min("p.y").alias("y0"), F.max("p.y").alias("y1"))
    box = corner.first()  # four numbers
    return view(spark, d, "obs").where((F.col("col") + 0.5).between(box.x0, box.x1) & (F.col("row") + 0.5).between(box.y0, box.y1)).select("obs_id")


@query("p7_scl_mask", "select obs_id, " + ", ".join(f"{keep(b)} as {b}" for b in BANDS) + " from obs")
def p7_scl_mask(spark, d):
    return ob.mask_classes(view(spark, d, "obs"), BANDS).select("obs_id", *BANDS)


@query("p8_band_select", "select obs_id, b02, b04, b08, b11 from obs")
def p8_band_select(spark, d):
    return view(spark, d, "obs").select("obs_id", *spectral.required_bands(["bsi", "msi"]))


@query("p9_ndvi", "select obs_id, round((b08 - b04) / nullif(b08 + b04, 0), 9) as ndvi from obs")
def p9_ndvi(spark, d):
    return rounded(view(spark, d, "obs").select("obs_id", spectral.ndvi().alias("ndvi")), "ndvi")


@query("p10_ndmi", "select obs_id, round((b08 - b11) / nullif(b08 + b11, 0), 9) as ndmi from obs")
def p10_ndmi(spark, d):
    return rounded(view(spark, d, "obs").select("obs_id", spectral.ndmi().alias("ndmi")), "ndmi")


@query("p11_msi", "select obs_id, round(b11 / nullif(b08, 0), 9) as msi from obs")
def p11_msi(spark, d):
    return rounded(view(spark, d, "obs").select("obs_id", spectral.msi().alias("msi")), "msi")


@query("p12_bsi", "select obs_id, round(((b11 + b04) - (b08 + b02)) / nullif((b11 + b04) + (b08 + b02), 0), 9) as bsi from obs")
def p12_bsi(spark, d):
    return rounded(view(spark, d, "obs").select("obs_id", spectral.bsi().alias("bsi")), "bsi")


@query(
    "p13_multi_index",
    """, wide as (select row, col, (b08 - b11) / nullif(b08 + b11, 0) as ndmi, b11 / nullif(b08, 0) as msi, ((b11 + b04) - (b08 + b02)) / nullif((b11 + b04) + (b08 + b02), 0) as bsi from medians)
select row, col, 'ndmi' as variable, 1 as band, round(ndmi, 9) as value from wide union all select row, col, 'msi', 2, round(msi, 9) from wide union all select row, col, 'bsi', 3, round(bsi, 9) from wide""",
    medians=SUMMER_MEDIANS,
)
def p13_multi_index(spark, d):
    names = ["ndmi", "msi", "bsi"]
    wide = ob.index_composite(summer(spark, d), names)
    long = wide.unpivot(["row", "col"], names, "variable", "value")
    return rounded(long.withColumn("band", F.array_position(F.array(*map(F.lit, names)), F.col("variable")).cast("int")), "value")


NDVI_OF_EACH = f"select row, col, median(({keep('b08')} - b04) / nullif(b08 + b04, 0)) as ndvi from obs where {SUMMER_SQL} and cloud < 40 group by row, col"


@query("p14_fvc", ", p as (select quantile_cont(ndvi, 0.05) as lo, quantile_cont(ndvi, 0.95) as hi from each_ndvi) select row, col, round(greatest(0, least(1, (ndvi - lo) / (hi - lo))), 9) as fvc from each_ndvi, p where ndvi is not null union all select row, col, null from each_ndvi where ndvi is null", each_ndvi=NDVI_OF_EACH)
def p14_fvc(spark, d):
    return rounded(ob.fractional_cover(ob.median_of_index(summer(spark, d, ("b04", "b08")), "ndvi")).select("row", "col", "fvc"), "fvc")


@query("p15_nodata_std", "select obs_id, coalesce(b04, -9999.0) as b04, case when b02 = 200 then null else b02 end as b02 from obs")
def p15_nodata_std(spark, d):
    obs = view(spark, d, "obs").withColumn("b02", F.when(F.col("b02") == 200, spectral.NODATA).otherwise(F.col("b02")))
    return obs.select("obs_id", spectral.null_to_missing("b04").alias("b04"), spectral.missing_to_null("b02").alias("b02"))


@query("p16_scale_reflectance", "select obs_id, round(b04 / 10000, 9) as b04, round(b03 / 10000, 9) as b03, round(b02 / 10000, 9) as b02 from obs")
def p16_scale_reflectance(spark, d):
    bands = ["b04", "b03", "b02"]
    return rounded(ob.scale_reflectance(view(spark, d, "obs"), bands).select("obs_id", *bands), *bands)


TONE = "(power({x} + 0.01e0, 2.3e0) - power(0.01e0, 2.3e0)) / (power(1.01e0, 2.3e0) - power(0.01e0, 2.3e0))"


def _tone_sql(band: str, haze: float) -> str:
    x = f"greatest(0e0, least(1e0, ({band} / 10000 - {haze}e0) / 3e0))"
    t = "(0.13e0 / 3e0)"
    return TONE.format(x=f"({x} * ({x} * {t} - 1e0) / ({x} * (2e0 * {t} - 1e0) - {t}))")


COLOR_SQL = (
    f"select obs_id, b02, b03, b04, {_tone_sql('b04', 0.013)} as r, {_tone_sql('b03', 0.024)} as g, {_tone_sql('b02', 0.041)} as b from obs where {SUMMER_SQL}"
)
SRGB = "case when {x} <= 0.0031308e0 then 12.92e0 * {x} else 1.055e0 * power({x}, 0.41666666666e0) - 0.055e0 end"
SATURATED = "select obs_id, " + ", ".join(f"greatest(0e0, least(1e0, (r + g + b) / 3e0 * (1e0 - 1.3e0) + {c} * 1.3e0)) as {c}" for c in "rgb") + " from toned"


@query("p17_true_color", "select obs_id, " + ", ".join(f"round({SRGB.format(x=c)}, 9) as {c}" for c in "rgb") + " from saturated", toned=COLOR_SQL, saturated=SATURATED)
def p17_true_color(spark, d):
    obs = ob.scan(view(spark, d, "obs"), ["b02", "b03", "b04"], *SUMMER)
    reflectance = [F.col(b) / 10000.0 for b in ("b04", "b03", "b02")]
    return rounded(obs.select("obs_id", *[x.alias(k) for k, x in spectral.true_color(*reflectance).items()]), "r", "g", "b")


FIRST_SQL = f"select row, col, min_by(struct_pack(b02 := b02, b03 := b03, b04 := b04), (obs_date, obs_id)) as s from obs where {SUMMER_SQL} group by row, col"
FIRST_TONES = "select row, col, s.b02 as b02, s.b03 as b03, s.b04 as b04, " + f"{_tone_sql('s.b04', 0.013)} as r, {_tone_sql('s.b03', 0.024)} as g, {_tone_sql('s.b02', 0.041)} as b from firsts"
FIRST_SATURATED = "select row, col, b02, b03, b04, " + ", ".join(f"greatest(0e0, least(1e0, (r + g + b) / 3e0 * (1e0 - 1.3e0) + {c} * 1.3e0)) as {c}" for c in "rgb") + " from first_tones"


@query(
    "p18_rgba8",
    "select row, col, " + ", ".join(f"cast(case when b02 is null or b03 is null or b04 is null then 0 else round_even(greatest(0e0, least(1e0, {SRGB.format(x=c)})) * 255, 0) end as smallint) as {c}" for c in "rgb") + ", cast(case when b02 is null or b03 is null or b04 is null then 0 else 255 end as smallint) as a from first_saturated",
    firsts=FIRST_SQL, first_tones=FIRST_TONES, first_saturated=FIRST_SATURATED,
)
def p18_rgba8(spark, d):
    bands = ["b02", "b03", "b04"]
    first = ob.composite(ob.scan(view(spark, d, "obs"), bands, *SUMMER), bands, "first")
    return ob.rgba(ob.scale_reflectance(first, bands))


@query("p19_landcover_recode", "select row, col, cast(case when cls is null or cls = 0 then -9999 else cls end as integer) as cls from lc")
def p19_landcover_recode(spark, d):
    return ra.recode_landcover(view(spark, d, "lc"), "cls")


@query("p20_dim_normalize", "select row as y, col as x, cls as value from lc")
def p20_dim_normalize(spark, d):
    """A raster whose last two dimensions have other names and whose only band is a dimension too."""
    raster = view(spark, d, "lc").withColumnsRenamed({"row": "latitude", "col": "longitude", "cls": "value"}).withColumn("band", F.lit(1))
    return ra.normalize_dims(raster, ["band", "latitude", "longitude"])


@query("p21_north_up", "select tile_ord, case when tile_ord % 2 = 1 then 19 - row else row end as row, col, v, cast(case when tile_ord % 2 = 1 then 100 + 20 * 10 else 300 end as double) as y0, cast(-10 as double) as dy from tile_px")
def p21_north_up(spark, d):
    px = view(spark, d, "tile_px").withColumn("grid_id", F.col("tile_ord"))
    south = F.col("grid_id") % 2 == 1
    grid = px.select("grid_id").distinct().select("grid_id", F.lit(20).alias("height"), F.when(south, 100.0).otherwise(300.0).alias("y0"), F.when(south, 10.0).otherwise(-10.0).alias("dy"))
    return ra.north_up(px, grid).select("tile_ord", F.col("row").cast("long").alias("row"), "col", "v", "y0", "dy")


@query("a1_median_composite", "select row, col, b02, b04, b08, b11 from medians", medians=SUMMER_MEDIANS)
def a1_median_composite(spark, d):
    return ob.composite(summer(spark, d), ["b02", "b04", "b08", "b11"])


@query("a2_median_of_index", "select row, col, round(ndvi, 9) as ndvi from each_ndvi", each_ndvi=NDVI_OF_EACH)
def a2_median_of_index(spark, d):
    return rounded(ob.median_of_index(summer(spark, d, ("b04", "b08")), "ndvi"), "ndvi")


@query("a3_temporal_agg", f"select row, col, round(avg(b04), 9) as mean_b04, round(median(b04), 9) as median_b04, round(avg(case when obs_date = date '1996-07-16' then b04 end), 9) as dated_b04 from obs where {SUMMER_SQL} group by row, col")
def a3_temporal_agg(spark, d):
    """Mean, median, and a named date, which goes before any aggregate."""
    obs = ob.scan(view(spark, d, "obs"), ["b04"], *SUMMER)
    return rounded(ob.reduced(obs, "b04", {"mean_b04": "mean", "median_b04": "median", "dated_b04": "1996-07-16"}), "mean_b04", "median_b04", "dated_b04")


@query("a4_first_in_time", "select row, col, arg_min(struct_pack(b04 := b04, b08 := b08), (obs_date, obs_id)).b04 as b04, arg_min(struct_pack(b04 := b04, b08 := b08), (obs_date, obs_id)).b08 as b08 from obs group by row, col")
def a4_first_in_time(spark, d):
    return ob.composite(view(spark, d, "obs"), ["b04", "b08"], "first")


@query("a5_aoi_percentiles", "select round(quantile_cont(ndvi, 0.05), 9) as low, round(quantile_cont(ndvi, 0.95), 9) as high from each_ndvi", each_ndvi=NDVI_OF_EACH)
def a5_aoi_percentiles(spark, d):
    return rounded(ob.percentiles(ob.median_of_index(summer(spark, d, ("b04", "b08")), "ndvi"), "ndvi"), "low", "high")


INSIDE_E = "col + 0.5 between 2 and 16 and row + 0.5 between 2 and 14"


@query("a6_coverage_ratio", f"select count(*) as inside, count(*) filter (where b04 is not null and b08 is not null) as valid, round(coalesce(count(*) filter (where b04 is not null and b08 is not null) / nullif(cast(count(*) as double), 0), 0), 9) as ratio from medians where {INSIDE_E}", medians=SUMMER_MEDIANS)
def a6_coverage_ratio(spark, d):
    inside = ra.clip(ob.composite(summer(spark, d), ["b04", "b08"]), aoi(spark, "E"))
    return rounded(ob.coverage(inside, spectral.all_valid("b04", "b08")).select("inside", "valid", "ratio"), "ratio")


@query("a7_full_coverage", f"select obs_date_s as obs_date, bool_and(b04 is not null) as complete from (select cast(obs_date as varchar) as obs_date_s, b04 from obs where {INSIDE_E}) group by obs_date_s")
def a7_full_coverage(spark, d):
    inside = ra.clip(view(spark, d, "obs"), aoi(spark, "E"))
    return inside.groupBy(F.col("obs_date").cast("string").alias("obs_date")).agg(F.bool_and(spectral.all_valid("b04")).alias("complete"))


@query("a12_valid_all_bands", "select obs_id, b02 is not null and b03 is not null and b04 is not null and b08 is not null and b11 is not null as valid from obs")
def a12_valid_all_bands(spark, d):
    return view(spark, d, "obs").select("obs_id", spectral.all_valid(*BANDS).alias("valid"))


@query("a14_valid_max", "select max(greatest(b02, b03, b04)) as most from obs where b02 is not null and b03 is not null and b04 is not null")
def a14_valid_max(spark, d):
    return view(spark, d, "obs").where(spectral.all_valid("b02", "b03", "b04")).agg(F.max(F.greatest("b02", "b03", "b04")).alias("most"))


@query("j2_pixels_in_aoi", "select row, col, count(*) as n from obs where (select count(*) from aoi_b e where (e.y1 > row + 0.5) <> (e.y2 > row + 0.5) and col + 0.5 < (e.x2 - e.x1) * (row + 0.5 - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1 group by row, col")
def j2_pixels_in_aoi(spark, d):
    return ra.clip(view(spark, d, "obs"), aoi(spark, "B")).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))


FINE = "select row, col, avg(b08) as b08 from obs group by row, col"
COARSE = "select row // 2 as row, col // 2 as col, avg(b11) as b11 from obs group by row // 2, col // 2"


@query("j7_grid_align", "select c.row, c.col, round((f.b08 - c.b11) / nullif(f.b08 + c.b11, 0), 9) as ndmi from coarse c left join fine f on f.row = cast(floor((c.row + 0.5) * 2) as bigint) and f.col = cast(floor((c.col + 0.5) * 2) as bigint)", fine=FINE, coarse=COARSE)
def j7_grid_align(spark, d):
    obs = view(spark, d, "obs")
    fine = ob.composite(obs, ["b08"], "mean")
    coarse = obs.groupBy(F.expr("row div 2").alias("row"), F.expr("col div 2").alias("col")).agg(F.avg("b11").alias("b11"))
    return rounded(ra.resample_nearest(fine, coarse, 2.0, ["b08"]).select("row", "col", spectral.ndmi().alias("ndmi")), "ndmi")


@query("j8_cube_merge", ", a as (select row, col, median(b08) as b08 from obs where scl = 4 group by row, col), b as (select row, col, median(b11) as b11 from obs where scl = 5 group by row, col) select coalesce(a.row, b.row) as row, coalesce(a.col, b.col) as col, b08, b11 from a full outer join b on a.row = b.row and a.col = b.col")
def j8_cube_merge(spark, d):
    obs = view(spark, d, "obs")
    one, two = ob.composite(obs.where("scl = 4"), ["b08"]), ob.composite(obs.where("scl = 5"), ["b11"])
    return one.join(two, ["row", "col"], "full_outer")


TARGET = "select r.range as row, c.range as col from range(12) r, range(12) c"


@query("j9_reproject_nearest", "select t.row, t.col, l.cls from target t left join lc l on l.row = cast(floor(0.3 + (t.row + 0.5) * 1.7) as bigint) and l.col = cast(floor(0.3 + (t.col + 0.5) * 1.7) as bigint)", target=TARGET)
def j9_reproject_nearest(spark, d):
    return ra.reproject_nearest(view(spark, d, "lc"), ra.target_grid(spark, 12, 12), 1.7, 0.3, 0.3, "cls")


@query(
    "j10_reproject_bilinear",
    """, u as (select row, col, 0.3 + (col + 0.5) * 1.7 - 0.5 as u, 0.3 + (row + 0.5) * 1.7 - 0.5 as t from target),
four as (select row, col, cast(floor(u) as bigint) + i.range as sc, cast(floor(t) as bigint) + j.range as sr, (case when i.range = 1 then u - floor(u) else 1 - (u - floor(u)) end) * (case when j.range = 1 then t - floor(t) else 1 - (t - floor(t)) end) as w from u, range(2) i, range(2) j)
select four.row, four.col, round(cast(sum(w * v) / nullif(sum(case when v is not null then w end), 0) as double), 6) as v from four left join means m on m.row = sr and m.col = sc group by four.row, four.col""",
    target=TARGET, means="select row, col, avg(b04) as v from obs where row % 3 <> 0 group by row, col",
)
def j10_reproject_bilinear(spark, d):
    source = view(spark, d, "obs").where("row % 3 <> 0").groupBy("row", "col").agg(F.avg("b04").alias("v"))
    return ra.reproject_bilinear(source, ra.target_grid(spark, 12, 12), 1.7, 0.3, 0.3).withColumn("v", F.round("v", 6))


PER_DATE = f"select rank, row, col, max({keep('b04')}) as b04, max({keep('b08')}) as b08 from (select row, col, b04, b08, scl, dense_rank() over (order by obs_date) as rank from obs where obs_date between date '1996-07-01' and date '1996-07-20') group by rank, row, col"


def candidates(spark, d):
    obs = ob.mask_classes(ob.scan(view(spark, d, "obs"), ["b04", "b08"], "1996-07-01", "1996-07-20"), ["b04", "b08"])
    days = obs.groupBy("obs_date", "row", "col").agg(F.max("b04").alias("b04"), F.max("b08").alias("b08"))
    from pyspark.sql.window import Window

    order = days.select("obs_date").distinct().withColumn("rank", F.row_number().over(Window.orderBy("obs_date")))
    return days.join(F.broadcast(order), "obs_date").select("rank", "row", "col", "b04", "b08")


@query("w3_mosaic_fill", ", valid as (select row, col, min(rank) as rank from per_date where b04 is not null and b08 is not null group by row, col) select p.row, p.col, cast(v.rank as integer) as rank, c.b04, c.b08 from (select distinct row, col from per_date) p left join valid v on p.row = v.row and p.col = v.col left join per_date c on c.row = v.row and c.col = v.col and c.rank = v.rank", per_date=PER_DATE)
def w3_mosaic_fill(spark, d):
    return ob.mosaic(candidates(spark, d), ["b04", "b08"])


@query(
    "w4_mosaic_stop",
    """, v as (select distinct rank, row, col from per_date where b04 is not null and b08 is not null),
n as (select count(*) as n from (select distinct row, col from per_date)),
own as (select rank, count(*) as own from v group by rank),
fresh as (select rank, count(*) as new from (select row, col, min(rank) as rank from v group by row, col) group by rank),
steps as (select own.rank, own, sum(coalesce(new, 0)) over (order by own.rank) as covered, row_number() over (order by own.rank) as dates, n from own left join fresh on own.rank = fresh.rank, n)
select cast(rank as integer) as stop_rank, case when own >= n * 0.05 then 'single' else 'mosaic' end as kind, round(case when own >= n * 0.05 then own else covered end / cast(n as double), 9) as ratio
from steps where own >= n * 0.05 or covered >= n * 0.05 or dates >= 5 order by rank limit 1""",
    per_date=PER_DATE,
)
def w4_mosaic_stop(spark, d):
    found = candidates(spark, d)
    return rounded(ob.mosaic_stop(found, found, ["b04", "b08"], least=0.05), "ratio")


@query("w9_tile_mosaic", "select row, col, arg_min(v, case when v is not null then tile_ord end) as v from tile_px group by row, col")
def w9_tile_mosaic(spark, d):
    return ra.tile_mosaic(view(spark, d, "tile_px"))


@query("t7_overviews", "select level, row // (1 << level) as row, col // (1 << level) as col, cls, (row // (1 << level)) // 4 as block_row, (col // (1 << level)) // 4 as block_col from lc, (select cast(range as integer) as level from range(4)) where row % (1 << level) = 0 and col % (1 << level) = 0")
def t7_overviews(spark, d):
    return ra.overviews(view(spark, d, "lc"), levels=3, block=4).select("level", "row", "col", "cls", F.col("block_row").cast("long").alias("block_row"), F.col("block_col").cast("long").alias("block_col"))


@query("v_plugin_layers", "select row, col, 'ndvi' as variable, 10.0 as resolution, round((b08 - b04) / nullif(b08 + b04, 0), 9) as value from medians union all select row, col, 'ndmi', 20.0, round((b08 - b11) / nullif(b08 + b11, 0), 9) from medians", medians=SUMMER_MEDIANS)
def v_plugin_layers(spark, d):
    """Two indices as plug-ins: each extracts its own bands of a season, and a transform rounds and names the layer."""
    from pyspark.sql import DataFrame

    known = plugins.Variables()

    def index(name: str) -> plugins.Variable:
        def extractor(options):
            def extract(areas: DataFrame, year, season, resolution):
                start, end = dates.season_window(F.lit(year), F.lit(season))
                days = spark.range(1).select(start.cast("string").alias("start"), end.cast("string").alias("end")).first()
                bands = spectral.required_bands([name])
                obs = ob.mask_classes(ob.scan(view(spark, d, "obs"), bands, *days, max_cloud=options["cloud"]), bands)
                return ob.index_composite(obs, [name])

            return extract

        as_layer = lambda df: rounded(df.select("row", "col", F.lit(name).alias("variable"), F.col(name).alias("value")), "value")
        return plugins.Variable(extractor, lambda options: as_layer)

    layers = []
    for name in ("ndvi", "ndmi"):
        known.add(name, index(name))
        layer, resolution = known.layer(name.upper(), aoi(spark, "A"), 1996, "summer", options={"cloud": 40.0})
        layers.append(layer.withColumn("resolution", F.lit(float(resolution))))
    return layers[0].unionByName(layers[1])
