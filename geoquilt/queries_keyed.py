"""Queries for many areas at once: percentiles, cover, coverage, scaling and the mosaic search of each area in one job."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import spectral
from .operators import areas as ar
from .operators import observations as ob
from .queries_rasters import NDVI_OF_EACH, PER_DATE, SUMMER_MEDIANS, candidates, summer
from .queries_shapes import NAMES, PARITY
from .registry import query, rounded
from .sources.views import shapes, view

INSIDE = PARITY.format(x="(p.col + 0.5)", y="(p.row + 0.5)")
NDVI_TAGGED = f"select a.aoi_id, p.row, p.col, p.ndvi from each_ndvi p, names a where {INSIDE}"


def ndvi_of_areas(spark, d):
    return ar.clip(ob.median_of_index(summer(spark, d, ("b04", "b08")), "ndvi"), shapes(spark))


@query("a5_percentiles_by_area", "select aoi_id, round(quantile_cont(ndvi, 0.05), 9) as low, round(quantile_cont(ndvi, 0.95), 9) as high from tagged group by aoi_id", each_ndvi=NDVI_OF_EACH, names=NAMES, tagged=NDVI_TAGGED)
def a5_percentiles_by_area(spark, d):
    return rounded(ob.percentiles(ndvi_of_areas(spark, d), "ndvi", by=("aoi_id",)), "low", "high")


@query(
    "p14_fvc_by_area",
    ", p as (select aoi_id, quantile_cont(ndvi, 0.05) as lo, quantile_cont(ndvi, 0.95) as hi from tagged group by aoi_id) select t.aoi_id, row, col, case when ndvi is not null then round(greatest(0, least(1, (ndvi - lo) / (hi - lo))), 9) end as fvc from tagged t join p on p.aoi_id = t.aoi_id",
    each_ndvi=NDVI_OF_EACH, names=NAMES, tagged=NDVI_TAGGED,
)
def p14_fvc_by_area(spark, d):
    return rounded(ob.fractional_cover(ndvi_of_areas(spark, d), by=("aoi_id",)).select("aoi_id", "row", "col", "fvc"), "fvc")


@query("a6_coverage_by_area", f"select a.aoi_id, count(*) as inside, count(*) filter (where b04 is not null and b08 is not null) as valid, round(count(*) filter (where b04 is not null and b08 is not null) / cast(count(*) as double), 9) as ratio from medians p, names a where {INSIDE} group by a.aoi_id", medians=SUMMER_MEDIANS, names=NAMES)
def a6_coverage_by_area(spark, d):
    pixels = ar.clip(ob.composite(summer(spark, d), ["b04", "b08"]), shapes(spark))
    return rounded(ob.coverage(pixels, spectral.all_valid("b04", "b08"), ("aoi_id",)).select("aoi_id", "inside", "valid", "ratio"), "ratio")


# Suppliers of odd number deliver reflectance, the others its ten-thousandfold.
MIXED = "select obs_id, row % 4 as source, case when row % 2 = 1 then b04 / 10000 else b04 end as b04, case when row % 2 = 1 then b03 / 10000 else b03 end as b03 from obs"


@query("p16_scale_by_source", "select o.obs_id, round(case when m.most > 1.5 then b04 / 10000 else b04 end, 9) as b04, round(case when m.most > 1.5 then b03 / 10000 else b03 end, 9) as b03 from mixed o join (select source, max(greatest(b04, b03)) as most from mixed where b04 is not null and b03 is not null group by source) m on m.source = o.source", mixed=MIXED)
def p16_scale_by_source(spark, d):
    odd = F.col("row") % 2 == 1
    obs = view(spark, d, "obs").withColumns({b: F.when(odd, F.col(b) / 10000).otherwise(F.col(b)) for b in ("b04", "b03")}).withColumn("source", F.col("row") % 4)
    return rounded(ob.scale_reflectance(obs, ["b04", "b03"], by=("source",)).select("obs_id", "b04", "b03"), "b04", "b03")


@query("p16_own_scales", "select obs_id, round(b04 * 0.0001e0 - 0.1e0, 9) as b04, b03 from obs")
def p16_own_scales(spark, d):
    """Bands with a scale and offset of their own: these count, and the others stay."""
    return rounded(ob.scale_reflectance(view(spark, d, "obs"), ["b04", "b03"], {"b04": (0.0001, -0.1), "b03": (1.0, 0.0)}).select("obs_id", "b04", "b03"), "b04")


@query(
    "w4_mosaic_stop_by_area",
    f""", found as (select a.aoi_id, p.* from per_date p, names a where {INSIDE}),
v as (select distinct aoi_id, rank, row, col from found where b04 is not null and b08 is not null),
n as (select aoi_id, count(*) as n from (select distinct aoi_id, row, col from found) group by aoi_id),
own as (select aoi_id, rank, count(*) as own from v group by aoi_id, rank),
fresh as (select aoi_id, rank, count(*) as new from (select aoi_id, row, col, min(rank) as rank from v group by aoi_id, row, col) group by aoi_id, rank),
steps as (select own.aoi_id, own.rank, own, sum(coalesce(new, 0)) over (partition by own.aoi_id order by own.rank) as covered, row_number() over (partition by own.aoi_id order by own.rank) as dates, n from own left join fresh on own.rank = fresh.rank and own.aoi_id = fresh.aoi_id join n on n.aoi_id = own.aoi_id),
ends as (select *, row_number() over (partition by aoi_id order by rank) as k from steps where own >= n * 0.05 or covered >= n * 0.05 or dates >= 5)
select aoi_id, cast(rank as integer) as stop_rank, case when own >= n * 0.05 then 'single' else 'mosaic' end as kind, round(case when own >= n * 0.05 then own else covered end / cast(n as double), 9) as ratio from ends where k = 1""",
    per_date=PER_DATE, names=NAMES,
)
def w4_mosaic_stop_by_area(spark, d):
    found = ar.clip(candidates(spark, d), shapes(spark))
    return rounded(ob.mosaic_stop(found, found, ["b04", "b08"], least=0.05, by=("aoi_id",)), "ratio")


@query("a1_split_median", "select row, col, b02, b04, b08, b11 from medians", medians=SUMMER_MEDIANS)
def a1_split_median(spark, d):
    """Medians of pixels by ranks: no pixel's observations come together in one task."""
    return ob.split_median(summer(spark, d), ["b02", "b04", "b08", "b11"])
