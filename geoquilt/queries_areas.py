"""Queries over points, footprints, tiles and areas: filters, spatial joins, duplicates, tilings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import crs, dates, geometry, spectral, text
from .operators import areas as ar
from .operators import observations as ob
from .operators import occurrences as oc
from .operators import rasters as ra
from .operators import scenes as sc
from .registry import query, rounded
from .sources import readers
from .sources.views import aoi, view

BOX = ["xmin", "ymin", "xmax", "ymax"]
SEASON_NAMES = ["spring", "SUMMER", "autumn", "fall", "winter", "annual", "year", "static"]
SEASONED = "select scene_id, acq_date, cast(year(acq_date) as integer) as y, (['" + "', '".join(SEASON_NAMES) + "'])[cast(scene_id % 8 as integer) + 1] as season from scenes"
WINDOWS = """select *, case lower(season) when 'spring' then make_date(y, 3, 1) when 'summer' then make_date(y, 6, 1) when 'autumn' then make_date(y, 9, 1) when 'fall' then make_date(y, 9, 1) when 'winter' then make_date(y, 12, 1) else make_date(y, 1, 1) end as s,
 case lower(season) when 'spring' then make_date(y, 5, 31) when 'summer' then make_date(y, 8, 31) when 'autumn' then make_date(y, 11, 30) when 'fall' then make_date(y, 11, 30) when 'winter' then make_date(y + 1, 2, 28) else make_date(y, 12, 31) end as e from seasoned"""


def seasoned(spark, d):
    season = F.element_at(F.array(*map(F.lit, SEASON_NAMES)), (F.col("scene_id") % 8 + 1).cast("int"))
    return view(spark, d, "scenes").withColumn("y", F.year("acq_date")).withColumn("season", season)


@query("p1_season_window", "select scene_id, cast(s as varchar) as first_day, cast(e as varchar) as last_day from windows", seasoned=SEASONED, windows=WINDOWS)
def p1_season_window(spark, d):
    start, end = dates.season_window(F.col("y"), F.col("season"))
    return seasoned(spark, d).select("scene_id", start.cast("string").alias("first_day"), end.cast("string").alias("last_day"))


@query("p2_mid_season_date", "select scene_id, cast(case when season <> 'static' then s + cast(floor(datediff('day', s, e) / 2) as integer) end as varchar) as middle from windows", seasoned=SEASONED, windows=WINDOWS)
def p2_mid_season_date(spark, d):
    return seasoned(spark, d).select("scene_id", dates.mid_season(F.col("y"), F.col("season")).cast("string").alias("middle"))


@query("p3_date_in_season", "select scene_id from windows where acq_date not between s and e", seasoned=SEASONED, windows=WINDOWS)
def p3_date_in_season(spark, d):
    """Scenes whose date is not in the season that they are filed under."""
    return seasoned(spark, d).where(~dates.in_season(F.col("acq_date"), F.col("y"), F.col("season"))).select("scene_id")


@query("p4_not_future", "select scene_id, acq_date <= date '1997-01-01' as acquired, s <= date '1997-01-01' as begun from windows", seasoned=SEASONED, windows=WINDOWS)
def p4_not_future(spark, d):
    as_of = F.lit("1997-01-01").cast("date")
    start, _ = dates.season_window(F.col("y"), F.col("season"))
    return seasoned(spark, d).select("scene_id", (F.col("acq_date") <= as_of).alias("acquired"), (start <= as_of).alias("begun"))


@query("p6_cloud_filter", "select 'cube' as kind, obs_id as id from obs where cloud < 40 union all select 'catalogue', scene_id from scenes where cloud is null or cloud <= 40")
def p6_cloud_filter(spark, d):
    cube = view(spark, d, "obs").where("cloud < 40").select(F.lit("cube").alias("kind"), F.col("obs_id").alias("id"))
    return cube.unionByName(sc.cloud_at_most(view(spark, d, "scenes"), 40.0).select(F.lit("catalogue").alias("kind"), F.col("scene_id").alias("id")))


MEETS_B = """exists (select 1 from aoi_b e where least(e.x1, e.x2) <= xmax and greatest(e.x1, e.x2) >= xmin and least(e.y1, e.y2) <= ymax and greatest(e.y1, e.y2) >= ymin
 and abs(list_sum([sign(v) for v in [(e.x2 - e.x1) * (ymin - e.y1) - (e.y2 - e.y1) * (xmin - e.x1), (e.x2 - e.x1) * (ymin - e.y1) - (e.y2 - e.y1) * (xmax - e.x1), (e.x2 - e.x1) * (ymax - e.y1) - (e.y2 - e.y1) * (xmin - e.x1), (e.x2 - e.x1) * (ymax - e.y1) - (e.y2 - e.y1) * (xmax - e.x1)]])) < 4)
 or (select count(*) from aoi_b e where (e.y1 > ymin) <> (e.y2 > ymin) and xmin < (e.x2 - e.x1) * (ymin - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1"""


@query("j5_scene_intersects", f"select 'A' as aoi, scene_id from scenes where xmin <= 12 and xmax >= 4 and ymin <= 12 and ymax >= 4 union all select 'B', scene_id from scenes where {MEETS_B}")
def j5_scene_intersects(spark, d):
    """Footprints that touch a square and a concave area."""
    scenes = view(spark, d, "scenes")
    part = lambda name: sc.scenes_in_area(scenes, aoi(spark, name)).select(F.lit(name).alias("aoi"), "scene_id")
    return part("A").unionByName(part("B"))


STATS = "select acq_date, coalesce(avg(cloud), 1e9) as mean_cloud, count(*) as n_items from scenes group by acq_date"


@query("a8_date_cloud_stats", "select cast(acq_date as varchar) as acq_date, round(mean_cloud, 9) as mean_cloud, n_items from stats", stats=STATS)
def a8_date_cloud_stats(spark, d):
    return rounded(sc.date_stats(view(spark, d, "scenes")).withColumn("acq_date", F.col("acq_date").cast("string")), "mean_cloud")


@query("j6_nearest_scene", "select cast(t.target as varchar) as target, cast(arg_min(acq_date, (abs(datediff('day', target, acq_date)), mean_cloud, acq_date)) as varchar) as acq_date from (select distinct obs_date + 1 as target from obs) t join stats on abs(datediff('day', target, acq_date)) <= 30 group by target", stats=STATS)
def j6_nearest_scene(spark, d):
    targets = view(spark, d, "obs").select(F.date_add("obs_date", 1).alias("target"))
    found = sc.nearest_dates(sc.date_stats(view(spark, d, "scenes")), targets, 30)
    return found.select(F.col("target").cast("string").alias("target"), F.col("acq_date").cast("string").alias("acq_date"))


CELLS_A = "select c.range as x, r.range as y from range(4, 12) c, range(4, 12) r"
COVER = "select acq_date, count(distinct (x, y)) / 64.0e0 as ratio from scenes join cells_a on x >= xmin and x + 1 <= xmax and y >= ymin and y + 1 <= ymax group by acq_date"


@query("a9_footprint_coverage", "select cast(acq_date as varchar) as acq_date, round(ratio, 9) as ratio, ratio >= 0.999 as covers from cover", cells_a=CELLS_A, cover=COVER)
def a9_footprint_coverage(spark, d):
    cells = aoi(spark, "A").select(geometry.ring_box(F.col("ring")).alias("b")).select(F.explode(F.sequence(F.floor("b.xmin"), F.ceil("b.xmax") - 1)).alias("cell_x"), "b").select("cell_x", F.explode(F.sequence(F.floor("b.ymin"), F.ceil("b.ymax") - 1)).alias("cell_y"))
    out = sc.footprint_coverage(view(spark, d, "scenes"), cells)
    return rounded(out.withColumn("acq_date", F.col("acq_date").cast("string")), "ratio")


@query("w5_candidate_rank", "select cast(acq_date as varchar) as acq_date, cast(row_number() over (order by abs(datediff('day', date '1996-07-16', acq_date)), mean_cloud, acq_date) as integer) as rank from stats where acq_date <= date '1998-01-01'", stats=STATS)
def w5_candidate_rank(spark, d):
    return sc.ranked_dates(sc.date_stats(view(spark, d, "scenes")), "1996-07-16", "1998-01-01").select(F.col("acq_date").cast("string").alias("acq_date"), "rank")


@query("w6_day_scan_order", "select cast(target as varchar) as target, cast(target + cast(k as integer) as varchar) as day, cast(row_number() over (partition by target order by abs(k), k) as integer) as place from (select distinct acq_date as target from scenes), (select range - 5 as k from range(11))")
def w6_day_scan_order(spark, d):
    out = sc.day_scan_order(view(spark, d, "scenes").select(F.col("acq_date").alias("target")).distinct(), 5)
    return out.select(F.col("target").cast("string").alias("target"), F.col("day").cast("string").alias("day"), "place")


@query("w7_item_cap", "select scene_id from scenes order by acq_date, scene_id limit 2000")
def w7_item_cap(spark, d):
    return view(spark, d, "scenes").orderBy("acq_date", "scene_id").limit(2000).select("scene_id")


# Occurrences

KINGDOM = "try_cast(kingdom_key as integer)"
CLASS = "try_cast(class_key as integer)"
LICENSE_SQL = """select pos, case when trim(license) = '' or license is null then null
 when upper(regexp_replace(trim(license), '[^A-Za-z0-9]+', '_', 'g')) in ('CC0', 'CC0_1_0', 'PUBLIC_DOMAIN', 'PUBLIC_DOMAIN_MARK', 'PUBLIC_DOMAIN_DEDICATION') then 'CC0'
 when trim(upper(regexp_replace(trim(license), '[^A-Za-z0-9]+', '_', 'g')), '_') in ('CC_BY', 'CC_BY_4_0', 'CC_BY_3_0', 'CC_BY_2_0') then 'CC_BY'
 when trim(upper(regexp_replace(trim(license), '[^A-Za-z0-9]+', '_', 'g')), '_') in ('CC_BY_ND', 'CC_BY_ND_4_0') then 'CC_BY_ND'
 when trim(upper(regexp_replace(trim(license), '[^A-Za-z0-9]+', '_', 'g')), '_') in ('CC_BY_NC', 'CC_BY_NC_4_0') then 'CC_BY_NC'
 when contains(lower(license), 'creativecommons.org/publicdomain/zero') then 'CC0' when contains(lower(license), 'creativecommons.org/licenses/by-nc-nd') then 'CC_BY_NC_ND'
 when contains(lower(license), 'creativecommons.org/licenses/by') then 'CC_BY'
 when contains(lower(license), 'creative commons') and contains(lower(license), 'sharealike') then 'CC_BY_SA' end as code from occ"""


@query("p22_occ_filter", f"select pos from occ where lon is not null and lat is not null and {KINGDOM} in (1, 6) and ({KINGDOM} <> 1 or coalesce({CLASS} in (212, 359), false))")
def p22_occ_filter(spark, d):
    return oc.select_taxa(view(spark, d, "occ"), [1, 6], [212, 359]).select("pos")


REQUESTED = "select *, 'd' || cast(pos % 3 as varchar) as dataset_key, case when pos % 2 = 0 then 'Human_Observation' else 'PRESERVED_SPECIMEN' end as basis_of_record, case when pos % 7 = 0 then 'absent' else 'PRESENT' end as occurrence_status from occ"


@query("p22_occ_request", "select pos from asked where lon is not null and lat is not null and coalesce(class_key, '') = '212' and dataset_key = 'd1' and upper(basis_of_record) = 'HUMAN_OBSERVATION' and upper(occurrence_status) = 'PRESENT'", asked=REQUESTED)
def p22_occ_request(spark, d):
    """Records that a request names: a taxon, a dataset, a basis and a status."""
    pos = F.col("pos")
    occ = view(spark, d, "occ").withColumns({
        "dataset_key": F.concat(F.lit("d"), pos % 3),
        "basis_of_record": F.when(pos % 2 == 0, "Human_Observation").otherwise("PRESERVED_SPECIMEN"),
        "occurrence_status": F.when(pos % 7 == 0, "absent").otherwise("PRESENT"),
    })
    return oc.requested(occ, 212, "d1", "human_observation", "present").select("pos")


@query("p23_occ_license", "select pos from codes where code in ('CC0', 'CC_BY', 'CC_BY_SA', 'CC_BY_ND')", codes=LICENSE_SQL)
def p23_occ_license(spark, d):
    return oc.allowed_licenses(view(spark, d, "occ"), ["COMMERCIAL"]).select("pos")


@query("p24_license_canonical", "select pos, code from codes", codes=LICENSE_SQL)
def p24_license_canonical(spark, d):
    return view(spark, d, "occ").select("pos", text.license_code(F.col("license")).alias("code"))


@query("p25_occ_normalize", "select pos, coalesce(nullif(species, ''), scientific_name) as species, coalesce(year, try_cast(nullif(regexp_extract(event_date, '[0-9]{4}'), '') as integer)) as year, case when pos % 3 = 0 then 'A;B' when pos % 3 = 1 then '' else 'C' end as issues, coalesce(gbif_id, cast(pos as varchar)) as gbif_id from occ")
def p25_occ_normalize(spark, d):
    issues = F.when(F.col("pos") % 3 == 0, F.array(F.lit("A"), F.lit(None), F.lit("B"))).when(F.col("pos") % 3 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("C")))
    raw = view(spark, d, "occ").withColumn("issues", issues).withColumn("key", F.col("pos"))
    return oc.normalize(raw).select("pos", "species", "year", "issues", "gbif_id")


FIELDS_SQL = {"gbifID": "coalesce(gbif_id, cast(pos as varchar))", "occurrenceID": "occurrence_id", "scientificName": "scientific_name", "species": "coalesce(nullif(species, ''), scientific_name)", "classKey": "class_key", "kingdomKey": "kingdom_key", "eventDate": "event_date", "year": "coalesce(year, try_cast(nullif(regexp_extract(event_date, '[0-9]{4}'), '') as integer))", "decimalLatitude": "lat", "decimalLongitude": "lon", "license": "license"}


@query("p25_occ_record", "select pos as key, " + ", ".join(f'{FIELDS_SQL.get(f, "null")} as "{f}"' for f in readers.RECORD_FIELDS) + " from occ")
def p25_occ_record(spark, d):
    """All published fields of normalized records."""
    keyed = view(spark, d, "occ").withColumn("key", F.col("pos"))
    return oc.as_records(keyed, "key")


@query("p26_taxon_labels", "select pos, coalesce(case kingdom_key when '1' then 'Animalia' when '5' then 'Fungi' when '6' then 'Plantae' end, kingdom_key) as kingdom, coalesce(case class_key when '212' then 'Aves' when '359' then 'Mammalia' end, class_key) as class_name from occ")
def p26_taxon_labels(spark, d):
    occ = oc.with_labels(view(spark, d, "occ"), "kingdom_key", oc.KINGDOMS, "kingdom")
    return oc.with_labels(occ, "class_key", oc.CLASSES, "class_name").select("pos", "kingdom", "class_name")


INSIDE_B = """((select count(*) from aoi_b e where (e.y1 > lat) <> (e.y2 > lat) and lon < (e.x2 - e.x1) * (lat - e.y1) / (e.y2 - e.y1) + e.x1) % 2 = 1
 or exists (select 1 from aoi_b e where (e.x2 - e.x1) * (lat - e.y1) = (e.y2 - e.y1) * (lon - e.x1) and lon between least(e.x1, e.x2) and greatest(e.x1, e.x2) and lat between least(e.y1, e.y2) and greatest(e.y1, e.y2)))"""


@query("j1_points_in_aoi", f"select 'A' as aoi, pos from occ where lon between 4 and 12 and lat between 4 and 12 union all select 'B', pos from occ where {INSIDE_B} union all select 'D', pos from occ where lon between 6 and 10 and lat between 6 and 10")
def j1_points_in_aoi(spark, d):
    areas = aoi(spark).where(F.col("aoi_id").isin("A", "B", "D"))
    return ar.tagged(view(spark, d, "occ"), areas).select(F.col("aoi_id").alias("aoi"), "pos")


DEDUPE = "select pos from (select pos, row_number() over (partition by coalesce('g' || gbif_id, 'o' || occurrence_id) order by pos) as n, coalesce(gbif_id, occurrence_id) as k from {rows}) where n = 1 or k is null"


@query("w1_occ_dedupe", DEDUPE.format(rows="occ"))
def w1_occ_dedupe(spark, d):
    return oc.first_of_each(view(spark, d, "occ"), ["pos"]).select("pos")


@query("w2_record_cap", "select pos from (" + DEDUPE.format(rows="occ") + ") order by pos limit 500")
def w2_record_cap(spark, d):
    return oc.capped(oc.first_of_each(view(spark, d, "occ"), ["pos"]), 500, ["pos"]).select("pos")


@query("u1_kingdom_union", DEDUPE.format(rows="animals"), animals=f"select * from occ where ({KINGDOM} = 1 and coalesce({CLASS} in (212, 359), false)) or {KINGDOM} = 6")
def u1_kingdom_union(spark, d):
    return oc.kingdom_union(view(spark, d, "occ"), [212, 359], [6], ["pos"]).select("pos")


@query("a11_tile_counts", "select cast(floor(lon / 2.5) as bigint) as cell_x, cast(floor(lat / 2.5) as bigint) as cell_y, count(*) as n from occ where lon is not null and lat is not null group by all")
def a11_tile_counts(spark, d):
    return oc.tile_counts(view(spark, d, "occ"), 2.5)


SKEWED = "select lon * lon / 400 as x, lat * lat / 400 as y from occ where lon is not null"
LEAVES = """select depth, cast(least(floor(x * (1 << depth)), (1 << depth) - 1) as bigint) as ix, cast(least(floor(y * (1 << depth)), (1 << depth) - 1) as bigint) as iy, count(*) as n from skewed, (select cast(range as integer) as depth from range(7)) group by all"""


@query("t3_quadtree_tiles", "select l.depth, l.ix, l.iy, l.n from levels l left join levels p on p.depth = l.depth - 1 and p.ix = l.ix // 2 and p.iy = l.iy // 2 where (l.n <= 200 or l.depth = 6) and (p.n is null or p.n > 200)", skewed=SKEWED, levels=LEAVES)
def t3_quadtree_tiles(spark, d):
    occ = view(spark, d, "occ").where("lon is not null").select((F.col("lon") * F.col("lon") / 400).alias("x"), (F.col("lat") * F.col("lat") / 400).alias("y"))
    return oc.quadtree(occ, (0.0, 0.0, 1.0, 1.0), 200)


@query("t3_capped_request", "select cast(0 as integer) as depth, 0 as ix, 0 as iy, count(*) as n from skewed", skewed=SKEWED)
def t3_capped_request(spark, d):
    """A request for no more records than a box may hold is one box."""
    occ = view(spark, d, "occ").where("lon is not null").select((F.col("lon") * F.col("lon") / 400).alias("x"), (F.col("lat") * F.col("lat") / 400).alias("y"))
    return oc.quadtree(occ, (0.0, 0.0, 1.0, 1.0), 200, max_records=100)


@query("t2_tile_shrink", ", w as (select k, 0.25 / (1 << k) as step, max(n) as heaviest from (select k, floor(x / (0.25 / (1 << k))), floor(y / (0.25 / (1 << k))), count(*) as n from skewed, (select range as k from range(6)) group by all) group by k) select cast(step as double) as step, heaviest from w order by heaviest > 60, case when heaviest > 60 then -k else k end limit 1", skewed=SKEWED)
def t2_tile_shrink(spark, d):
    occ = view(spark, d, "occ").where("lon is not null").select((F.col("lon") * F.col("lon") / 400).alias("x"), (F.col("lat") * F.col("lat") / 400).alias("y"))
    return ra.tile_shrink(occ, 0.25, 60, 0.005)


@query("t5_bbox_wkt", "select tile_id, printf('POLYGON((%.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f, %.6f %.6f))', xmin, ymin, xmin, ymax, xmax, ymax, xmax, ymin, xmin, ymin) as wkt from tiles")
def t5_bbox_wkt(spark, d):
    return view(spark, d, "tiles").select("tile_id", geometry.box_wkt(*map(F.col, BOX)).alias("wkt"))


# Projections

LAEA = """select pos, lon, lat, 0.08181919104281579e0 as e, 0.006694380022903416e0 as e2, radians(lat) as phi, radians(lon - 10) as d from occ where lon is not null"""
LAEA_Q = "((1 - e2) * ({s} / (1 - e2 * {s} * {s}) - 1 / (2 * e) * ln((1 - e * {s}) / (1 + e * {s}))))"
LAEA_B = f"select *, {LAEA_Q.format(s='1e0')} as qp, asin({LAEA_Q.format(s='sin(phi)')} / {LAEA_Q.format(s='1e0')}) as beta, asin({LAEA_Q.format(s='sin(radians(52))')} / {LAEA_Q.format(s='1e0')}) as b0 from laea"
LAEA_D = "select *, 6378137e0 * sqrt(qp / 2) as rq, 6378137e0 * (cos(radians(52)) / sqrt(1 - e2 * sin(radians(52)) * sin(radians(52)))) / (6378137e0 * sqrt(qp / 2) * cos(b0)) as dd from laea_b"


@query(
    "t4_to_crs",
    """select pos, 'EPSG:3857' as target, round(6378137e0 * radians(lon), 3) as x, round(6378137e0 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) + 0.0e0 as y from occ where lon is not null
union all select pos, 'EPSG:3035', round(rq * sqrt(2 / (1 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(d))) * dd * cos(beta) * sin(d) + 4321000, 3), round(rq * sqrt(2 / (1 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(d))) / dd * (cos(b0) * sin(beta) - sin(b0) * cos(beta) * cos(d)) + 3210000, 3) + 0.0e0 from laea_d""",
    laea=LAEA, laea_b=LAEA_B, laea_d=LAEA_D,
)
def t4_to_crs(spark, d):
    occ, out = view(spark, d, "occ").where("lon is not null"), None
    for target in ("EPSG:3857", "EPSG:3035"):
        x, y = crs.transform(F.col("lon"), F.col("lat"), "EPSG:4326", target)
        part = occ.select("pos", F.lit(target).alias("target"), F.round(x, 3).alias("x"), (F.round(y, 3) + 0.0).alias("y"))
        out = part if out is None else out.unionByName(part)
    return out


@query("t4_to_crs_round_trip", "select pos, zone, round(lon, 7) as lon, round(lat, 7) as lat from occ, (values ('EPSG:25829'), ('EPSG:25830'), ('EPSG:25831'), ('EPSG:3035'), ('EPSG:3857')) z(zone) where lon is not null")
def t4_to_crs_round_trip(spark, d):
    """To each projected system and back; transverse Mercator is checked so, and against published points in the tests."""
    occ, out = view(spark, d, "occ").where("lon is not null"), None
    for zone in ("EPSG:25829", "EPSG:25830", "EPSG:25831", "EPSG:3035", "EPSG:3857"):
        there = crs.with_transformed(occ.select("pos", "lon", "lat"), "lon", "lat", "EPSG:4326", zone, "x", "y").select("pos", "x", "y")
        back = crs.with_transformed(there, "x", "y", zone, "EPSG:4326", "lon", "lat")
        part = back.select("pos", F.lit(zone).alias("zone"), F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))
        out = part if out is None else out.unionByName(part)
    return out.withColumns({c: F.when(F.col(c) == 0, 0.0).otherwise(F.col(c)) for c in ("lon", "lat")})


MERCATOR = "6378137e0 * ln(tan(pi() / 4 + radians({y}) / 2))"


@query("t6_native_grid", f"select tile_id as grid_id, round(6378137e0 * radians(xmin), 4) as x0, round({MERCATOR.format(y='ymax')}, 4) as y0, round(6378137e0 * radians(xmax - xmin) / 100, 4) as dx, round(({MERCATOR.format(y='ymax')} - {MERCATOR.format(y='ymin')}) / 50, 4) as dy, 100 as width, 50 as height from tiles")
def t6_native_grid(spark, d):
    grids = view(spark, d, "tiles").select(F.col("tile_id").alias("grid_id"), *BOX, F.lit(100).alias("width"), F.lit(50).alias("height"))
    out = ra.native_grid(grids, "EPSG:4326", "EPSG:3857")
    return out.withColumns({c: F.round(c, 4) for c in ("x0", "y0", "dx", "dy")})


@query("s5_tile_index", "select relpath, round(degrees(xmin * 100000 / 6378137e0), 9) as lon_min, round(degrees(2 * atan(exp(ymin * 100000 / 6378137e0)) - pi() / 2), 9) as lat_min, round(degrees(xmax * 100000 / 6378137e0), 9) as lon_max, round(degrees(2 * atan(exp(ymax * 100000 / 6378137e0)) - pi() / 2), 9) as lat_max from tiles")
def s5_tile_index(spark, d):
    """Tiles with the envelope in degrees of their four corners."""
    tiles = ra.tile_index(view(spark, d, "tiles"), "EPSG:3857", 100_000)
    out = tiles.select("relpath", F.col("w_xmin").alias("lon_min"), F.col("w_ymin").alias("lat_min"), F.col("w_xmax").alias("lon_max"), F.col("w_ymax").alias("lat_max"))
    return rounded(out, "lon_min", "lat_min", "lon_max", "lat_max")


# Tiles and rasters

UPPER = "select quantile_disc(xmax - xmin, 0.5) as unused, list_sort(list(xmax - xmin))[count(*) // 2 + 1] as w, list_sort(list(ymax - ymin))[count(*) // 2 + 1] as h from tiles"


@query("j3_tile_overlap", "select distinct relpath from tiles, upper_sizes where xmin <= 12 + w / 2 and xmax >= 4 - w / 2 and ymin <= 12 + h / 2 and ymax >= 4 - h / 2", upper_sizes=UPPER)
def j3_tile_overlap(spark, d):
    return ra.overlapping_tiles(view(spark, d, "tiles"), aoi(spark, "A")).select("relpath")


# The area that a polygon and a box share, as the integral along the polygon's edges of their height above the box's lower side.
UNDER = "case when {u} <= 0 then 0 when {u} <= h then {u} * {u} / 2 else h * {u} - h * h / 2 end"
EDGES = "select distinct aoi_id, x1, y1, x2, y2 from aoi_all where x1 <> x2"
CUT = "select r.path, r.ymax - r.ymin as h, e.aoi_id, sign(e.x2 - e.x1) as s, (e.y2 - e.y1) / (e.x2 - e.x1) as m, greatest(least(e.x1, e.x2), r.xmin) as l, least(greatest(e.x1, e.x2), r.xmax) as r, e.x1, e.y1 - r.ymin as v1 from rasters r, edges e"
PARTS = "select *, v1 + m * (l - x1) as ul, v1 + m * (r - x1) as ur from cut where l < r"
SHARED = f"select aoi_id, path, round(abs(sum(s * case when m = 0 then greatest(0, least(h, ul)) * (r - l) else ({UNDER.format(u='ur')} - ({UNDER.format(u='ul')})) / m end)), 9) as area from parts group by aoi_id, path"


@query("j4_best_overlap", "select aoi_id, path, area from (select *, row_number() over (partition by aoi_id order by area desc, path) as n from shared where area > 0) where n = 1", edges=EDGES, cut=CUT, parts=PARTS, shared=SHARED)
def j4_best_overlap(spark, d):
    return ra.best_overlap(view(spark, d, "rasters"), aoi(spark))


@query("a10_tile_stats", "select tile_id % 100 as grp, list_sort(list(xmax - xmin))[count(*) // 2 + 1] as median_width, list_sort(list(ymax - ymin))[count(*) // 2 + 1] as median_height from tiles group by tile_id % 100")
def a10_tile_stats(spark, d):
    return ra.tile_stats(view(spark, d, "tiles").withColumn("grp", F.col("tile_id") % 100), ["grp"])


@query("a13_bounds", "select tile_id % 7 as grp, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from tiles group by tile_id % 7")
def a13_bounds(spark, d):
    return ra.bounds(view(spark, d, "tiles").withColumn("grp", F.col("tile_id") % 7), ["grp"])


# Boxes for even tiles, for odd ones the lower left triangle; the share of a triangle is an integral below its long side.
GRID = "select *, least(xmin + i * 0.75e0, xmax) as x0, least(ymin + j * 0.75e0, ymax) as y0, least(xmin + (i + 1) * 0.75e0, xmax) as x1, least(ymin + (j + 1) * 0.75e0, ymax) as y1 from (select *, unnest(range(cast(ceil((xmax - xmin) / 0.75) as bigint))) as i from tiles), lateral (select unnest(range(cast(ceil((ymax - ymin) / 0.75) as bigint))) as j)"
SLOPED = "select *, y1 - y0 as h, (ymax - ymin) / (xmax - xmin) as m, ymax - (x0 - xmin) * (ymax - ymin) / (xmax - xmin) - y0 as ul, ymax - (x1 - xmin) * (ymax - ymin) / (xmax - xmin) - y0 as ur from grid_cells"


@query("t1_grid_tiles", f"select tile_id, cast(i as integer) as i, cast(j as integer) as j, round(x0, 9) as x0, round(y0, 9) as y0, round(x1, 9) as x1, round(y1, 9) as y1, round(case when tile_id % 2 = 0 then (x1 - x0) * (y1 - y0) else ({UNDER.format(u='ul')} - ({UNDER.format(u='ur')})) / m end, 6) + 0.0e0 as area from sloped where tile_id % 2 = 0 or (x0 - xmin) * (ymax - ymin) + (y0 - ymin) * (xmax - xmin) <= (xmax - xmin) * (ymax - ymin)", grid_cells=GRID, sloped=SLOPED)
def t1_grid_tiles(spark, d):
    corner = {k: F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for k, (x, y) in {"ll": ("xmin", "ymin"), "lr": ("xmax", "ymin"), "ur": ("xmax", "ymax"), "ul": ("xmin", "ymax")}.items()}
    ring = F.when(F.col("tile_id") % 2 == 0, F.array(*[corner[k] for k in ("ll", "lr", "ur", "ul", "ll")])).otherwise(F.array(*[corner[k] for k in ("ll", "lr", "ul", "ll")]))
    out = ra.area_tiles(view(spark, d, "tiles").select(F.col("tile_id").alias("aoi_id"), ring.alias("ring")), 0.75)
    area = F.aggregate("parts", F.lit(0.0), lambda s, r: s + geometry.ring_area(r))
    named = out.select(F.col("aoi_id").alias("tile_id"), "i", "j", F.col("xmin").alias("x0"), F.col("ymin").alias("y0"), F.col("xmax").alias("x1"), F.col("ymax").alias("y1"), F.round(area, 6).alias("area"))
    return rounded(named, "x0", "y0", "x1", "y1")
