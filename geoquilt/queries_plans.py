"""Queries over catalogues, plans and run records."""

from __future__ import annotations

from pyspark.sql import functions as F

from .plans import catalog, extraction, tracking
from .registry import query, rounded
from .sources.views import view

_NAMES = [v[0] for v in catalog.VARIABLES]
#: Requests made from orders: five hundred customers' variables each.
REQUESTS = "select o_custkey as job, (['" + "', '".join(n.upper() if i % 2 else n for i, n in enumerate([*_NAMES, "unknown"])) + "'])[cast(o_orderkey % 18 as integer) + 1] as variable, case when o_custkey % 3 = 0 then cast(30 as integer) end as resolution from orders"
_VALUES = ", ".join(f"('{n}', {r if r is not None else 'null'}, {s if s else 'null'}, {('null' if e is None or not s else e)}, {str(s == 0).lower()}, {str(e is None and s != 0).lower()}, {list(o)})" for n, r, s, e, _, o in catalog.VARIABLES)
VARIABLES_SQL = f"select * from (values {_VALUES}) v(name, native_resolution_m, start_year, end_year, is_static, is_present, season_options)"


def requests(spark, d):
    names = F.array(*[F.lit(n.upper() if i % 2 else n) for i, n in enumerate([*_NAMES, "unknown"])])
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.select(F.col("o_custkey").alias("job"), F.element_at(names, (F.col("o_orderkey") % 18 + 1).cast("int")).alias("variable"), F.when(F.col("o_custkey") % 3 == 0, 30).alias("resolution"))


@query("j11_catalog_lookup", "select job, variable, native_resolution_m, name is null as unknown from requests left join variables on lower(variable) = name", requests=REQUESTS, variables=VARIABLES_SQL)
def j11_catalog_lookup(spark, d):
    known, unknown = catalog.lookup(requests(spark, d))
    known = known.select("job", "variable", "native_resolution_m", F.lit(False).alias("unknown"))
    return known.unionByName(unknown.select("job", "variable", F.lit(None).cast("int").alias("native_resolution_m"), F.lit(True).alias("unknown")))


@query("j14_effective_resolution", "select job, cast(coalesce(max(resolution), max(native_resolution_m)) as integer) as resolution from requests join variables on lower(variable) = name group by job", requests=REQUESTS, variables=VARIABLES_SQL)
def j14_effective_resolution(spark, d):
    return catalog.effective_resolution(requests(spark, d), "job")


@query("u2_common_years", ", s as (select job, coalesce(max(start_year), 2024) as a, coalesce(min(case when not is_static then case when is_present then 2024 else end_year end end), 2024) as b from requests join variables on lower(variable) = name group by job) select job, cast(unnest(range(a, b + 1)) as integer) as year from s where a <= b", requests=REQUESTS, variables=VARIABLES_SQL)
def u2_common_years(spark, d):
    return catalog.common_years(requests(spark, d), 2024, "job")


@query(
    "u3_common_seasons",
    """, r as (select distinct job, variable from requests), k as (select job, season_options from r join variables on lower(variable) = name),
n as (select job, count(*) as wanted from k group by job), e as (select job, season, count(*) as have from (select job, unnest(season_options) as season from k) group by job, season),
o as (select job, string_agg(season, ',' order by list_position(['winter', 'spring', 'summer', 'autumn', 'annual', 'static'], season)) as s from e join n using (job) where have = wanted group by job)
select n.job, coalesce(s, 'annual') as seasons from n left join o on n.job = o.job""",
    requests=REQUESTS, variables=VARIABLES_SQL,
)
def u3_common_seasons(spark, d):
    return catalog.common_seasons(requests(spark, d), "job").select("job", F.array_join("seasons", ",").alias("seasons"))


JOBS = """select s_suppkey as job, ['A', 'B', 'A'] as aois, ['summer', 'winter', 'summer'] as seasons, [2020 + s_suppkey % 2, 2021, 2021] as years,
 case s_suppkey % 4 when 0 then ['ndvi', 'NDMI', 'msi', 'clay', 'gbif_occurrences', 'ndvi'] when 1 then ['msi', 'fvc'] when 2 then ['bdod', 'sand'] else ['BSI', 'ndmi', 'msi', 'rgb'] end as variables from supplier"""
TASKS = """select job, aoi, season, year, task_type, variables from (
 with j as (select job, unnest(list_distinct(aois)) as aoi, seasons, years, list_transform(variables, lambda v: lower(v)) as vs from jobs),
 v as (select job, aoi, unnest(list_distinct(vs)) as v from j),
 g as (select distinct job, aoi, unnest(seasons) as season, years from j),
 y as (select distinct job, aoi, season, cast(unnest(years) as varchar) as year from g),
 many as (select job, aoi, string_agg(v, ',' order by v) as vs, count(*) as n from v where v in ('ndmi', 'msi', 'bsi') group by job, aoi)
 select job, aoi, case when v = 'gbif_occurrences' then 'all' else 'annual' end as season, case when v = 'gbif_occurrences' then 'all' else 'static' end as year, 'single' as task_type, v as variables from v where v in ('bdod', 'clay', 'cfvo', 'sand', 'silt', 'cec', 'gbif_occurrences')
 union all select y.job, y.aoi, season, year, 'multi_index', vs from y join many on y.job = many.job and y.aoi = many.aoi where n >= 2
 union all select y.job, y.aoi, season, year, 'single', v from y join v on y.job = v.job and y.aoi = v.aoi left join many on v.job = many.job and v.aoi = many.aoi where v not in ('bdod', 'clay', 'cfvo', 'sand', 'silt', 'cec', 'gbif_occurrences') and (v not in ('ndmi', 'msi', 'bsi') or n < 2))"""


def jobs(spark, d):
    supplier = spark.read.parquet(f"{d}/supplier.parquet")
    text = lambda *x: F.array(*map(F.lit, x))
    k = F.col("s_suppkey") % 4
    variables = F.when(k == 0, text("ndvi", "NDMI", "msi", "clay", "gbif_occurrences", "ndvi")).when(k == 1, text("msi", "fvc")).when(k == 2, text("bdod", "sand")).otherwise(text("BSI", "ndmi", "msi", "rgb"))
    return supplier.select(F.col("s_suppkey").alias("job"), text("A", "B", "A").alias("aois"), text("summer", "winter", "summer").alias("seasons"), F.array(F.lit(2020) + F.col("s_suppkey") % 2, F.lit(2021), F.lit(2021)).alias("years"), variables.alias("variables"))


@query("j12_extraction_plan", "select * from tasks", jobs=JOBS, tasks=TASKS)
def j12_extraction_plan(spark, d):
    return extraction.plan(jobs(spark, d)).withColumn("variables", F.array_join(F.array_sort("variables"), ","))


@query(
    "j13_missing_outputs",
    """, p as (select distinct aoi, season, year, unnest(string_split(variables, ',')) as variable from tasks),
have as (select distinct case when output_id % 2 = 0 then 'A' else 'B' end as aoi, season, year, variable from outputs where gcs_uri is not null)
select aoi, season, year, variable, case when variable in ('bdod', 'clay', 'cfvo', 'sand', 'silt', 'cec', 'gbif_occurrences') then variable || '_' || lower(aoi) else variable || '_' || year || '_' || season || '_' || lower(aoi) end || case when variable = 'gbif_occurrences' then '.geojson' else '.tif' end as filename
from p where not exists (select 1 from have h where h.aoi = p.aoi and h.season = p.season and h.year = p.year and h.variable = p.variable)""",
    jobs=JOBS, tasks=TASKS,
)
def j13_missing_outputs(spark, d):
    done = view(spark, d, "outputs").where(tracking.succeeded()).select(F.when(F.col("output_id") % 2 == 0, "A").otherwise("B").alias("aoi"), "season", "year", "variable").distinct()
    return extraction.missing(extraction.plan(jobs(spark, d)), done)


@query("w8_ordered_distinct", "select job, value, cast(min(position) as integer) as position from (select job, unnest(variables) as value, generate_subscripts(variables, 1) - 1 as position from jobs) group by job, value", jobs=JOBS)
def w8_ordered_distinct(spark, d):
    return extraction.first_positions(jobs(spark, d), ["job"], "variables")


@query("a15_run_summary", "select job_name, ts, git_commit, count(*) as total_outputs, count(gcs_uri) as successful_outputs, count(*) - count(gcs_uri) as failed_outputs from outputs group by all")
def a15_run_summary(spark, d):
    return tracking.summary(view(spark, d, "outputs"), list(tracking.RUN))


@query("a16_outputs_by_variable", "select job_name, ts, git_commit, variable, count(*) as n from outputs group by all")
def a16_outputs_by_variable(spark, d):
    return tracking.by_variable(view(spark, d, "outputs"))


@query("a17_runs_per_period", "select cast(cast(date_trunc('week', cast(ts as date)) as date) as varchar) as period, count(distinct (job_name, ts, git_commit)) as runs, count(*) as outputs from outputs group by 1")
def a17_runs_per_period(spark, d):
    return tracking.per_period(view(spark, d, "outputs"), "week")


@query("a17_success_rate", "select cast(cast(date_trunc('day', cast(ts as date)) as date) as varchar) as period, round(count(gcs_uri) / cast(count(*) as double), 9) as rate from outputs group by 1")
def a17_success_rate(spark, d):
    return rounded(tracking.success_rate(view(spark, d, "outputs"), "day"), "rate")


@query("a17_variable_pivot", "select job_name, count(*) filter (where variable = 'ndvi') as ndvi, count(*) filter (where variable = 'ndmi') as ndmi, count(*) filter (where variable = 'fvc') as fvc from outputs group by job_name")
def a17_variable_pivot(spark, d):
    return tracking.variable_pivot(view(spark, d, "outputs"), ["ndvi", "ndmi", "fvc"])


@query("a18_flat_outputs", ", n as (select job_name, ts, git_commit, count(*) as t, count(gcs_uri) as g from outputs group by all) select o.job_name, o.ts, o.git_commit, cast(t as integer) as total_outputs, cast(g as integer) as successful_outputs, cast(t - g as integer) as failed_outputs, output_id, variable, year, season, gcs_uri from outputs o join n on n.job_name = o.job_name and n.ts = o.ts and n.git_commit = o.git_commit")
def a18_flat_outputs(spark, d):
    return tracking.flat(tracking.documents(view(spark, d, "outputs")))


@query("u4_history_union", "select job_name, output_id, case when output_id % 2 = 0 then variable end as variable, case when output_id % 2 = 1 then season end as season from outputs")
def u4_history_union(spark, d):
    """Two histories of different columns under one header."""
    o = view(spark, d, "outputs")
    return tracking.together([o.where("output_id % 2 = 0").select("job_name", "output_id", "variable"), o.where("output_id % 2 = 1").select("job_name", "output_id", "season")])


@query("u5_history_filters", "select distinct 'commit' as kind, job_name, ts, git_commit from outputs where git_commit = 'c3' union all select distinct 'period', job_name, ts, git_commit from outputs where ts >= '1996' and ts < '1997' union all select distinct 'failed', job_name, ts, git_commit from outputs where gcs_uri is null")
def u5_history_filters(spark, d):
    o = view(spark, d, "outputs")
    parts = [("commit", tracking.select(o, commit="c3")), ("period", tracking.select(o, start="1996", end="1997")), ("failed", tracking.select(o, failed=True))]
    out = [df.select(F.lit(k).alias("kind"), *tracking.RUN) for k, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])
