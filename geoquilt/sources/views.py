"""Geospatial tables derived from the driver's business tables, as SQL that Spark and DuckDB both read.

The observation grid is 20 x 20 cells of unit size; a pixel's centre is (col + 0.5, row + 0.5).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "obs": """select l_orderkey*10+l_linenumber as obs_id, l_suppkey % 20 as row, l_partkey % 20 as col, cast(l_shipdate as date) as obs_date,
 cast(200+(l_orderkey*7+l_linenumber*13)%1800 as double) as b02, cast(250+(l_partkey*11+l_suppkey*5)%2000 as double) as b03,
 case when l_orderkey%97=0 then null else cast(300+(l_orderkey*3+l_partkey*17)%2500 as double) end as b04,
 cast(500+(l_suppkey*29+l_orderkey)%4500 as double) as b08, cast(400+(l_orderkey*19+l_linenumber)%3500 as double) as b11,
 (l_orderkey+l_linenumber)%12 as scl, cast((l_orderkey*31)%1000 as double)/10 as cloud from lineitem""",
    "scenes": """select o_orderkey as scene_id, cast(o_orderdate as date) as acq_date, cast((o_orderkey*37)%16 as double) as xmin, cast((o_custkey*11)%16 as double) as ymin,
 cast((o_orderkey*37)%16+8 as double) as xmax, cast((o_custkey*11)%16+8 as double) as ymax,
 case when o_orderkey%17=0 then null else cast((o_orderkey*31)%1000 as double)/10 end as cloud from orders""",
    "occ": """select event_id as pos, case when event_id%50=0 then null else cast(event_id-case when event_id%10=9 then 1 else 0 end as string) end as gbif_id,
 case when event_id%100=0 then null else concat('occ-',cast(event_id%4000 as string)) end as occurrence_id,
 case when event_id%61=0 then null else cast((user_id*7919+event_id)%500 as double)/25 end as lon, cast((event_id*104729)%500 as double)/25 as lat,
 case event_type when 'signup' then '1' when 'purchase' then '1' when 'click' then '6' when 'view' then '5' else 'x' end as kingdom_key,
 case event_id%4 when 0 then '212' when 1 then '359' when 2 then '131' else null end as class_key,
 case event_id%12 when 0 then 'CC0_1_0' when 1 then 'http://creativecommons.org/licenses/by/4.0/legalcode' when 2 then 'CC BY-NC 4.0' when 3 then 'https://creativecommons.org/publicdomain/zero/1.0/'
  when 4 then 'Creative Commons Attribution ShareAlike' when 5 then 'all rights reserved' when 6 then '' when 7 then null when 8 then 'https://creativecommons.org/licenses/by-nc-nd/3.0' when 9 then 'public domain' when 10 then 'cc-by-nd-4.0' else 'CC_BY_4_0' end as license,
 case when event_id%9=0 then null when event_id%9=1 then 'May 2021' when event_id%9=2 then 'undated' else cast(cast(ts as date) as string) end as event_date,
 case when event_id%5=0 then cast(2000+event_id%20 as int) else null end as year,
 case when event_id%7=0 then '' when event_id%7=1 then null else concat('sp-',cast(user_id%40 as string)) end as species, concat('sci-',cast(user_id%40 as string)) as scientific_name from events""",
    "tiles": """select p_partkey as tile_id, concat('tileSG-',cast(p_partkey as string)) as relpath, cast((p_partkey*7)%20 as double) as xmin, cast((p_partkey*13)%20 as double) as ymin,
 cast((p_partkey*7)%20+1+p_size%4 as double) as xmax, cast((p_partkey*13)%20+1+p_size%3 as double) as ymax from part""",
    "rasters": """select s_suppkey as raster_id, s_name as path, cast((s_suppkey*5)%17 as double) as xmin, cast((s_suppkey*3)%11 as double) as ymin,
 cast((s_suppkey*5)%17+6 as double) as xmax, cast((s_suppkey*3)%11+5 as double) as ymax from supplier""",
    "tile_px": """select l_suppkey%6 as tile_ord, l_suppkey%20 as row, l_partkey%20 as col,
 case when max(l_orderkey)%5=0 then null else cast(max(l_orderkey) as double) end as v from lineitem group by l_suppkey%6,l_suppkey%20,l_partkey%20""",
    "lc": """select l_suppkey%20 as row, l_partkey%20 as col, case when min(l_orderkey)%9=0 then null else cast(min(l_orderkey)%12 as int) end as cls from lineitem group by l_suppkey%20,l_partkey%20""",
    "emb_px": """select vec_id, label as tile, 2017+vec_id%5 as year, embedding from embeddings""",
    "outputs": """select concat('job_',cast(o_custkey%20 as string)) as job_name, cast(cast(o_orderdate as date) as string) as ts, concat('c',cast(o_custkey%7 as string)) as git_commit, o_orderkey as output_id,
 case o_orderkey%5 when 0 then 'ndvi' when 1 then 'ndmi' when 2 then 'fvc' when 3 then 'rgb' else 'gbif_occurrences' end as variable,
 cast(2017+o_orderkey%6 as string) as year, case o_orderkey%4 when 0 then 'winter' when 1 then 'spring' when 2 then 'summer' else 'autumn' end as season,
 case when o_orderkey%11=0 then null else concat('gs://b/',cast(o_orderkey as string),'.tif') end as gcs_uri from orders""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")

#: Areas of interest by name: the rings of their features, each closed. A holds one polygon twice, D a repeated vertex.
AOIS = {
    "A": [[(4, 4), (12, 4), (12, 12), (4, 12), (4, 4)]] * 2,
    "B": [[(2, 2), (16, 2), (16, 14), (9, 6), (2, 14), (2, 2)]],
    "C": [[(40, 40), (50, 40), (50, 50), (40, 50), (40, 40)]],
    "D": [[(6, 6), (10, 6), (10, 6), (10, 10), (6, 10), (6, 6)]],
    "E": [[(2, 2), (16, 2), (16, 14), (2, 14), (2, 2)]],
}

#: Areas of several rings: H a square with a hole and an island in it, M a triangle and a square with a hole, N a strip beside others.
SHAPES = {
    "H": [[(2, 2), (16, 2), (16, 16), (2, 16), (2, 2)], [(5, 5), (5, 12), (12, 12), (12, 5), (5, 5)], [(7, 7), (9, 7), (9, 9), (7, 9), (7, 7)]],
    "M": [[(0, 12), (6, 12), (0, 19), (0, 12)], [(10, 0), (19, 0), (19, 6), (10, 6), (10, 0)], [(12, 2), (12, 4), (17, 4), (17, 2), (12, 2)]],
    "N": [[(3.25, 0), (3.5, 0), (3.5, 20), (3.25, 20), (3.25, 0)]],
}


def shapes(spark: SparkSession, scale: float = 1.0) -> DataFrame:
    """(aoi_id, rings): areas of several rings, in units of ``scale``."""
    rows = [(k, [[(x * scale, y * scale) for x, y in ring] for ring in rings]) for k, rings in SHAPES.items()]
    return spark.createDataFrame(rows, "aoi_id string, rings array<array<struct<x:double,y:double>>>")


def shape_edges_sql() -> str:
    """The edges of these areas as SQL: (aoi_id, x1, y1, x2, y2)."""
    rows = [f"('{k}', {float(a[0])}e0, {float(a[1])}e0, {float(b[0])}e0, {float(b[1])}e0)" for k, rings in SHAPES.items() for ring in rings for a, b in zip(ring, ring[1:], strict=False)]
    return f"select * from (values {', '.join(rows)}) e(aoi_id, x1, y1, x2, y2)"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the tables of ``sf_dir``; each table is bound by its path, no temporary view stays."""
    text = VIEWS[name]
    table = re.search(r"from (\w+)", text).group(1)
    return spark.sql(re.sub(rf"from {table}\b", "from {source}", text), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def aoi(spark: SparkSession, name: str | None = None) -> DataFrame:
    """(aoi_id, feature_id, ring): one area's features, or those of all areas."""
    rows = [(k, i, [(float(x), float(y)) for x, y in ring]) for k, rings in AOIS.items() if name in (None, k) for i, ring in enumerate(rings)]
    return spark.createDataFrame(rows, "aoi_id string, feature_id int, ring array<struct<x:double,y:double>>")


def aoi_edges_sql(name: str | None = None) -> str:
    """The edges of areas as SQL: (aoi_id, feature_id, x1, y1, x2, y2)."""
    rows = [f"('{k}', {i}, {a[0]}.0e0, {a[1]}.0e0, {b[0]}.0e0, {b[1]}.0e0)" for k, rings in AOIS.items() if name in (None, k) for i, ring in enumerate(rings) for a, b in zip(ring, ring[1:], strict=False)]
    return f"select * from (values {', '.join(rows)}) e(aoi_id, feature_id, x1, y1, x2, y2)"


def with_views(sql: str, **more: str) -> str:
    """DuckDB SQL with the views (and further named queries) that it mentions put before it."""
    known = VIEWS | {f"aoi_{k.lower()}": aoi_edges_sql(k) for k in AOIS} | {"aoi_all": aoi_edges_sql(), "shape_edges": shape_edges_sql()} | more
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b|\bfrom\s+\w+( \w)?, {name}\b", text):
                visit(known[name])
                needed.append(name)

    visit(sql)
    ctes = ", ".join(f"{n} as ({known[n]})" for n in needed)
    return f"with {ctes}{sql if sql.lstrip().startswith(',') else ' ' + sql}" if ctes else sql
