"""Every registered geospatial query against its SQL, and what their plans may hold."""

import re

import pytest
from conftest import SF, duck, rows

from geoquilt.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    found = QUERIES[name](spark, SF).toPandas()
    wanted = connection.sql(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", ["j1_points_in_aoi", "j3_tile_overlap", "j5_scene_intersects", "j2_pixels_in_aoi", "j6_nearest_scene"])
def test_spatial_joins_are_hash_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    executed = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in executed
    if name != "j3_tile_overlap":  # its only loop is over three single rows
        assert "BroadcastNestedLoopJoin" not in executed


def test_filters_and_columns_reach_the_scan(spark):
    execution = QUERIES["flagship_ndvi_summer"](spark, SF)._jdf.queryExecution()
    plan = execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan)[1]
    assert "l_quantity" not in plan and "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan" in pushed
