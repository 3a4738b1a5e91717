"""Where queries and the SQL that checks them are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **views: str) -> Callable[[Query], Query]:
    """Register a query, with DuckDB SQL over the tables and derived views that gives the same rows."""

    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_views(sql, **views)
        return f

    return put


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to nine decimals, as the last bit may differ between engines."""
    return df.withColumns({c: F.round(c, 9) for c in columns})
