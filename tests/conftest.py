import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


SF = "/root/testdata/sf0.001"


def duck(sf_dir: str = SF):
    import duckdb

    c = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        c.sql(f"create view {path.stem} as select * from '{path}'")
    return c


def rows(df):
    """Rows as comparable texts, whatever the order; numbers as floats, missing values alike."""
    import numpy as np
    import pandas as pd

    def plain(x):
        if isinstance(x, (list, tuple, np.ndarray)):
            return tuple(map(plain, x))
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and np.isnan(x)):
            return None
        return float(x) if isinstance(x, (int, float, np.integer, np.floating)) and not isinstance(x, (bool, np.bool_)) else bool(x) if isinstance(x, np.bool_) else x

    return sorted(repr(tuple(map(plain, r))) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))
