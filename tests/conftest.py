import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airpanel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """pandas to Spark: wall-clock timestamps, NaN as NULL."""

    def make(pdf: pd.DataFrame):
        df = spark.createDataFrame(pdf)
        fixes = {}
        for name, kind in df.dtypes:
            if kind == "timestamp":
                fixes[name] = F.col(name).cast("timestamp_ntz")
            elif kind == "double":
                fixes[name] = F.when(~F.isnan(name), F.col(name))
        return df.withColumns(fixes) if fixes else df

    return make


def panel(nodes=3, hours=300, keep=0.7, seed=0, columns=("x", "y")) -> pd.DataFrame:
    """Random hourly readings with missing hours, missing values and a long gap."""
    rng = np.random.default_rng(seed)
    parts = []
    for n in range(nodes):
        d = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=hours, freq="h")})
        d.insert(0, "node_id", f"N{n + 1:02d}")
        for c in columns:
            d[c] = (rng.random(hours) * 100).round(2)
            d.loc[rng.random(hours) < 0.3, c] = np.nan
        here = rng.random(hours) < keep
        here[hours // 3: hours // 3 + 30] = False
        parts.append(d[here])
    return pd.concat(parts, ignore_index=True)


def collected(df, by=("node_id", "timestamp")) -> pd.DataFrame:
    return df.toPandas().sort_values(list(by)).reset_index(drop=True)


def same(got: pd.DataFrame, want: pd.DataFrame, columns, tol=1e-9) -> None:
    assert len(got) == len(want)
    for c in columns:
        a, b = got[c].astype(float).to_numpy(), want[c].astype(float).to_numpy()
        np.testing.assert_allclose(a, b, rtol=tol, atol=tol, err_msg=c)
