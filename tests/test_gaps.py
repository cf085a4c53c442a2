import numpy as np
import pandas as pd
import pytest
from conftest import collected, panel, same
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from airpanel.functions.clock import hour_index
from airpanel.operators import gaps

SIZES = [7, 50, 4096]


def per_node(pdf, fn):
    return pd.concat([
        fn(d.sort_values("timestamp")).assign(node_id=n) for n, d in pdf.groupby("node_id")
    ]).sort_values(["node_id", "timestamp"]).reset_index(drop=True)


def resampled(pdf, ffill=0, limit=0):
    def one(d):
        g = d.set_index("timestamp")[["x", "y"]].resample("1h").asfreq()
        for c in ("x", "y"):
            if ffill:
                g[c] = g[c].ffill(limit=ffill).interpolate(method="linear", limit=limit)
        return g.reset_index()
    return per_node(pdf, one)


@pytest.fixture(scope="module")
def readings():
    pdf = panel()
    # Readings off the hour: at the start, at the end, and beside one on the hour.
    pdf.loc[0, "timestamp"] += pd.Timedelta(minutes=13)
    pdf.loc[len(pdf) - 1, "timestamp"] += pd.Timedelta(minutes=13)
    extra = pdf.iloc[[20]].assign(timestamp=pdf.loc[20, "timestamp"] + pd.Timedelta(minutes=30), x=99.0)
    return pd.concat([pdf, extra], ignore_index=True)


@pytest.mark.parametrize("size", SIZES)
def test_grid_matches_resample(frame, readings, size):
    got = collected(gaps.hourly_grid(frame(readings), ["x", "y"], size=size))
    want = resampled(readings)
    assert list(got["timestamp"]) == list(want["timestamp"])
    same(got, want, ["x", "y"])


@pytest.mark.parametrize("size", SIZES)
def test_fill_matches_pandas(frame, readings, size):
    got = collected(gaps.hourly_fill(frame(readings), ["x", "y"], 3, 9, size=size))
    want = resampled(readings, 3, 9)
    assert list(got["timestamp"]) == list(want["timestamp"])
    same(got, want, ["x", "y"])


def test_keep_raw(frame, readings):
    got = collected(gaps.hourly_fill(frame(readings), ["x", "y"], 3, 9, keep_raw=True))
    want = resampled(readings).rename(columns={"x": "x_raw", "y": "y_raw"})
    same(got, want, ["x_raw", "y_raw"])


def test_duplicate_timestamps_are_an_error(frame, readings):
    twice = pd.concat([readings, readings.iloc[[5]]])
    with pytest.raises(PySparkException, match="duplicate timestamp"):
        gaps.hourly_grid(frame(twice), ["x"]).collect()


def series(values):
    return pd.DataFrame({
        "node_id": "A", "timestamp": pd.date_range("2024-01-01", periods=len(values), freq="h"),
        "x": np.array(values, dtype=float),
    })


N = np.nan


@pytest.mark.parametrize("values, want", [
    ([10] + [N] * 15 + [42],
     [10, 10, 10, 10, 12.462, 14.923, 17.385, 19.846, 22.308, 24.769, 27.231, 29.692, 32.154, N, N, N, 42]),
    ([42] + [N] * 14, [42] * 13 + [N, N]),
    ([N, N, 5, N, 7], [N, N, 5, 5, 7]),
])
@pytest.mark.parametrize("size", [3, 4096])
def test_known_gaps(frame, values, want, size):
    got = collected(gaps.hourly_fill(frame(series(values)), ["x"], 3, 9, size=size))
    np.testing.assert_allclose(got["x"].astype(float), want, atol=5e-4)


@pytest.mark.parametrize("size", SIZES)
def test_row_fills_match_pandas(frame, size):
    pdf = panel(seed=3)
    df = frame(pdf)

    def check(got, fn):
        def one(d):
            d = d.copy()
            for c in ("x", "y"):
                d[c] = fn(d[c])
            return d
        same(collected(got), per_node(pdf, one), ["x", "y"])

    check(gaps.ffill_limit(df, ["x", "y"], 2, size=size), lambda s: s.ffill(limit=2))
    check(gaps.interpolate_limit(df, ["x", "y"], 4, size=size), lambda s: s.interpolate(limit=4))
    check(gaps.ffill_bfill(df, ["x", "y"], size=size), lambda s: s.ffill().bfill())
    check(gaps.interpolate_fill(df, ["x", "y"], 2, size=size),
          lambda s: s.interpolate(limit=2).ffill().bfill())


def test_ffill_on_grid_needs_no_counting(frame):
    grid = gaps.hourly_grid(frame(panel(seed=4)), ["x", "y"])
    a = collected(gaps.ffill_limit(grid, ["x", "y"], 3, size=11))
    b = collected(gaps.ffill_limit(grid, ["x", "y"], 3, position=hour_index("timestamp"), size=11))
    same(a, b, ["x", "y"])


def test_node_without_any_value_stays_empty(frame):
    pdf = pd.concat([panel(1), series([N] * 30)])
    got = collected(gaps.ffill_bfill(frame(pdf), ["x"], size=7))
    assert got[got["node_id"] == "A"]["x"].isna().all()


def test_clean_panel_drops_what_cannot_be_filled(frame):
    pdf = panel(columns=("pm25", "pm10"), seed=5)
    got = collected(gaps.clean_panel(frame(pdf), size=50))
    want = per_node(pdf, lambda d: d.set_index("timestamp")[["pm25", "pm10"]].resample("1h").asfreq()
                    .ffill(limit=3).interpolate(limit=9).dropna().reset_index())
    assert list(got["timestamp"]) == list(want["timestamp"])
    same(got, want, ["pm25", "pm10"])


def test_nan_and_odd_names_in_the_grid(spark):
    rows = [("A", "2024-01-01 00:00:00", 1.0), ("A", "2024-01-01 02:00:00", float("nan")), ("A", "2024-01-01 03:00:00", 4.0)]
    df = spark.createDataFrame(rows, "node_id string, timestamp string, `PM2.5` double").selectExpr(
        "node_id", "CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp", "`PM2.5`")
    got = [r["PM2.5"] for r in gaps.hourly_fill(df, hold=1, line=5).orderBy("timestamp").collect()]
    assert got == [1.0, 1.0, 2.5, 4.0]
    assert [r["PM2.5"] for r in gaps.hourly_grid(df).orderBy("timestamp").collect()] == [1.0, None, None, 4.0]


def test_dense_readings_are_split_by_their_number(frame):
    """Readings every 10 seconds of one node, beside a node with one an hour."""
    dense = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=6 * 60 * 30, freq="10s")}).assign(node_id="A")
    dense["x"] = np.arange(len(dense), dtype=float)
    dense = dense[(dense["timestamp"].dt.hour % 5 != 2)]  # some hours are missing
    hourly = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=400, freq="h"), "node_id": "B", "x": 1.0})
    df = frame(pd.concat([dense, hourly], ignore_index=True))
    plain = collected(gaps.hourly_fill(df, ["x"], hold=1, line=2))
    split = gaps.hourly_fill(df, ["x"], hold=1, line=2, most=1000, keep_chunk=True)
    assert plain.equals(collected(split.drop("_chunk")))
    chunks = split.groupBy("node_id").agg(F.count_distinct("_chunk").alias("n"), F.min("_chunk").alias("first"))
    found = {r.node_id: r.n for r in chunks.collect()}
    assert found["A"] >= 7 and found["B"] == 1


def test_chunk_numbers_rise_with_time(frame, readings):
    rows = gaps.hourly_fill(frame(readings), hold=1, most=20, keep_chunk=True).toPandas().sort_values(["node_id", "timestamp"])
    for _, group in rows.groupby("node_id"):
        assert group["_chunk"].is_monotonic_increasing
