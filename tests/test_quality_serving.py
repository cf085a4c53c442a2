import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from conftest import panel

from airpanel.operators import forecast, quality, serving, summaries
from airpanel.operators.gaps import hourly_fill


def test_null_report(frame):
    df = frame(pd.DataFrame({"a": [1.0, np.nan, np.nan, 4], "b": [1.0, 2, 3, 4]}))
    got = {r["column"]: (r["nulls"], r["percent"]) for r in quality.null_report(df).collect()}
    assert got == {"a": (2, 50.0), "b": (0, 0.0)}
    with pytest.raises(quality.DataValidationError, match=r"a: 2 NULLs \(50.00%\)"):
        quality.require_no_nulls(df)
    assert quality.require_no_nulls(df, ["b"]) is df


def test_range_report(frame):
    row = quality.range_report(frame(pd.DataFrame({"aqi": [-1.0, 0, 500, 501, 600, np.nan]}))).first()
    assert tuple(row) == (1, 2)


@pytest.fixture
def valid():
    ts = pd.date_range("2024-01-01", periods=10, freq="h")
    return pd.concat([pd.DataFrame({"node_id": n, "timestamp": ts, "aqi": 100.0}) for n in ("A", "B", "C")],
                     ignore_index=True)


def violations(frame, pdf, expected=("A", "B", "C")):
    want = frame(pd.DataFrame({"node_id": list(expected)}))
    return sorted((r["check"], r["node_id"], r["found"]) for r in quality.validate_panel(frame(pdf), want).collect())


def test_valid_panel_has_no_violation(frame, valid):
    assert violations(frame, valid) == []


def test_violations(frame, valid):
    bad = valid.drop(index=[12, 13])  # two hours of B
    bad.loc[20, "aqi"] = np.nan
    bad.loc[21, "aqi"] = 501
    bad.loc[22, "timestamp"] += pd.Timedelta(days=9)
    assert violations(frame, bad, ("A", "B", "C", "D")) == [
        ("mismatched_timestamps", "B", 2), ("mismatched_timestamps", "C", 2), ("missing_node", "D", 1),
        ("null_values", "C", 1), ("out_of_range", "C", 1),
    ]


@pytest.mark.parametrize("size", [3, 4096])
def test_continuity(frame, valid, size):
    assert quality.hourly_continuity(frame(valid), size=size).count() == 0
    rows = quality.hourly_continuity(frame(valid.drop(index=[4, 5])), size=size).collect()
    assert [(r["node_id"], r["minutes"]) for r in rows] == [("A", 180)]


def test_reports_of_cleaning(frame):
    pdf = panel(columns=("pm25", "pm10"))
    filled = hourly_fill(frame(pdf), ["pm25", "pm10"], 3, 9, keep_raw=True)
    report = {r["column"]: r for r in quality.fill_report(filled, ["pm25"]).collect()}["pm25"]
    total = filled.count()
    assert report["filled"] + report["left"] + pdf["pm25"].notna().sum() == total
    dropped = quality.drop_report(frame(pdf)).first()
    assert dropped["kept"] == len(pdf.dropna()) and dropped["dropped"] == len(pdf) - len(pdf.dropna())
    clip = quality.clip_report(frame(pdf), {"pm25": (10.0, 90.0), "pm10": (None, None)}).collect()
    want = ((pdf["pm25"] < 10) | (pdf["pm25"] > 90)).sum()
    assert [tuple(r) for r in clip] == [("pm25", want), ("pm10", 0)]


def test_summaries(frame, valid):
    valid.loc[valid["node_id"] == "B", "aqi"] = 130.0
    row = summaries.series_range(frame(valid)).first()
    assert (row["rows"], row["lowest"], row["highest"], row["mean"]) == (30, 100.0, 130.0, 110.0)
    means = {r["node_id"]: r["difference"] for r in summaries.node_means(frame(valid), "A").collect()}
    assert means == {"A": 0.0, "B": 30.0, "C": 0.0}


def test_explode_forecast(spark):
    df = spark.createDataFrame([("S", "ar", [50.5, -3.0, 612.04, 100.04])],
                               "station_id string, model string, values array<double>")
    df = df.selectExpr("*", "TIMESTAMP_NTZ'2024-01-01 22:00:00' AS base_time")
    rows = serving.explode_forecast(df, 3).orderBy("hour").collect()
    assert [(r["hour"], str(r["timestamp"]), r["aqi"], r["category"], r["color"]) for r in rows] == [
        (0, "2024-01-01 22:00:00", 50.5, "Severe", "#8F3F97"),
        (1, "2024-01-01 23:00:00", 0.0, "Good", "#00E400"),
        (2, "2024-01-02 00:00:00", 500.0, "Severe", "#8F3F97"),
    ]
    assert {r["current_aqi"] for r in rows} == {50.5}
    long = df.withColumn("values", F.array_repeat(F.lit(7.0), 90))
    assert serving.explode_forecast(df).count() == 4 and serving.explode_forecast(long).count() == 90
    for wrong in (0, 73):
        with pytest.raises(ValueError):
            serving.explode_forecast(df, wrong)


def test_heatmap_points_and_stations(spark):
    nodes = spark.createDataFrame([("A", 1.0, 2.0), ("B", 3.0, 4.0)], "node_id string, lat double, lon double")
    values = spark.createDataFrame([("A", 450.0)], "node_id string, aqi double")
    got = {r["node_id"]: r for r in serving.heatmap_points(nodes, values).collect()}
    assert (got["A"]["category"], got["A"]["color"], got["A"]["radius"], got["A"]["intensity"]) == (
        "Severe", "#7E0023", pytest.approx(23.3), 0.9)
    assert (got["B"]["aqi"], got["B"]["category"], got["B"]["radius"]) == (100.0, "Satisfactory", pytest.approx(11.4))
    assert [r["count"] for r in serving.station_dim(nodes, "node_id").collect()] == [2, 2]


def walk(n=200, nodes=("A", "B")):
    rng = np.random.default_rng(0)
    return pd.concat([pd.DataFrame({
        "node_id": k, "timestamp": pd.date_range("2024-01-01", periods=n, freq="h"),
        "aqi": 100 + np.cumsum(rng.normal(size=n)), "x": rng.random(n),
    }) for k in nodes], ignore_index=True)


@pytest.mark.parametrize("size", [11, 4096])
def test_ar_matches_iteration(frame, size):
    pdf = walk()
    got = forecast.forecast_ar(frame(pdf), horizon=5, size=size).toPandas()
    for node, d in pdf.groupby("node_id"):
        y = d["aqi"].to_numpy()
        phi, c = np.polyfit(y[:-1], y[1:], 1)
        value, want = y[-1], []
        for _ in range(5):
            value = c + phi * value
            want.append(value)
        mine = got[got["node_id"] == node].sort_values("h")
        np.testing.assert_allclose(mine["y_pred"], want, rtol=1e-8)
        assert list(mine["timestamp"]) == list(d["timestamp"].iloc[-1] + pd.to_timedelta(range(1, 6), unit="h"))


def test_seasonal_repeats_the_last_day(frame):
    pdf = walk(nodes=("A",))
    got = forecast.forecast_seasonal(frame(pdf), horizon=30).toPandas().sort_values("h")
    last = pdf["aqi"].to_numpy()[-24:]
    np.testing.assert_allclose(got["y_pred"], np.concatenate([last, last[:6]]))


def test_pooled_matches_least_squares(frame):
    from airpanel.operators.splits import chrono_split

    pdf = walk()
    df = chrono_split(frame(pdf))
    got = forecast.forecast_pooled(df, ["aqi", "x"], horizons=[2], size=50).toPandas().sort_values(["node_id", "timestamp"])
    split = df.toPandas().sort_values(["node_id", "timestamp"])
    split["y"] = split.groupby("node_id")["aqi"].shift(-2)
    split["s"] = split.groupby("node_id")["split"].shift(-2)
    fit = split[split["s"] == "train"]
    a = np.column_stack([fit[["aqi", "x"]], np.ones(len(fit))])
    w = np.linalg.lstsq(a, fit["y"], rcond=None)[0]
    test = split[(split["split"] == "test") & split["y"].notna()]
    np.testing.assert_allclose(got["y_true"], test["y"])
    np.testing.assert_allclose(got["y_pred"], test[["aqi", "x"]].to_numpy() @ w[:2] + w[2], rtol=1e-4)


def test_a_repeat_does_not_make_up_for_a_gap(spark):
    hours = {"A": [0, 1, 2], "B": [0, 0, 2], "C": [0, 0, 1, 2], "D": [0, 0, 1, 2, 9], "E": [2, 1, 0]}
    rows = [(n, f"2024-01-01 0{h}:00:00", 10.0) for n, hs in hours.items() for h in hs]
    df = spark.createDataFrame(rows, "node_id string, timestamp string, aqi double").selectExpr(
        "node_id", "CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp", "aqi")
    found = {r["node_id"]: r["found"] for r in quality.validate_panel(df).collect()}
    assert found == {"B": 2, "C": 1, "D": 2}
    nan = df.withColumn("aqi", F.lit(float("nan")))
    assert {r["check"] for r in quality.validate_panel(nan.where("node_id = 'A'")).collect()} == {"null_values"}


def test_constant_and_single_values_are_repeated(spark):
    rows = [("A", f"2024-01-01 0{h}:00:00", 7.0) for h in range(5)] + [("B", "2024-01-01 00:00:00", 3.0)]
    df = spark.createDataFrame(rows, "node_id string, timestamp string, aqi double").selectExpr(
        "node_id", "CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp", "aqi")
    got = {(r["node_id"], r["h"]): r["y_pred"] for r in forecast.forecast_ar(df, horizon=2).collect()}
    assert got == {("A", 1): 7.0, ("A", 2): 7.0, ("B", 1): 3.0, ("B", 2): 3.0}
