import numpy as np
import pandas as pd
import pytest
from conftest import collected, panel, same
from pyspark.sql import functions as F

from airpanel.catalog import ORACLES, QUERIES
from airpanel.operators import chunks
from airpanel.operators import features as ft

SIZES = [5, 60, 4096]


@pytest.fixture(scope="module")
def rows():
    return panel(columns=("aqi", "pm25", "pm10"), seed=7).dropna().reset_index(drop=True)


def by_node(pdf, fn):
    return pd.concat([fn(d.sort_values("timestamp").copy()) for _, d in pdf.groupby("node_id")]).sort_values(
        ["node_id", "timestamp"]).reset_index(drop=True)


@pytest.mark.parametrize("size", SIZES)
def test_positions(frame, rows, size):
    got = collected(chunks.with_positions(frame(rows), size=size, total="n"))
    want = by_node(rows, lambda d: d.assign(position=range(len(d)), n=len(d)))
    assert list(got["position"]) == list(want["position"]) and list(got["n"]) == list(want["n"])


@pytest.mark.parametrize("size", SIZES)
def test_lags_and_rolling_match_pandas(frame, rows, size):
    def one(d):
        for k in (1, 6, 24):
            d[f"aqi_lag_{k}h"] = d["aqi"].shift(k)
        for n in (24, 72):
            d[f"pm25_{n}h_mean"] = d["pm25"].rolling(n, min_periods=1).mean()
            d[f"pm25_{n}h_std"] = d["pm25"].rolling(n, min_periods=1).std()
        d["aqi_diff"] = d["aqi"].diff().fillna(0)
        return d

    want = by_node(rows, one)
    df = frame(rows)
    got = collected(ft.lag_features(df, size=size))
    same(got, want, [f"aqi_lag_{k}h" for k in (1, 6, 24)])
    got = collected(ft.rolling_features(df, size=size))
    same(got, want, [f"pm25_{n}h_{s}" for n in (24, 72) for s in ("mean", "std")], 1e-8)
    same(collected(ft.rate_of_change(df, size=size)), want, ["aqi_diff"])


def test_advanced_rolling_and_filled_lags(frame, rows):
    def one(d):
        for n in (6, 12, 24):
            d[f"pm10_roll_{n}h"] = d["pm10"].rolling(n, min_periods=1).mean()
        for n in (6, 24):
            d[f"pm10_std_{n}h"] = d["pm10"].rolling(n, min_periods=1).std().fillna(0)
        for k in (1, 3, 6, 12, 24):
            d[f"aqi_lag_{k}h"] = d["aqi"].shift(k).fillna(rows["aqi"].median())
        return d

    want = by_node(rows, one)
    same(collected(ft.advanced_rolling(frame(rows), size=9)), want,
         [c for c in want if "_roll_" in c or "_std_" in c], 1e-8)
    same(collected(ft.lag_median_filled(frame(rows), size=9)), want, [c for c in want if "_lag_" in c])


def test_rolling_known_values(frame):
    pdf = pd.DataFrame({"node_id": "A", "timestamp": pd.date_range("2024-01-01", periods=4, freq="h"),
                        "pm25": [1, np.nan, 3, 4]})
    w = lambda fn: (lambda w: fn("pm25").over(w.rowsBetween(-1, 0)))
    got = collected(chunks.windowed(frame(pdf), {"m": w(F.avg), "s": w(F.stddev_samp)}, lookback=1, size=2))
    np.testing.assert_allclose(got["m"], [1, 1, 3, 3.5])
    np.testing.assert_allclose(got["s"].astype(float), [np.nan, np.nan, np.nan, 0.70710678])


def even(nodes, n):
    return pd.concat([pd.DataFrame({
        "node_id": f"N{k}", "timestamp": pd.date_range("2024-01-01", periods=n, freq="h"),
        "aqi": np.arange(n, dtype=float) + 1000 * k, "pm25": np.arange(n, dtype=float),
    }) for k in range(nodes)])


@pytest.mark.parametrize("nodes, want", [(1, 165), (2, 330)])
@pytest.mark.parametrize("size", [13, 4096])
def test_sliding_windows(frame, nodes, want, size):
    out = ft.sliding_windows(frame(even(nodes, 200)), ["pm25", "aqi"], window=24, horizon=12, size=size).collect()
    assert len(out) == want
    for r in out:
        first = r["x"][0]["aqi"]
        assert [v["aqi"] for v in r["x"]] == [first + i for i in range(24)]
        assert r["y"] == [first + 24 + i for i in range(12)]


def test_windows_keep_nulls_in_place(frame):
    pdf = even(1, 40)
    pdf.loc[pdf.index[10], ["aqi", "pm25"]] = np.nan
    out = ft.sliding_windows(frame(pdf), ["pm25"], window=6, horizon=4, size=7).collect()
    assert len(out) == 31 and all(len(r["x"]) == 6 and len(r["y"]) == 4 for r in out)


def test_too_short_series_has_no_window(frame):
    assert ft.sliding_windows(frame(even(1, 95)), ["aqi"]).count() == 0


def test_single_target_and_matrix_windows(frame):
    one = ft.single_target_windows(frame(even(1, 50)), ["aqi"], window=10, horizon=5, size=8).collect()
    assert len(one) == 36 and all(r["y"] == r["x"][0]["aqi"] + 14 for r in one)
    many = ft.matrix_windows(frame(even(1, 50)), ["pm25", "aqi"], window=10, horizon=5).collect()
    assert len(many) == 36 and all(len(r["x"]) == 10 and len(r["x"][0]) == 2 for r in many)


def test_pivoted_nodes_are_entities(frame):
    wide = ft.pivot_nodes(frame(even(2, 30)), ["N0", "N1"])
    assert wide.columns == ["timestamp", "N0", "N1"] and wide.count() == 30
    out = ft.matrix_windows(wide, ["N0", "N1"], target="N0", window=4, horizon=2, keys=()).collect()
    assert len(out) == 25 and out[0]["x"][0][1] - out[0]["x"][0][0] == 1000


@pytest.mark.parametrize("horizon, want", [(2, [5, 6, 1, 2, 3, 4]), (8, [5, 6, 1, 2, 3, 4]), (6, [1, 2, 3, 4, 5, 6])])
def test_persistence_circular(frame, horizon, want):
    pdf = even(1, 6).assign(aqi=[1.0, 2, 3, 4, 5, 6])
    got = collected(ft.persistence_circular(frame(pdf), horizon=horizon, size=4))
    assert list(got["y_pred"]) == want


@pytest.mark.parametrize("horizon, size", [(5, 8), (24, 4096), (40, 30)])
def test_persistence_circular_places_every_row(frame, horizon, size):
    pdf = panel(nodes=3, hours=200, keep=0.6, columns=("aqi",), seed=size)
    out = ft.persistence_circular(frame(pdf), horizon=horizon, size=size)
    want = by_node(pdf, lambda d: d.assign(position=range(len(d)), y_pred=np.roll(d["aqi"], horizon)))
    same(collected(out), want, ["position", "aqi", "y_pred"])


def test_persistence_circular_query_returns_places(spark):
    assert "a.position" in ORACLES["persistence_circular"]
    assert "position" in QUERIES["persistence_circular"](spark, "/root/testdata/sf0.001").columns


def test_persistence_last_and_tail(frame):
    out = ft.persistence_last(frame(even(2, 30)), horizon=3).collect()
    assert sorted(tuple(r) for r in out) == [("N0", h, 29.0) for h in (1, 2, 3)] + [("N1", h, 1029.0) for h in (1, 2, 3)]
    tail = collected(ft.tail_context(frame(even(2, 30)), 7, size=4))
    assert list(tail["pm25"]) == [float(v) for v in range(23, 30)] * 2


@pytest.mark.parametrize("n, tail, context, cap", [(400, 30, 60, None), (400, 1000, 100, None), (300, 40, 50, 48), (100, 30, 60, None), (400, None, None, None), (400, 5, 7, None)])
def test_rolling_origin(frame, n, tail, context, cap):
    pdf = even(1, n)
    y = pdf["aqi"].to_numpy()
    train, test = y[: int(n * 0.7)], y[int(n * (0.7 + 0.15)):]
    want, made = {}, 0
    for i in range(0, len(test) - 12, 12):
        seen = np.concatenate([train[-(tail or n):], test[:i]])[-(context or n):]
        want[i // 12] = (len(seen), seen.mean(), seen[-1])
        made += 12
        if cap and made >= cap:
            break
    got = ft.rolling_origin(frame(pdf), horizon=12, train_tail=tail, context=context, max_predictions=cap).collect()
    got = {r["origin"]: (r["context_rows"], r["context_mean"], r["context_last"]) for r in got}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_global_index(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS a", "hash(id) AS b").repartition(5)
    rows = chunks.global_index(df, ["a", "b", "id"]).collect()
    order = [r["id"] for r in sorted(rows, key=lambda r: (r["a"], r["b"], r["id"]))]
    assert [r["id"] for r in sorted(rows, key=lambda r: r["index"])] == order
    assert sorted(r["index"] for r in rows) == list(range(1000))


def test_no_window_runs_over_a_whole_node(frame, rows):
    """Frames over rows are partitioned by node and chunk; only summaries by node alone."""
    plan = ft.lag_features(frame(rows))._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [lag" in line or "Window [row_number" in line:
            assert "_chunk" in line or "_tc" in line


def scans(df) -> int:
    """How often the plan that ran reads its source: once for every shuffle of the facts that is not shared."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Range (0, ")


@pytest.mark.parametrize("make", [
    lambda df: ft.lag_features(df), lambda df: ft.rolling_features(df, ("aqi",)), lambda df: ft.sliding_windows(df, ["aqi"], window=5, horizon=2),
], ids=["lag_features", "rolling_mean", "sliding_windows"])
def test_frames_shuffle_the_facts_once(spark, make):
    hours = 60_000  # 15 chunks
    df = spark.range(hours).selectExpr("'N1' AS node_id", "timestampadd(HOUR, id, TIMESTAMP_NTZ'2000-01-01 00:00:00') AS timestamp", "CAST(id AS DOUBLE) AS aqi")
    assert scans(make(df)) == 1


@pytest.mark.parametrize("size", [3, 7, 30])
def test_frames_of_chunks_shorter_than_their_looks(frame, size):
    """Chunks with few rows or none, looks that span several of them."""
    rng = np.random.default_rng(size)
    pdf = panel(nodes=2, hours=240, keep=0.4, columns=("aqi",), seed=size).dropna()
    pdf["aqi"] = rng.normal(size=len(pdf)).round(3)
    out = chunks.windowed(
        frame(pdf), {"back": lambda w: F.lag("aqi", 9).over(w), "mean": lambda w: F.avg("aqi").over(w.rowsBetween(-11, 5)),
                     "ahead": lambda w: F.lead("aqi", 8).over(w)}, lookback=11, lookahead=8, size=size)
    want = by_node(pdf, lambda d: d.assign(
        back=d["aqi"].shift(9), ahead=d["aqi"].shift(-8), mean=[d["aqi"].iloc[max(0, i - 11):i + 6].mean() for i in range(len(d))]))
    same(collected(out), want, ["aqi", "back", "ahead", "mean"])
