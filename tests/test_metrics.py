import numpy as np
import pandas as pd
import pytest

from airpanel.operators import metrics as M


def value(spark, expr, t, p, b=None):
    rows = [tuple(map(float, r)) for r in zip(t, p, b or t)]
    return spark.createDataFrame(rows, "y_true double, y_pred double, y_baseline double").agg(expr).first()[0]


@pytest.mark.parametrize("expr, t, p, want", [
    (M.mae, [1, 2, 3], [2, 3, 4], 1.0),
    (M.rmse, [1, 2, 3], [1, 2, 3], 0.0),
    (M.rmse, [0, 0], [3, 4], np.sqrt(12.5)),
    (M.mape, [100, 200], [90, 180], 10.0),
    (M.r2, [1, 2, 3], [1, 2, 3], 1.0),
    (M.r2, [1, 2, 3], [2, 2, 2], 0.0),
    (M.r2, [5, 5, 5], [1, 2, 3], 0.0),
    (M.category_accuracy, [25, 75, 150, 250], [25, 75, 250, 350], 0.5),
    (M.category_accuracy, [25, 75, 150], [75, 150, 250], 0.0),
    (M.adjacent_category_accuracy, [25, 75, 150], [75, 150, 250], 1.0),
    (M.adjacent_category_accuracy, [25, 450], [25, 25], 0.5),
])
def test_known_values(spark, expr, t, p, want):
    assert value(spark, expr(), t, p) == pytest.approx(want)


@pytest.mark.parametrize("p, b, want", [
    ([1, 2, 3], [2, 3, 4], 1.0), ([2, 3, 4], [2, 3, 4], 0.0), ([3, 4, 5], [2, 3, 4], -3.0), ([9, 9, 9], [1, 2, 3], 0.0),
])
def test_skill(spark, p, b, want):
    assert value(spark, M.skill_score(), [1, 2, 3], p, b) == pytest.approx(want)


def test_combined_loss(spark):
    t, p = np.array([10.0, 0, -5]), np.array([12.0, 1, 5])
    for alpha in (0.7, 0.8):
        want = alpha * np.abs(p - t).mean() + (1 - alpha) * 100 * (np.abs(p - t) / (np.abs(t) + 1)).mean()
        assert value(spark, M.combined_loss(alpha=alpha), t, p) == pytest.approx(want)


@pytest.fixture(scope="module")
def long(frame):
    rng = np.random.default_rng(3)
    parts = []
    for model, noise in (("a", 10), ("b", 60)):
        t = rng.random(200) * 500
        parts.append(pd.DataFrame({
            "model": model, "node_id": np.repeat(["N1", "N2"], 100),
            "timestamp": np.tile(pd.date_range("2024-01-01", periods=100, freq="h"), 2),
            "y_true": t, "y_pred": t + rng.normal(size=200) * noise, "y_baseline": t + 30,
        }))
    pdf = pd.concat(parts, ignore_index=True)
    return pdf, frame(pdf)


def test_all_metrics_match_numpy(long):
    pdf, df = long
    got = M.all_metrics(df, baseline="y_baseline").toPandas().set_index("model")
    for model, d in pdf.groupby("model"):
        t, p, b = d["y_true"], d["y_pred"], d["y_baseline"]
        g = got.loc[model]
        assert g["mae"] == pytest.approx((t - p).abs().mean())
        assert g["rmse"] == pytest.approx(np.sqrt(((t - p) ** 2).mean()))
        assert g["r2"] == pytest.approx(1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum())
        assert g["skill_score"] == pytest.approx(1 - ((t - p) ** 2).mean() / ((t - b) ** 2).mean())
        assert g["rmse"] >= g["mae"]
        assert g["adjacent_category_accuracy"] >= g["category_accuracy"]
    assert "skill_score" not in M.all_metrics(df).columns


def test_breakdown_sums_to_all(long):
    rows = M.category_error_breakdown(long[1]).collect()
    assert all(r["correct"] + r["off_by_one"] + r["wrong"] == pytest.approx(100) for r in rows)


def test_horizons(spark):
    df = spark.createDataFrame(
        [("m", [1.0, 2.0, 3.0], [2.0, 2.0, 6.0]), ("m", [1.0, 5.0, 3.0], [4.0, 5.0, 4.0])],
        "model string, y_true array<double>, y_pred array<double>",
    )
    got = {r["h"]: r["mae"] for r in M.horizon_metrics(df, horizons=[1, 3, 6]).collect()}
    assert got == {1: 2.0, 3: 2.0}


def test_node_mae_skips_short_nodes(frame):
    ts = pd.date_range("2024-01-01", periods=30, freq="h")
    pdf = pd.concat([
        pd.DataFrame({"node_id": n, "timestamp": ts[:k], "y_true": 1.0, "y_pred": p, })
        for n, k, p in (("A", 30, 2.0), ("B", 24, 4.0), ("C", 23, 9.0))
    ])
    pdf.loc[(pdf["node_id"] == "A") & (pdf["timestamp"] >= ts[24]), "y_pred"] = 100.0
    got = {r["node_id"]: r["mae"] for r in M.node_mae(frame(pdf), size=10).collect()}
    assert got == {"A": 1.0, "B": 3.0, "average": 2.0}


def test_ensemble_and_alignment(long):
    pdf, df = long
    mean = M.ensemble_mean(df.drop("y_true").withColumnRenamed("y_baseline", "y_true"), ["node_id", "timestamp"])
    assert mean.count() == 200
    wide = M.aligned_forecasts(df, ["a", "b"]).toPandas().sort_values(["node_id", "timestamp"])
    np.testing.assert_allclose(wide["a"], pdf[pdf["model"] == "a"]["y_pred"])


def test_comparison_table(spark):
    rows = [("ARIMA", 87.36, 112.45, 45.2, 0.42, 0.58, 0.82), ("LSTM", 19.5, 25.0, 9.0, 0.9, 0.7, 0.99),
            ("Other", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    names = ["mae", "rmse", "mape", "r2", "category_accuracy", "adjacent_category_accuracy"]
    df = spark.createDataFrame(rows, ["model", *names])
    got = {r["Model"]: r.asDict() for r in M.comparison_table(df).collect()}
    assert got["ARIMA"] == {
        "Model": "ARIMA", "MAE": "87.36", "RMSE": "112.45", "MAPE (%)": "45.20", "R²": "0.4200",
        "Category Accuracy": "58.0%", "Adjacent Cat. Acc.": "82.0%", "Target MAE": "≤30", "Target Met": "No",
    }
    assert got["LSTM"]["Target Met"] == "Yes" and got["Other"]["Target MAE"] == "N/A"
