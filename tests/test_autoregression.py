import math

import numpy as np
import pandas as pd
import pytest
from conftest import panel

from airpanel.operators.autoregression import autocovariances, fit_seasonal_ar, forecast_seasonal_ar, holdout_seasonal_ar


def series(n, order=(), season=0.0, seed=0, period=24, noise=1.0):
    """A series of a known model around 100."""
    rng = np.random.default_rng(seed)
    y = np.zeros(n + 500)
    e = rng.normal(0, noise, len(y))
    bare = np.zeros(len(y))
    for t in range(len(y)):
        bare[t] = e[t] + sum(a * bare[t - j - 1] for j, a in enumerate(order) if t > j)
        y[t] = bare[t] + (season * y[t - period] if t >= period else 0)
    return 100 + y[500:]


def frame_of(nodes: dict, start="2024-01-01") -> pd.DataFrame:
    return pd.concat([
        pd.DataFrame({"node_id": k, "timestamp": pd.date_range(start, periods=len(v), freq="h"), "aqi": v}) for k, v in nodes.items()
    ], ignore_index=True)


def covariances(y, lags):
    d = np.asarray(y) - np.mean(y)
    return np.array([d[k:] @ d[:len(d) - k] / len(d) if k < len(d) else 0.0 for k in range(lags + 1)])


def brute(y, top=5, season=24):
    """(criterion, order, s, weights) of the best model, each order by its own linear equations."""
    y, n = np.asarray(y, float), len(y)
    g = covariances(y, season + top)
    tried = []
    options = [(0.0, g[:top + 1], 1)]
    s = g[season] / g[0] if n >= 2 * season and g[0] > 0 else 0.0
    if s:
        options.append((s, np.array([(1 + s * s) * g[k] - s * (g[k + season] + g[abs(k - season)]) for k in range(top + 1)]), 2))
    for s, c, extra in options:
        for p in range(min(top, n - 1) + 1):
            m = np.array([[c[abs(i - j)] for j in range(p)] for i in range(p)]).reshape(p, p)
            a = np.linalg.solve(m, c[1:p + 1]) if p else np.zeros(0)
            error = c[0] - a @ c[1:p + 1]
            tried.append((n * math.log(max(error, g[0] * 1e-12, 1e-300)) + 2 * (p + extra), p, s, a))
    criterion, p, s, a = min(tried, key=lambda t: (round(t[0], 6), t[1], abs(t[2])))
    w = np.zeros(season + top)
    w[:p] += a
    w[season - 1] += s
    w[season:season + p] -= s * a
    return criterion, p, s, w


def walked(y, w, horizon):
    mean = np.mean(y)
    v = [0.0] * len(w) + list(np.asarray(y) - mean)
    for _ in range(horizon):
        v.append(float(np.dot(w, v[:-len(w) - 1:-1])))
    return mean + np.array(v[-horizon:])


NODES = {
    "flat": series(400, seed=1), "one": series(700, (0.7,), seed=2), "three": series(900, (0.5, -0.4, 0.3), seed=3),
    "daily": series(900, (), 0.8, seed=4), "both": series(1200, (0.6, -0.3), 0.6, seed=5), "short": series(30, (0.9,), seed=6), "two": [1.0, 5.0],
}


@pytest.mark.parametrize("size", [4096, 50])
def test_orders_and_weights_against_linear_equations(spark, frame, size):
    got = {r.node_id: r for r in fit_seasonal_ar(frame(frame_of(NODES)), size=size).collect()}
    assert set(got) == set(NODES)
    for name, y in NODES.items():
        criterion, p, s, w = brute(y)
        r = got[name]
        assert (r.order, r.n) == (p, len(y)), name
        assert r.seasonal == pytest.approx(s, abs=1e-9) and r.criterion == pytest.approx(criterion, rel=1e-9, abs=1e-6)
        np.testing.assert_allclose(r.weights, w, atol=1e-8, err_msg=name)
    assert abs(got["one"].seasonal) < 0.15 and got["one"].order >= 1 and got["three"].order >= 3
    assert got["daily"].seasonal > 0.6 and got["both"].seasonal > 0.4 and got["both"].order >= 2


def test_forecasts_step_by_step(spark, frame):
    made = forecast_seasonal_ar(frame(frame_of(NODES)), horizon=50).toPandas()
    assert made.groupby("node_id").size().eq(50).all()
    for name, y in NODES.items():
        rows = made[made.node_id == name].sort_values("h")
        np.testing.assert_allclose(rows.y_pred, walked(y, brute(y)[3], 50), atol=1e-6, err_msg=name)
        assert rows.timestamp.iloc[0] == pd.Timestamp("2024-01-01") + pd.Timedelta(hours=len(y))


def test_autocovariances_with_missing_values(spark, frame):
    rows = panel(nodes=2, hours=300, columns=("aqi",))
    got = {r.node_id: r for r in autocovariances(frame(rows), "aqi", 29, keep=7, size=40).collect()}
    for name, group in rows.dropna().groupby("node_id"):
        y = group.sort_values("timestamp").aqi.to_numpy()
        np.testing.assert_allclose(got[name].covariances, covariances(y, 29), rtol=1e-8, atol=1e-7)
        assert got[name].n == len(y) and got[name].tail == list(y[-7:])


def test_constant_and_empty_series(spark, frame):
    rows = frame(frame_of({"same": [7.0] * 60, "single": [3.0]}))
    made = forecast_seasonal_ar(rows, horizon=3).collect()
    assert sorted((r.node_id, r.h, r.y_pred) for r in made) == [(n, h, v) for n, v in (("same", 7.0), ("single", 3.0)) for h in (1, 2, 3)]
    assert forecast_seasonal_ar(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        forecast_seasonal_ar(rows, max_order=24)


def test_season_beats_the_first_order_on_daily_series(spark, frame):
    from airpanel.operators.forecast import forecast_ar

    whole = {f"n{i}": series(1824, (0.5,), 0.9, seed=i) for i in range(8)}
    rows = frame(frame_of({k: v[:1800] for k, v in whole.items()}))

    def error(made):
        got = {(r.node_id, r.h): r.y_pred for r in made.collect()}
        return np.mean([abs(got[k, h + 1] - v[1800 + h]) for k, v in whole.items() for h in range(24)])

    assert error(forecast_seasonal_ar(rows)) < 0.8 * error(forecast_ar(rows))


def test_holdout_meets_the_first_test_rows(spark, frame):
    from airpanel.operators.splits import chrono_split

    parts = chrono_split(frame(frame_of({"a": series(600, (0.5,), 0.8, seed=3)})))
    got = sorted((r.h, r.y_pred) for r in holdout_seasonal_ar(parts).collect())
    made = sorted((r.h, r.y_pred) for r in forecast_seasonal_ar(parts.where("split = 'train'")).collect())
    assert [h for h, _ in got] == list(range(1, 25)) and got == made
