import re

import numpy as np
import pandas as pd
import pytest
from conftest import panel

from airpanel.operators import features as ft
from airpanel.operators import forecast, graph, metrics, splits
from airpanel.session import materialize, shared_dir, temporary_tables


def walk(n, nodes=("A", "B")):
    rng = np.random.default_rng(1)
    return pd.concat([pd.DataFrame({
        "node_id": k, "timestamp": pd.date_range("2024-01-01", periods=n, freq="h"), "aqi": 100 + np.cumsum(rng.normal(size=n)),
    }) for k in nodes], ignore_index=True)


def steps(pairs, last, horizon):
    x, y = np.array(pairs).T
    phi, c = np.polyfit(x, y, 1)
    out = []
    for _ in range(horizon):
        last = c + phi * last
        out.append(last)
    return out


@pytest.mark.parametrize("size", [16, 4096])
def test_backtest_refits_at_every_origin(frame, size):
    pdf = walk(200)
    got = forecast.rolling_origin_forecast(frame(pdf), horizon=6, size=size).toPandas()
    for node, d in pdf.groupby("node_id"):
        y = d["aqi"].to_numpy()
        train, test = y[:140], y[170:]
        mine = got[got["node_id"] == node].sort_values(["origin", "h"])
        assert list(mine["origin"].unique()) == list(range(4)) and len(mine) == 24
        for k in range(4):
            pairs = list(zip(train, train[1:]))
            pairs += [(test[i - 1], test[i]) for i in range(1, k * 6)]
            last = test[k * 6 - 1] if k else train[-1]
            part = mine[mine["origin"] == k]
            np.testing.assert_allclose(part["y_true"], test[k * 6:k * 6 + 6])
            np.testing.assert_allclose(part["y_pred"], steps(pairs, last, 6), rtol=1e-7)


def test_running_sums_of_a_backtest_go_along_chunks(frame):
    plans = [forecast.rolling_origin_forecast(frame(walk(200)), horizon=6, size=s) for s in (4, 4096)]
    specs = re.findall(r"windowspecdefinition\((.*?) ASC", plans[0]._jdf.queryExecution().optimizedPlan().toString())
    by_origin = [s for s in specs if "origin#" in s]
    assert by_origin and all("_chunk#" in s for s in by_origin)
    small, plain = (p.orderBy("node_id", "timestamp").toPandas() for p in plans)
    assert len(small) == 48
    pd.testing.assert_frame_equal(small, plain, rtol=1e-9)


def test_holdout_is_fitted_on_train_only(frame):
    pdf = walk(100)
    parts = splits.chrono_split(frame(pdf))
    got = forecast.holdout_forecast(parts, horizon=5).toPandas()
    split = parts.toPandas().sort_values("timestamp")
    for node, d in split.groupby("node_id"):
        train = d.loc[d["split"] == "train", "aqi"].to_numpy()
        mine = got[got["node_id"] == node].sort_values("h")
        np.testing.assert_allclose(mine["y_pred"], steps(list(zip(train, train[1:])), train[-1], 5), rtol=1e-7)
        np.testing.assert_allclose(mine["y_true"], d.loc[d["split"] == "test", "aqi"].to_numpy()[:5])


def test_node_mae_by_model_and_a_node_without_name(spark):
    rows = [(m, n, f"2024-01-01 0{h}:00:00", 10.0, 10.0 + e) for m, n, e in (("a", "A", 1.0), ("a", None, 3.0), ("b", "A", 5.0)) for h in range(2)]
    df = spark.createDataFrame(rows, "model string, node_id string, timestamp string, y_true double, y_pred double")
    df = df.selectExpr("model", "node_id", "CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp", "y_true", "y_pred")
    got = {(r["model"], r["node_id"]): r["mae"] for r in metrics.node_mae(df.where("node_id IS NOT NULL"), 2, by=["model"]).collect()}
    assert got == {("a", "A"): 1.0, ("b", "A"): 5.0, ("a", "average"): 1.0, ("b", "average"): 5.0}


def test_summary_of_a_run(frame):
    parts = splits.chrono_split(frame(panel(nodes=2, hours=50, keep=1.0, columns=("aqi",))))
    pdf = parts.toPandas()
    row = splits.run_summary(parts).first()
    assert (row["total_rows"], row["train_rows"], row["val_rows"], row["test_rows"]) == (len(pdf), *[(pdf["split"] == p).sum() for p in ("train", "val", "test")])
    assert row["n_features"] == 3 and row["train_std"] == pytest.approx(pdf.loc[pdf["split"] == "train", "aqi"].std())


def test_windows_over_nodes(frame):
    pdf = walk(20).iloc[:-1]  # the second node lacks the last hour
    rows = sorted(ft.node_windows(frame(pdf), window=4, horizon=2, size=8).collect(), key=lambda r: r["timestamp"])
    assert len(rows) == 15 and all(len(r["x"]) == 4 and len(r["y"]) == 2 for r in rows)
    assert [c["node"] for c in rows[0]["x"][0]] == ["A", "B"] and [c["node"] for c in rows[-1]["y"][-1]] == ["A"]
    assert rows[3]["x"][1][1]["value"] == pdf.iloc[20 + 4]["aqi"]


@pytest.mark.parametrize("crowd", [1, 1000])
def test_near_pairs_meet_once_and_are_mirrored(spark, crowd):
    rng = np.random.default_rng(3)
    rows = [(f"S{i:02d}", float(18 + a), float(73 + b)) for i, (a, b) in enumerate(rng.random((60, 2)) * 0.4)]
    rows += [("P1", 89.99, 10.0), ("P2", 89.99, -170.0), ("D1", 0.0, 179.99), ("D2", 0.0, -179.99), ("S00b", *rows[0][1:])]
    df = spark.createDataFrame(rows, "node_id string, lat double, lon double")
    got = [(r["src"], r["dst"]) for r in graph.near_pairs(df, 10.0, crowd=crowd).collect()]
    place = {k: np.radians((a, b)) for k, a, b in rows}

    def km(a, b):
        (p, q), (r, s) = place[a], place[b]
        half = np.sin((r - p) / 2) ** 2 + np.cos(p) * np.cos(r) * np.sin((s - q) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(half))

    want = [(a, b) for a in place for b in place if a != b and km(a, b) <= 10]
    assert len(got) == len(set(got)) and set(got) == set(want)


def test_intermediate_tables_go_with_their_scope(spark):
    from pathlib import Path

    def left():
        return list(Path(shared_dir(spark).removeprefix("file://")).glob("airpanel/scoped-*"))

    with temporary_tables(spark):
        assert materialize(spark.range(5), "scoped").count() == 5 and len(left()) == 1
    assert left() == []
