import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airpanel.operators import boosting
from airpanel.operators.boosting import UNIT, best_split, fit_boosted, forecast_boosted
from airpanel.operators.forecast import forecast_pooled


def table(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(3)
    y = np.where(x[:, 0] > 0.3, 5.0, -2.0) + np.where(x[:, 1] * x[:, 0] > 0, 3.0, 0.0) + rng.normal(0, 0.2, n).round(3)
    return pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c d": x[:, 2], "y": y.round(3)})


def brute(x, y, bounds, trees, depth, bins, rate, least):
    """Predictions in units, every split tried by itself."""
    def bin_of(v, low, high):
        return 0 if v < low else bins + 1 if v >= high else int((v - low) / (high - low) * bins) + 1

    cells = np.array([[bin_of(v, *bounds[f]) for f, v in enumerate(row)] for row in x])
    units = np.array([round(v / UNIT) for v in y])
    start = round(int(units.sum()) / len(units))
    made = np.full(len(y), start)
    for _ in range(trees):
        residual, at = units - made, np.ones(len(y), int)
        leaves, alive = {}, {1}
        for _ in range(depth):
            grown = set()
            for node in sorted(alive):
                inside = at == node
                n, s = int(inside.sum()), int(residual[inside].sum())
                best, kept = 0.0, None
                for f in range(x.shape[1]):
                    for b in sorted(set(cells[inside, f]))[:-1]:
                        left = inside & (cells[:, f] <= b)
                        nl, sl = int(left.sum()), int(residual[left].sum())
                        if min(nl, n - nl) < least:
                            continue
                        gain = sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n
                        if gain > best * (1 + 1e-12) and gain > 1e-9 * (abs(s) + 1):
                            best, kept = gain, (f, b)
                if kept is None:
                    continue
                left = inside & (cells[:, kept[0]] <= kept[1])
                for child, rows in ((2 * node, left), (2 * node + 1, inside & ~left)):
                    at[rows] = child
                    leaves[child] = round(rate * int(residual[rows].sum()) / int(rows.sum()))
                    grown.add(child)
            alive = grown
        made = made + np.array([leaves.get(n, 0) for n in at])
    return made


@pytest.mark.parametrize("trees, depth", [(1, 1), (3, 3), (7, 2)])
def test_against_every_split(spark, trees, depth):
    pdf = table()
    rows = spark.createDataFrame(pdf).repartition(5)
    model = fit_boosted(rows, ["a", "b", "c d"], {1: "y"}, trees=trees, depth=depth, bins=8, least=15)
    got = rows.select("a", "b", "c d", "y", *model.binned()).select("a", "b", "c d", "y", model.predicted(1).alias("p")).toPandas()
    want = brute(got[["a", "b", "c d"]].to_numpy(), got["y"].to_numpy(), model.bounds, trees, depth, 8, 0.3, 15)
    np.testing.assert_allclose(got["p"], want * UNIT, atol=1e-9)


def test_a_fit_does_not_depend_on_how_rows_are_dealt(spark):
    rows = spark.createDataFrame(table(400, 2))
    models = [fit_boosted(r, ["a", "b", "c d"], {1: "y", 2: "a"}, trees=6) for r in (rows.repartition(1), rows.repartition(7, "y"))]
    assert models[0] == models[1]


@pytest.mark.parametrize("bins, at_once, far", [(8, 8, 1), (70, 8, 1), (8, 1, 1), (8, 8, 10**9)])
def test_a_level_sums_the_smaller_children_only(spark, monkeypatch, bins, at_once, far):
    summed, kinds, whole = [], set(), boosting._histograms

    def seen(rows, grown, nodes, features, stride, of):
        summed.append(list(nodes))
        kinds.update(of.values())
        return whole(rows, grown, nodes, features, stride, of)

    monkeypatch.setattr(boosting, "_histograms", seen)
    monkeypatch.setattr(boosting, "AT_ONCE", at_once)
    pdf = table(500, 5).assign(y=lambda d: d["y"] * far)
    rows = spark.createDataFrame(pdf).repartition(3)
    model = fit_boosted(rows, ["a", "b", "c d"], {1: "y"}, trees=2, depth=3, bins=bins, least=15)
    got = rows.select("a", "b", "c d", "y", *model.binned()).select("a", "b", "c d", "y", model.predicted(1).alias("p")).toPandas()
    want = brute(got[["a", "b", "c d"]].to_numpy(), got["y"].to_numpy(), model.bounds, 2, 3, bins, 0.3, 15)
    np.testing.assert_allclose(got["p"], want * UNIT, rtol=1e-12, atol=1e-9)
    nodes = [key for some in summed for key in some]
    assert len(nodes) <= 2 * (1 + 1 + 2) and max(map(len, summed)) <= at_once
    assert kinds == ({"BIGINT"} if far == 1 else {"DECIMAL(38,0)"})


def test_missing_values_constants_and_empty_table(spark):
    rows = spark.createDataFrame([(None, 1.0, 5.0), (float("nan"), 1.0, 7.0), (2.0, 1.0, None)] * 30, "a double, b double, y double")
    model = fit_boosted(rows, ["a", "b"], {1: "y"}, trees=2)
    made = {r.p for r in rows.select("a", *model.binned()).select(model.predicted(1).alias("p")).collect()}
    assert made == {6.0} and all(math.isfinite(v) for v in made)
    empty = fit_boosted(rows.limit(0), ["a", "b"], {1: "y"}, trees=2)
    assert empty.means == {1: 0} and not any(t.leaves for t in empty.trees[1])


def test_best_split_takes_the_first_of_equal_gains():
    cells = {(f, b): (10, 10 if b == 2 else -10) for f in (0, 1) for b in (1, 2)}
    assert best_split(cells, 2, 5) == (0, 1, (10, -10), (10, 10))
    assert best_split(cells, 2, 11) is None and best_split({(0, 1): (10, 5)}, 1, 1) is None


def test_trees_beat_the_line_on_held_out_rows(spark, frame):
    rng = np.random.default_rng(4)
    parts = []
    for node in range(3):
        n = 900
        x = rng.uniform(-2, 2, n)
        # The next value is a step in the feature, which a line cannot follow.
        y = np.append(0.0, np.where(np.abs(x[:-1]) > 1, 40.0, 10.0)) + rng.normal(0, 1, n)
        parts.append(pd.DataFrame({
            "node_id": f"N{node}", "timestamp": pd.date_range("2024-01-01", periods=n, freq="h"), "aqi": y, "x": x,
            "split": ["train"] * 600 + ["val"] * 100 + ["test"] * 200,
        }))
    rows = frame(pd.concat(parts, ignore_index=True))
    error = lambda df: df.agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("e")).first().e
    trees, line = forecast_boosted(rows, ["x", "aqi"], horizons=(1,)), forecast_pooled(rows, ["x", "aqi"], horizons=(1,))
    assert trees.count() == line.count() == 3 * 199
    assert error(trees) < 0.5 * error(line)
