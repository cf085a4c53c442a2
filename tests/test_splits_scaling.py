import numpy as np
import pandas as pd
import pytest
from conftest import panel

from airpanel.operators import scaling, splits


@pytest.mark.parametrize("n, sizes", [(100, (70, 15, 15)), (90, (62, 14, 14)), (3, (2, 0, 1)), (1, (0, 0, 1))])
def test_sizes(frame, n, sizes):
    pdf = pd.DataFrame({"node_id": "A", "timestamp": pd.date_range("2024-01-01", periods=n, freq="h")})
    counts = {r["split"]: r["count"] for r in splits.chrono_split(frame(pdf)).groupBy("split").count().collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "val", "test")) == sizes


@pytest.mark.parametrize("size", [5, 4096])
def test_matches_positions(frame, size):
    pdf = panel(nodes=7, hours=90, keep=0.8, seed=2)
    want = pdf.sort_values(["timestamp", "node_id"]).reset_index(drop=True)
    n = len(want)
    want["split"] = ["train"] * int(n * 0.7) + ["val"] * (int(n * (0.7 + 0.15)) - int(n * 0.7)) + ["test"] * (
        n - int(n * (0.7 + 0.15)))
    got = splits.chrono_split(frame(pdf), size=size).toPandas().sort_values(["timestamp", "node_id"])
    assert list(got["split"]) == list(want["split"])


def test_empty(frame, spark):
    empty = spark.createDataFrame([], "node_id string, timestamp timestamp_ntz")
    assert splits.chrono_split(empty).count() == 0


def test_split_needs_no_shuffle_of_the_rows(frame):
    plan = splits.chrono_split(frame(panel()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_round_trip_summary_and_leak(frame, spark, tmp_path):
    pdf = panel(nodes=2, hours=50, columns=("aqi",)).dropna()
    parts = splits.chrono_split(frame(pdf))
    splits.save_split(parts, str(tmp_path / "s"))
    back = splits.load_split(spark, str(tmp_path / "s"))
    assert back.join(parts.drop("aqi"), ["timestamp", "node_id", "split"]).count() == len(pdf)
    summary = {r["split"]: r for r in splits.split_summary(parts).collect()}
    train = parts.where("split = 'train'").toPandas()["aqi"]
    assert summary["train"]["mean"] == pytest.approx(train.mean())
    assert summary["train"]["std"] == pytest.approx(train.std())
    assert splits.split_no_leak(parts).first()["ordered"]


@pytest.fixture
def values(frame):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.normal(50, 9, 40), "b": rng.random(40), "k": 7.0})
    return pdf, frame(pdf)


def test_minmax(values):
    pdf, df = values
    stats = scaling.fit_minmax(df.limit(40))
    got = scaling.scale(df, stats).toPandas()
    for c in ("a", "b"):
        np.testing.assert_allclose(got[c], (pdf[c] - pdf[c].min()) / (pdf[c].max() - pdf[c].min()))
    assert (got["k"] == 0).all()
    back = scaling.unscale(scaling.scale(df, stats), stats, "a", ["a"]).toPandas()
    np.testing.assert_allclose(back["a"], pdf["a"])


def test_standard(values):
    pdf, df = values
    stats = scaling.fit_standard(df, ["a", "k"])
    got = scaling.scale(df, stats).toPandas()
    np.testing.assert_allclose(got["a"], (pdf["a"] - pdf["a"].mean()) / pdf["a"].std(ddof=0))
    assert (got["k"] == 0).all() and (got["b"] == pdf["b"]).all()
    z = df.selectExpr("1000D * a AS y")
    assert scaling.unscale(z, stats, "a", ["y"], clamp=True).toPandas()["y"].between(0, 500).all()


def test_rows_outside_the_fit_are_not_clipped(frame):
    stats = scaling.fit_minmax(frame(pd.DataFrame({"a": [0.0, 10.0]})))
    got = [r["a"] for r in scaling.scale(frame(pd.DataFrame({"a": [-5.0, 20.0]})), stats).collect()]
    assert got == [-0.5, 2.0]


def test_scaler_round_trip(values, spark, tmp_path):
    _, df = values
    stats = scaling.fit_minmax(df)
    scaling.save_scaler(stats, str(tmp_path / "x"))
    assert scaling.load_scaler(spark, str(tmp_path / "x")).first().asDict() == stats.first().asDict()
    with pytest.raises(ValueError, match="no scaler"):
        scaling.load_scaler(spark, str(tmp_path / "absent"))


def test_parts_may_be_empty(frame):
    pdf = panel(nodes=2, hours=20, keep=1.0, columns=("aqi",))
    for ratios, want in (((0.8, 0.2), {"train", "val"}), ((1.0, 0.0), {"train"}), ((0.0, 0.0), {"test"})):
        got = splits.chrono_split(frame(pdf), *ratios).collect()
        assert {r["split"] for r in got} == want, ratios
