import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airpanel.operators import quantiles as Q

PROBS = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]


def check(frame, values, small):
    pdf = pd.DataFrame({"v": np.array(values, dtype=float)})
    got = Q.exact_quantiles(frame(pdf), {str(p): ("v", p) for p in PROBS}, small=small)
    for p in PROBS:
        assert got[str(p)] == pytest.approx(pdf["v"].quantile(p), rel=1e-12, abs=1e-12), p


@pytest.mark.parametrize("small", [1, 20, 10**6])
@pytest.mark.parametrize("kind", ["uniform", "tail", "ties", "constant", "negative", "steps"])
def test_matches_pandas(frame, kind, small):
    rng = np.random.default_rng(1)
    values = {
        "uniform": rng.random(3000),
        "tail": np.concatenate([rng.random(3000), [1e9, 1e12, -1e12]]),
        "ties": rng.integers(0, 5, 3000),
        "constant": np.full(500, 3.25),
        "negative": -np.exp(rng.normal(size=2000) * 4),
        "steps": np.concatenate([np.full(1000, 1.0), np.full(1000, 1.0 + 1e-15), [2.0]]),
    }[kind]
    check(frame, values, small)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_any_values(frame, values):
    check(frame, values, small=2)


def test_known_values_and_nulls(frame):
    df = frame(pd.DataFrame({"v": [1, 2, np.nan, 3, 10.0], "e": [np.nan] * 5}))
    got = Q.exact_quantiles(df, {"hi": ("v", 0.999), "lo": ("v", 1 - 0.999), "none": ("e", 0.5)})
    assert got["hi"] == pytest.approx(9.979) and got["lo"] == pytest.approx(1.003)
    assert got["none"] is None


def test_rules(frame):
    v = [1.0, 2, 3, 10]
    df = frame(pd.DataFrame({"v": v + [np.nan], "n": [5.0] * 5}))
    clip = [r["v"] for r in Q.clip_outliers(df, ["v", "absent"]).collect()]
    assert clip == pytest.approx([1.003, 2, 3, 9.979, None])
    top = 1 + 9 * 0  # p = 0 picks the smallest value
    assert [r["v"] for r in Q.null_extremes(df, ["v"], 2.0, 0.0).collect()] == [1, 2, None, None, None]
    assert [r["v"] for r in Q.cap_extremes(df, ["v"], 2.0, 0.0).collect()] == [1, 2, 2 * top, 2 * top, None]
    assert [r["v"] for r in Q.median_fill(df, ["v"]).collect()] == [1, 2, 3, 10, 2.5]


def test_cap_leaves_columns_without_a_positive_top(frame):
    df = frame(pd.DataFrame({"v": [-3.0, -2, 0]}))
    assert [r["v"] for r in Q.cap_extremes(df, ["v"]).collect()] == [-3, -2, 0]


def test_bounds_can_come_from_other_rows(frame):
    df = frame(pd.DataFrame({"v": [1.0, 100.0]}))
    fit = frame(pd.DataFrame({"v": [5.0, 10.0]}))
    got = [r["v"] for r in Q.clip_outliers(df, ["v"], 1.0, fit_on=fit).collect()]
    assert got == [5.0, 10.0]


def test_nan_infinity_and_odd_names(spark):
    inf = float("inf")
    rows = [(1.0, inf), (2.0, -inf), (float("nan"), 3.0), (3.0, 4.0), (None, float("nan"))]
    df = spark.createDataFrame(rows, "`PM2.5` double, `a``b c` double")
    got = Q.exact_quantiles(df, {"m": ("PM2.5", 0.5), "lo": ("a`b c", 0.0), "hi": ("a`b c", 1.0), "mid": ("a`b c", 0.5)}, small=1)
    assert got == {"m": 2.0, "lo": -inf, "hi": inf, "mid": 3.5}
    clip = [r["PM2.5"] for r in Q.clip_outliers(df, percentile=1.0).collect()]
    assert clip[:2] == [1.0, 2.0] and np.isnan(clip[2]) and clip[3:] == [3.0, None]
    assert [r["PM2.5"] for r in Q.median_fill(df, ["PM2.5"]).collect()] == [1.0, 2.0, 2.0, 3.0, 2.0]
    assert [r["PM2.5"] for r in Q.null_extremes(df, ["PM2.5"], 0.9, 1.0).collect()] == [1.0, 2.0, None, None, None]
    assert Q.cap_extremes(df, ["a`b c"], 2.0, 0.5).count() == 5


def test_two_scans_whatever_the_outliers(spark):
    """The caller's rows are read twice, with values over forty orders of magnitude too."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = 4000
    rows = spark.range(n).selectExpr("pow(10D, id % 41 - 20) * (id + 1) AS v", "CASE WHEN id = 7 THEN 1e300 ELSE id END AS w")
    df = rows.mapInArrow(counted, "v double, w double")
    got = Q.exact_quantiles(df, {"a": ("v", 0.5), "b": ("w", 0.999), "c": ("w", 0.001)}, small=50)
    assert seen.value == 2 * n
    pdf = rows.toPandas()
    for name, (c, p) in {"a": ("v", 0.5), "b": ("w", 0.999), "c": ("w", 0.001)}.items():
        assert got[name] == pytest.approx(pdf[c].quantile(p), rel=1e-12)


def test_a_sketch_that_misses_is_made_good(frame, monkeypatch):
    """Brackets that do not hold the rank cost one more scan and no exactness."""
    pdf = pd.DataFrame({"v": np.random.default_rng(3).normal(size=3000)})
    real = Q._sketched

    def wrong(*args):
        row = real(*args).asDict()
        row["near_0"] = {k: 50.0 + k for k in row["near_0"]}
        return row

    monkeypatch.setattr(Q, "_sketched", wrong)
    got = Q.exact_quantiles(frame(pdf), {"m": ("v", 0.5), "t": ("v", 0.99)})
    assert got["m"] == pytest.approx(pdf["v"].median()) and got["t"] == pytest.approx(pdf["v"].quantile(0.99))
