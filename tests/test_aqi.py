import pytest
from pyspark.sql import functions as F

from airpanel.functions import aqi as A
from airpanel.functions import physics


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("value, index", [
    (0, 0), (15, 25), (30, 50), (30.5, None), (31, 51), (45, 74.65517241379311), (60, 100),
    (75.5, 150.5), (90.5, None), (100, 231.72413793103448), (121, 301), (250.5, None),
    (500, 500), (600, 500), (-10, None),
])
def test_pm25_bands(spark, value, index):
    assert one(spark, A.sub_index(f"{float(value)}D", "pm25")) == index


def test_every_band_end_maps_to_its_index(spark):
    checks, want = [], []
    for p, bands in A.BREAKPOINTS.items():
        for low, high, c_low, c_high in bands:
            checks += [A.sub_index(f"{float(c_low)}D", p), A.sub_index(f"{float(c_high)}D", p.upper())]
            want += [low, high]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(checks)]).first()
    assert list(row) == pytest.approx(want)


def test_unknown_pollutant_and_null(spark):
    assert one(spark, A.sub_index("10D", "dust")) is None
    assert one(spark, A.sub_index("CAST(NULL AS DOUBLE)", "pm25")) is None


def test_aqi_is_the_largest_known_index(spark):
    df = spark.createDataFrame(
        [(45.0, 80.0, None), (None, None, None), (30.5, 20.0, None), (600.0, 10.0, 3.0)],
        "pm25 double, pm10 double, co double",
    )
    got = [tuple(r) for r in df.select(A.aqi(df.columns), A.dominant_pollutant(df.columns)).collect()]
    assert got == [(80.0, "pm10"), (None, None), (20.0, "pm10"), (500.0, "pm25")]
    assert df.select(A.aqi(["pm25"])).first()[0] == pytest.approx(74.65517241379311)
    assert df.select(A.aqi([])).first()[0] is None


def test_dominant_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([(30.0, 50.0)], "pm25 double, pm10 double")
    assert df.select(A.dominant_pollutant(df.columns)).first()[0] == "pm25"


@pytest.mark.parametrize("value, index, label, banded", [
    (25, 0, "Good", "Good"), (50, 0, "Good", "Good"), (50.5, 0, "Satisfactory", "Severe"),
    (75, 1, "Satisfactory", "Satisfactory"), (150, 2, "Moderate", "Moderate"), (250, 3, "Poor", "Poor"),
    (350, 4, "Very Poor", "Very Poor"), (450, 5, "Severe", "Severe"), (501, 5, "Severe", "Severe"),
    (-1, 0, "Good", "Severe"),
])
def test_categories(spark, value, index, label, banded):
    c = f"{float(value)}D"
    row = spark.range(1).select(A.category_index(c), A.category(c), A.category_banded(c)).first()
    assert tuple(row) == (index, label, banded)


def test_null_has_no_category(spark):
    c = "CAST(NULL AS DOUBLE)"
    row = spark.range(1).select(A.category_index(c), A.category(c), A.category_banded(c), A.clamp_aqi(c)).first()
    assert tuple(row) == (None,) * 4


def test_colors_and_advice(spark):
    row = spark.range(1).select(
        A.category_color("'Severe'"), A.category_color("'Severe'", service=True),
        A.health_advisory("'Good'"), A.health_advisory("'Unheard'"),
    ).first()
    assert tuple(row) == ("#7E0023", "#8F3F97", A.ADVISORIES["Good"], A.DEFAULT_ADVISORY)


def test_clamp(spark):
    row = spark.range(1).select(*[A.clamp_aqi(f"{v}D") for v in (-3.0, 12.5, 700.0)]).first()
    assert tuple(row) == (0.0, 12.5, 500.0)


def test_scoring_stays_in_generated_code(spark):
    df = spark.createDataFrame([(1.0,) * 6], ", ".join(f"{p} double" for p in A.POLLUTANTS))
    plan = df.select(A.aqi())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(1) Project" in plan
    assert df.select(F.round(A.aqi(), 6)).first()[0] is not None


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 20.0), (nan, None), (30.0, nan)], "pm25 double, pm10 double")
    rows = df.select(A.aqi(df.columns).alias("aqi"), A.dominant_pollutant(df.columns).alias("worst"),
                     A.sub_index("pm25", "pm25").alias("sub")).collect()
    assert [tuple(r) for r in rows] == [(20.0, "pm10", None), (None, None, None), (50.0, "pm25", 50.0)]
    row = df.limit(1).select(
        A.clamp_aqi("pm25"), A.category_index("pm25"), A.category("pm25"), A.category_banded("pm25"),
        physics.null_negatives("pm25"), physics.clamp_nonneg("pm25"),
    ).first()
    assert tuple(row) == (None,) * 6
