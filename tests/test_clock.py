from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airpanel.functions import clock, physics


def at(spark, text, expr):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{text}' AS timestamp")
    return df.select(expr.alias("v")).first()["v"]


def test_hour_index_is_inverse_of_hour_start_whatever_the_zone(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ'1969-12-31 23:30:00', "
                   "TIMESTAMP_NTZ'2024-03-31 02:30:00', TIMESTAMP_NTZ'2024-10-27 02:59:59.9')) AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = df.withColumn("h", clock.hour_index("t")).withColumn("s", clock.hour_start("h")).collect()
            days = [(datetime(*d) - datetime(1970, 1, 1)).days for d in ((2024, 3, 31), (2024, 10, 27))]
            assert [r["h"] for r in rows] == [-1, days[0] * 24 + 2, days[1] * 24 + 2]
            assert [str(r["s"]) for r in rows] == [
                "1969-12-31 23:00:00", "2024-03-31 02:00:00", "2024-10-27 02:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cycles_match_numpy(spark, frame):
    ts = pd.date_range("2023-12-28", periods=400, freq="7h")
    got = frame(pd.DataFrame({"timestamp": ts})).select(
        "timestamp", *[e.alias(n) for n, e in clock.cyclical_time().items()]
    ).toPandas().sort_values("timestamp")
    for name, value, period in (("hour", ts.hour, 24), ("dow", ts.dayofweek, 7), ("month", ts.month, 12)):
        np.testing.assert_allclose(got[f"{name}_sin"], np.sin(2 * np.pi * value / period), atol=1e-12)
        np.testing.assert_allclose(got[f"{name}_cos"], np.cos(2 * np.pi * value / period), atol=1e-12)


@pytest.mark.parametrize("text, flag", [("2022-01-01 05:00:00", 1), ("2022-01-02 05:00:00", 1), ("2022-01-03 00:00:00", 0)])
def test_weekend(spark, text, flag):
    assert at(spark, text, clock.weekend_flag()) == flag


@pytest.mark.parametrize("text, flag", [
    ("2023-11-10 00:00:00", 1), ("2023-11-12 12:00:00", 1), ("2023-11-14 00:00:00", 1),
    ("2023-11-14 01:00:00", 0), ("2023-11-09 23:00:00", 0), ("2023-11-15 12:00:00", 0),
])
def test_festival_by_timestamp(spark, text, flag):
    assert at(spark, text, clock.festival_flag()) == flag


@pytest.mark.parametrize("hour, rush", [(6, 0), (7, 1), (8, 1), (9, 1), (10, 0), (16, 0), (17, 1), (20, 1), (21, 0), (23, 0)])
def test_rush_hours(spark, hour, rush):
    text = f"2023-05-10 {hour:02d}:00:00"
    assert at(spark, text, clock.rush_hour_flag()) == rush


def test_seasons(spark):
    flags = {m: tuple(at(spark, f"2023-{m:02d}-05 12:00:00", F.struct(*[
        e.alias(n) for n, e in clock.season_flags().items()]))) for m in range(1, 13)}
    assert [m for m, f in flags.items() if f[0]] == [10, 11]
    assert [m for m, f in flags.items() if f[1]] == [6, 7, 8, 9]
    assert [m for m, f in flags.items() if f[2]] == [1, 2, 12]
    assert [m for m in range(1, 13) if at(spark, f"2023-{m:02d}-05 12:00:00", clock.monsoon_flag())] == [7, 8, 9]


def test_wind(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 90.0)], "wind_speed double, wind_direction double")
    rows = df.select(*[e.alias(n) for n, e in physics.wind_vectors(df.columns).items()]).collect()
    assert rows[0] == pytest.approx((0, 10)) and rows[1] == pytest.approx((10, 0), abs=1e-12)
    assert physics.wind_vectors(["wind_speed"]) == {}


def test_weather_interactions_need_their_columns(spark):
    df = spark.createDataFrame([(30.0, 50.0, 0.0)], "temperature double, humidity double, wind_speed double")
    row = df.select(*[e.alias(n) for n, e in physics.weather_interactions(df.columns).items()]).first()
    assert tuple(row) == (15.0, 10.0)
    assert list(physics.weather_interactions(["wind_speed"])) == ["wind_speed_inv"]
