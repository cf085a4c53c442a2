import csv
import gzip
import io
import json
import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import panel
from pyarrow import fs

from airpanel.operators import rows
from airpanel.session import publish
from airpanel.sources import files
from airpanel.sources.headered import dealt, listed, read_headered

HEADER = "From Date,To Date,PM2.5 (ug/m3),PM10 (ug/m3),WS (m/s),WD (degree)\n"


def test_station_csv(spark, tmp_path):
    (tmp_path / "MH020.csv").write_text(HEADER + "2024-01-01 00:00:00,x,12.5,,1.5,90\nbad,x,3,4,5,6\n")
    (tmp_path / "MH021.csv").write_text(HEADER + "2024-01-01 01:00:00,x,abc,7,NaN,0\n")
    got = {(r["station_id"], str(r["timestamp"])): r for r in files.read_station_csv(spark, f"{tmp_path}/MH*.csv").collect()}
    assert set(got) == {("MH020", "2024-01-01 00:00:00"), ("MH020", "None"), ("MH021", "2024-01-01 01:00:00")}
    first = got["MH020", "2024-01-01 00:00:00"].asDict()
    assert list(first) == ["timestamp", "station_id", "pm25", "pm10", "wind_speed", "wind_dir"]
    assert (first["pm25"], first["pm10"], first["wind_dir"]) == (12.5, None, 90.0)
    last = got["MH021", "2024-01-01 01:00:00"]
    assert (last["pm25"], last["pm10"], last["wind_speed"]) == (None, 7.0, None)


def test_city_csv(spark, tmp_path):
    (tmp_path / "city_day.csv").write_text(
        "City,Date,PM2.5,NO,CO,AQI\nAgra,2020-01-01,5,1,0.2,80\nDelhi,2020-01-01,9,1,1,300\nAGRA,2020-01-02,6,1,,90\n")
    got = files.read_city_day_csv(spark, str(tmp_path), "agra")
    assert got.columns == ["timestamp", "pm25", "co", "aqi"]
    assert sorted(r["aqi"] for r in got.collect()) == [80.0, 90.0]


def weather(n):
    return {"hourly": {
        "time": [f"2022-01-01T{h:02d}:00" for h in range(n)], "temperature_2m": [20.0 + h for h in range(n)],
        "relative_humidity_2m": [50] * n, "precipitation": [0.0, None, 0.2][:n], "wind_speed_10m": [5.5] * n,
        "wind_direction_10m": [180] * n, "pressure_msl": [1013.2] * n}}


@pytest.mark.parametrize("lines", [False, True])
def test_weather_json(spark, tmp_path, lines):
    docs = [{"node_id": "N01", **weather(3)}, {"node_id": "N02", **weather(2)}]
    if lines:
        (tmp_path / "w.json").write_text("\n".join(map(json.dumps, docs)))
    else:
        for d in docs:
            (tmp_path / f"{d['node_id']}.json").write_text(json.dumps(d, indent=1))
    got = files.read_weather_json(spark, str(tmp_path), lines=lines).orderBy("node_id", "timestamp").collect()
    assert [r["node_id"] for r in got] == ["N01"] * 3 + ["N02"] * 2
    assert str(got[1]["timestamp"]) == "2022-01-01 01:00:00"
    assert (got[1]["temperature"], got[1]["precipitation"], got[1]["pressure"]) == (21.0, None, 1013.2)


def test_weather_node_can_be_given(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps(weather(3)))
    assert {r["node_id"] for r in files.read_weather_json(spark, str(tmp_path), "N09").collect()} == {"N09"}


def test_measurements_json_and_pivot(spark, tmp_path):
    def m(t, p, v):
        return {"date": {"utc": t}, "parameter": p, "value": v, "unit": "µg/m³"}
    docs = {"a": {"name": "A", "results": [m("2022-01-01T00:00:00Z", "pm25", 10.0), m("2022-01-01T00:00:00Z", "pm25", 20.0),
                                           m("2022-01-01T00:00:00Z", "no2", 3.0)]},
            "b": {"results": [m("2022-01-01T01:00:00Z", "no2", 4.0)]}, "c": {"name": "C", "results": []}}
    for k, d in docs.items():
        (tmp_path / f"{k}.json").write_text(json.dumps(d, indent=1))
    long = files.read_measurements_json(spark, str(tmp_path))
    assert long.columns == ["timestamp", "location", "parameter", "value", "unit"] and long.count() == 4
    wide = {r["location"]: r.asDict() for r in rows.pivot_measurements(long, ["no2", "pm25"]).collect()}
    assert (wide["A"]["pm25"], wide["A"]["no2"]) == (15.0, 3.0)
    assert (wide["Unknown"]["pm25"], wide["Unknown"]["no2"]) == (None, 4.0)
    assert str(wide["A"]["timestamp"]) == "2022-01-01 00:00:00"


def test_nodes_json(spark, tmp_path):
    node = {"id": "N01", "name": "X", "lat": 1.5, "lon": 2.5, "characteristic": "c"}
    (tmp_path / "n.json").write_text(json.dumps({"nodes": [node, {**node, "id": "N02"}], "metadata": {}}, indent=1))
    got = files.read_nodes_json(spark, str(tmp_path / "n.json"))
    assert got.columns == ["node_id", "name", "lat", "lon", "characteristic"]
    assert sorted(r["node_id"] for r in got.collect()) == ["N01", "N02"]


def test_node_csvs(spark, frame, tmp_path):
    text = "timestamp,node_id,aqi,pm25,pm10,no2,so2,co,o3\n"
    for n in ("N02", "N01"):
        (tmp_path / f"node_{n}_simulated.csv").write_text(
            text + "".join(f"2022-01-01 0{h}:00:00,{n},100,{h},1,1,1,1,\n" for h in range(2)))
    got = files.read_node_csvs(spark, str(tmp_path), ordered=True).collect()
    assert [(str(r["timestamp"])[11:13], r["node_id"]) for r in got] == [("00", "N01"), ("00", "N02"), ("01", "N01"), ("01", "N02")]
    assert got[0]["o3"] is None
    with pytest.raises(FileNotFoundError):
        files.read_node_csvs(spark, str(tmp_path / "absent"))
    files.write_node_csv(files.read_node_csvs(spark, str(tmp_path)), str(tmp_path / "out"))
    assert files.read_node_csvs(spark, str(tmp_path / "out"), ordered=True).collect() == got


def test_cached_parquet_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(5)

    path = str(tmp_path / "t")
    assert files.cached_parquet(spark, path, compute).count() == 5
    assert files.cached_parquet(spark, path, compute).count() == 5
    assert len(calls) == 1


def test_processed_table_is_pruned_by_node(spark, frame, tmp_path):
    pdf = panel(columns=("aqi",))
    files.write_processed(frame(pdf), str(tmp_path / "p"))
    one = rows.filter_node(spark.read.parquet(str(tmp_path / "p")), "N02")
    assert one.count() == (pdf["node_id"] == "N02").sum()
    assert "PartitionFilters: [isnotnull(node_id" in one._jdf.queryExecution().executedPlan().toString()


def test_rows(spark, frame):
    df = spark.createDataFrame([(1, "a", 2.0, None), (2, "b", None, None)], "i int, s string, x double, e double")
    assert rows.select_available(df, ["x", "nope", "i"]).columns == ["x", "i"]
    assert rows.select_numeric(df, ["i"]).columns == ["x", "e"]
    assert [tuple(r) for r in rows.usable_features(df, ["x", "e", "nope"]).collect()] == [("x", 1)]
    assert rows.drop_null_all(df, ["x", "e"]).count() == 1 and rows.drop_null_any(df).count() == 0
    assert rows.drop_null_critical(df).count() == 2
    both = rows.union_nodes([df.select("i"), df.select("s")])
    assert both.columns == ["i", "s"] and both.count() == 4


def test_lookup_missing_default_and_rank(spark):
    stations = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 2.0)], "node_id string, lat double")
    asked = spark.createDataFrame([("A",), ("Z",), ("A",)], "node_id string")
    found = [(r["node_id"], r["found"]) for r in rows.station_lookup(asked, stations, "node_id").collect()]
    assert sorted(found) == [("A", True), ("A", True), ("Z", False)]
    assert sorted(r["node_id"] for r in rows.missing_nodes(stations, asked).collect()) == ["B", "C"]
    values = spark.createDataFrame([("A", 42.0)], "node_id string, aqi double")
    full = rows.left_join_default(stations, values)
    assert {r["node_id"]: r["aqi"] for r in full.collect()} == {"A": 42.0, "B": 100.0, "C": 100.0}
    assert [r["node_id"] for r in rows.rank_stations(full, 2).collect()] == ["B", "C"]




def test_every_file_is_bound_by_its_own_header(spark, tmp_path):
    head = "From Date,PM2.5 (ug/m3),PM10 (ug/m3)"
    (tmp_path / "A.csv").write_text(f"{head}\n2024-01-01 00:00:00,11,99\n")
    (tmp_path / "My Place+1.csv").write_text("From Date,PM10 (ug/m3),PM2.5 (ug/m3),NO2 (ug/m3)\n13-01-2024 05:00,99,11,7\n")
    (tmp_path / "C.csv").write_text("CO (mg/m3),From Date\n1.5,14/02/2024 06:30:00\n")
    got = {r["station_id"]: r for r in files.read_station_csv(spark, str(tmp_path / "*.csv")).collect()}
    assert set(got) == {"A", "My Place+1", "C"}
    assert [(got[s]["pm25"], got[s]["pm10"], got[s]["no2"], got[s]["co"]) for s in ("A", "My Place+1", "C")] == [
        (11, 99, None, None), (11, 99, 7, None), (None, None, None, 1.5)]
    assert str(got["My Place+1"]["timestamp"]) == "2024-01-13 05:00:00" and str(got["C"]["timestamp"]) == "2024-02-14 06:30:00"


def test_node_and_city_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "node_A.csv").write_text("timestamp,node_id,aqi,pm25\n2024-01-01 00:00:00,A,100,5\n")
    (tmp_path / "node_B.csv").write_text("pm25,aqi,o3,node_id,timestamp\n5,100,3,B,2024-01-01 00:00:00\n")
    got = {r["node_id"]: (r["aqi"], r["pm25"], r["o3"]) for r in files.read_node_csvs(spark, str(tmp_path)).collect()}
    assert got == {"A": (100, 5, None), "B": (100, 5, 3)}
    city = tmp_path / "city"
    city.mkdir()
    (city / "1.csv").write_text("City,Date,PM2.5,AQI\nPune,2024-01-01,5,100\n")
    (city / "2.csv").write_text("AQI,PM2.5,Date,City\n100,5,2024-01-02,pune\n7,7,2024-01-02,other\n")
    rows = files.read_city_day_csv(spark, str(city), "Pune").collect()
    assert sorted((str(r["timestamp"])[:10], r["pm25"], r["aqi"]) for r in rows) == [("2024-01-01", 5, 100), ("2024-01-02", 5, 100)]


def test_only_a_missing_path_is_computed_anew(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception) as caught:
        files.cached_parquet(spark, str(tmp_path / "broken"), lambda: spark.range(3)).count()
    assert "PATH_NOT_FOUND" not in str(caught.value) and (tmp_path / "broken" / "part-0.parquet").exists()


def test_cache_is_whole_or_not_there(spark, tmp_path):
    path = str(tmp_path / "t")

    def failing():
        return spark.range(100).selectExpr("id", "CASE WHEN id = 99 THEN raise_error('lost') ELSE id END AS v")

    with pytest.raises(Exception, match="lost"):
        files.cached_parquet(spark, path, failing)
    assert not (tmp_path / "t").exists()
    assert files.cached_parquet(spark, path, lambda: spark.range(7)).count() == 7
    # A second writer that was slower finds the finished table and leaves it.
    late = str(tmp_path / "late")
    spark.range(3).write.parquet(late)
    publish(spark, late, path)
    assert spark.read.parquet(path).count() == 7 and not (tmp_path / "late").exists()


def test_two_writers_at_a_time(spark, tmp_path):
    path, gate = str(tmp_path / "t"), threading.Barrier(2)

    def compute(n):
        gate.wait(60)
        return spark.range(n)

    with ThreadPoolExecutor(2) as pool:
        sizes = list(pool.map(lambda n: files.cached_parquet(spark, path, lambda: compute(n)).count(), (5, 9)))
    assert sizes[0] == sizes[1] and sizes[0] in (5, 9) and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_ranges_of_files_with_many_headers(spark, tmp_path):
    rng = random.Random(1)
    names, want = ["a", "b", "c d", "é"], []
    for i in range(12):
        head = rng.sample(names, rng.randint(1, 4)) + ["other"] * (i % 2)
        rows = [[rng.choice([*[""] * (len(head) > 1), "1", "x y", 'say "hi"', "1,5", "ü" * 9]) for _ in head] for _ in range(rng.randint(0, 40))]
        lines = io.StringIO()
        csv.writer(lines, lineterminator=rng.choice(["\n", "\r\n"])).writerows([head, *rows])
        text = lines.getvalue()
        if i == 5:
            text = text.rstrip("\r\n")  # the last line has no end
        (tmp_path / f"f{i}.csv").write_bytes((b"\xef\xbb\xbf" if i == 3 else b"") + text.encode())
        want += [(f"f{i}", *[(dict(zip(head, r)).get(n) or None) for n in names]) for r in rows]
    (tmp_path / "_hidden.csv").write_text("a\n1\n")
    (tmp_path / "short.csv").write_text("a,b,é\n1\n2,3\n4,5,6,7\n\n8,9,10\n")
    want += [("short", "1", None, None, None), ("short", "2", "3", None, None), ("short", "4", "5", None, "6"), ("short", "8", "9", None, "10")]
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("b,a\n1,2\n")
    want.append(("packed", "2", "1", None, None))
    for size in (64 << 20, 50, 7):
        df = read_headered(spark, str(tmp_path / "*.csv*"), names, size)
        assert df.columns == ["file", *names]
        got = [(r["file"].rsplit("/", 1)[1].split(".")[0], *[r[n] for n in names]) for r in df.collect()]
        assert sorted(got, key=str) == sorted(want, key=str), size
    assert read_headered(spark, str(tmp_path / "nothing*"), names) is None
    assert read_headered(spark, str(tmp_path / "f*.csv"), ["absent"]).columns == ["file"]


def test_plan_does_not_grow_with_files_and_headers(spark, tmp_path):
    def plan(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            names = ["From Date", "PM10 (ug/m3)", *[f"x{j}" for j in range(i)]]
            (folder / f"S{i}.csv").write_text(",".join(names) + "\n2024-01-01 00:00:00,5" + ",1" * i + "\n")
        df = files.read_station_csv(spark, f"{folder}/*.csv")
        assert df.count() == n
        return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert plan(2) == plan(25)


def test_small_files_share_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"S{i}.csv").write_text(f"From Date,PM10 (ug/m3)\n2024-01-01 00:00:00,{i}\n")
    df = files.read_station_csv(spark, f"{tmp_path}/*.csv")
    assert df.rdd.getNumPartitions() <= 20
    assert {(r["station_id"], r["pm10"]) for r in df.collect()} == {(f"S{i}", float(i)) for i in range(300)}


def test_long_files_are_cut_and_short_ones_dealt():
    infos = [fs.FileInfo(name, type=fs.FileType.File, size=n) for name, n in (("a", 100 << 20), ("b", 10), ("c", 20), ("d.gz", 90 << 20), ("e", 0))]
    ranges = [p for r in dealt(infos, 64 << 20, 2) for p in r.parts]
    assert [(p.path, p.start, p.end) for p in ranges] == [("a", 0, 64 << 20), ("a", 64 << 20, 100 << 20), ("b", 0, 10), ("c", 0, 20), ("d.gz", 0, -1)]
    assert [[p.path for p in r.parts] for r in dealt(infos, 64 << 20, 2)] == [["a"], ["a", "b", "c"], ["d.gz"]]
    assert len(dealt(infos[:1], 64 << 20, 8)) == 8 and len(dealt(infos[1:3], 64 << 20, 8)) == 1 and dealt([], 64 << 20, 8) == []


def test_station_files_follow_stations_not_tasks(spark, tmp_path):
    pdf = panel(nodes=6, hours=200, columns=("pm25",), seed=3)
    df = files.spread_by_month(spark.createDataFrame(pdf).repartition(40))
    df.write.partitionBy("node_id").csv(str(tmp_path / "out"), header=True)
    assert len(list((tmp_path / "out").glob("*/*.csv"))) <= 2 * 6
    assert df.count() == len(pdf)


def test_globs(tmp_path):
    for name in ("a/node_1.csv", "a/node=2/part.csv", "a/node=2/_SUCCESS", "a/other.csv", "b/.x/y.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("h")
    found = lambda p: [f.path.removeprefix(f"{tmp_path}/") for f in listed(p)]
    assert found(f"{tmp_path}/a/{{node_*.csv,node=*}}") == ["a/node=2/part.csv", "a/node_1.csv"]
    assert found(f"file://{tmp_path}/a") == ["a/node=2/part.csv", "a/node_1.csv", "a/other.csv"]
    assert found(f"{tmp_path}/b") == [] and found(f"{tmp_path}/[ab]/oth??.csv") == ["a/other.csv"]
