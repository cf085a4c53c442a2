import math

import numpy as np
import pandas as pd
import pytest

from airpanel.functions.geo import haversine_km
from airpanel.operators import graph as G

NODES = [  # ten sensor sites of one city
    ("N01", 18.5308, 73.8475), ("N02", 18.5912, 73.7389), ("N03", 18.6298, 73.8037),
    ("N04", 18.5089, 73.9260), ("N05", 18.4529, 73.8669), ("N06", 18.5196, 73.8399),
    ("N07", 18.5679, 73.9143), ("N08", 18.5074, 73.8077), ("N09", 18.7330, 73.6554),
    ("N10", 18.5326, 73.9368),
]


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 6371.0 * 2 * math.asin(math.sqrt(h))


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame(NODES, "node_id string, lat double, lon double")


@pytest.mark.parametrize("a, b, want", [
    (NODES[0][1:], NODES[5][1:], 1.480894750), (NODES[0][1:], NODES[8][1:], 30.252480112),
    ((18.5204, 73.8567), (19.0760, 72.8777), 120.152301960), ((10, 20), (10, 20), 0),
])
def test_haversine(spark, a, b, want):
    got = spark.range(1).select(haversine_km(*[f"{float(v)}D" for v in (*a, *b)])).first()[0]
    assert got == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("within, edges", [(5, 10), (10, 32), (15, 58), (20, 68)])
def test_edge_counts(nodes, within, edges):
    assert G.near_pairs(nodes, float(within)).count() == edges


def test_weights_are_symmetric(nodes):
    e = {(r["src"], r["dst"]): r["weight"] for r in G.adjacency_edges(nodes).collect()}
    assert e["N01", "N06"] == pytest.approx(0.957086997)
    assert all(e[s, s] == 1.0 for s, _, _ in NODES) and len(e) == 42
    assert all(e[b, a] == pytest.approx(w) and 0 < w <= 1 for (a, b), w in e.items())
    assert G.adjacency_edges(nodes, self_loop=False).count() == 32


@pytest.mark.parametrize("within", [150.0, 900.0])
def test_pairs_match_brute_force_near_pole_and_date_line(spark, within):
    rng = np.random.default_rng(0)
    lat = np.concatenate([rng.uniform(84, 90, 40), rng.uniform(-6, 6, 40), rng.uniform(-90, -86, 20)])
    lon = np.concatenate([rng.uniform(-180, 180, 40), rng.choice([-179, 179], 40) + rng.uniform(-1, 1, 40),
                          rng.uniform(-180, 180, 20)])
    points = [(f"P{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]
    df = spark.createDataFrame(points, "node_id string, lat double, lon double")
    want = {(a[0], b[0]) for a in points for b in points if a[0] != b[0] and km(a[1:], b[1:]) <= within}
    rows = G.near_pairs(df, within).collect()
    assert {(r["src"], r["dst"]) for r in rows} == want and len(rows) == len(want)


def test_index_and_degree(nodes):
    edges = G.adjacency_edges(nodes)
    index = {r["node_id"]: r["index"] for r in G.station_index(nodes).collect()}
    assert index == {n: i for i, (n, _, _) in enumerate(NODES)}
    numbered = G.edge_index(edges, G.station_index(nodes))
    assert numbered.count() == 42 and numbered.agg({"source": "max"}).first()[0] == 9
    degree = {r["src"]: r["degree"] for r in G.node_degree(edges).collect()}
    assert degree["N09"] == 1.0


def matrix(rows):
    m = np.zeros((10, 10))
    for r in rows:
        m[int(r["src"][1:]) - 1, int(r["dst"][1:]) - 1] = r["weight"]
    return m


def test_normalization_matches_matrices(nodes):
    edges = G.adjacency_edges(nodes)
    a = matrix(edges.collect())
    d = a.sum(axis=1) + 1e-8
    np.testing.assert_allclose(matrix(G.normalize_edges(edges).collect()), a / np.sqrt(np.outer(d, d)))
    by_row = matrix(G.normalize_edges(edges, symmetric=False).collect())
    np.testing.assert_allclose(by_row.sum(axis=1), 1, atol=1e-6)


def test_aggregate_is_a_matrix_product(nodes, frame):
    rng = np.random.default_rng(1)
    x = rng.random((5, 10))
    ts = pd.date_range("2024-01-01", periods=5, freq="h")
    pdf = pd.DataFrame([(n, t, x[i, k]) for i, t in enumerate(ts) for k, (n, _, _) in enumerate(NODES)],
                       columns=["node_id", "timestamp", "aqi"])
    edges = G.normalize_edges(G.adjacency_edges(nodes))
    got = G.graph_aggregate(frame(pdf), edges).toPandas().sort_values(["timestamp", "node_id"])
    want = x @ matrix(edges.collect()).T
    np.testing.assert_allclose(got["aqi_neighbours"].to_numpy().reshape(5, 10), want)


def test_correlation_edges(frame):
    pdf = pd.DataFrame(np.random.default_rng(2).random((50, 3)), columns=["a", "b", "c"])
    got = {(r["src"], r["dst"]): r["weight"] for r in G.correlation_edges(frame(pdf), ["a", "b", "c"]).collect()}
    want = pdf.corr().abs()
    assert len(got) == 9
    assert all(w == pytest.approx(want.loc[k]) for k, w in got.items())


def test_round_trip(nodes, spark, tmp_path):
    edges = G.adjacency_edges(nodes)
    G.save_graph(edges, nodes, str(tmp_path / "g"), {"threshold_km": 10})
    back = G.load_graph(spark, str(tmp_path / "g"))
    assert back["edges"].count() == 42 and back["nodes"].count() == 10
    assert [tuple(r) for r in back["meta"].collect()] == [("meta_threshold_km", "10")]
    with pytest.raises(FileNotFoundError):
        G.load_graph(spark, str(tmp_path / "absent"))


@pytest.mark.parametrize("spread", [1, 4, 16])
def test_a_node_with_most_rows_is_dealt_over_tasks(frame, spark, spread):
    hours = pd.date_range("2024-01-01", periods=900, freq="h")
    rows = pd.concat([pd.DataFrame({"node_id": "A", "timestamp": hours, "aqi": np.arange(900.0)}), pd.DataFrame({"node_id": ["B"], "timestamp": hours[:1], "aqi": [5.0]})])
    edges = spark.createDataFrame([("A", "A", 1.0), ("B", "A", 0.5), ("A", "B", 2.0)], "src string, dst string, weight double")
    out = G.graph_aggregate(frame(rows), edges, spread=spread, size=24).toPandas()
    got = {(r.node_id, r.timestamp): r.aqi_neighbours for r in out.itertuples()}
    want = {("A", t): i + (10.0 if i == 0 else 0.0) for i, t in enumerate(hours)} | {("B", t): 0.5 * i for i, t in enumerate(hours)}
    assert got == want
