"""The snap against brute force, and the gateway choice."""

import random

import pytest
from pyspark.sql import functions as F

from odflow.operators import gateways
from odflow.operators.dealt import dealt_join
from odflow.operators.snap import routable_nodes, snap_nearest


def brute(points, places):
    best = {}
    for px, py in points:
        if px is not None and py is not None:
            d2, node = min(((px - x) ** 2 + (py - y) ** 2, node) for x, y, node in places)
            best[(px, py)] = (node, d2)
    return best


def snapped(spark, points, places, kind="double", **options):
    p = spark.createDataFrame(points, f"x {kind}, y {kind}")
    n = spark.createDataFrame(places, f"x {kind}, y {kind}, node_id long")
    return {(r.x, r.y): (r.node_id, r.d2) for r in snap_nearest(p, n, **options).collect()}


def clustered(rng):
    """Most nodes within a metre of each other, some spread out, one far away."""
    places = [(rng.gauss(500, 0.3), rng.gauss(500, 0.3)) for _ in range(400)]
    places += [(rng.uniform(0, 1e4), rng.uniform(0, 1e4)) for _ in range(100)] + [(9e6, -9e6)]
    points = [(rng.gauss(500, 0.5), rng.gauss(500, 0.5)) for _ in range(60)]
    points += [(rng.uniform(-1e4, 2e4), rng.uniform(-1e4, 2e4)) for _ in range(60)] + [(1e7, 1e7), (-5e6, 3e6)]
    return points, [(x, y, i) for i, (x, y) in enumerate(places)]


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_clustered_places(spark, broadcast_rows):
    points, places = clustered(random.Random(5))
    assert snapped(spark, points, places, broadcast_rows=broadcast_rows) == brute(points, places)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
@pytest.mark.parametrize("beyond", [None, 2500])
def test_places_of_the_own_group(spark, broadcast_rows, beyond):
    rng = random.Random(11)
    points, places = clustered(rng)
    # Most points are one place's neighbours, so that a cell with many points is dealt out.
    points += [(500 + k / 1000, 500.0) for k in range(200)]
    grouped = [(rng.choice([61, 61, 61, 38]), *point) for point in points] + [(7, 1.0, 1.0), (None, 2.0, 2.0)]
    gates = [(rng.choice([61, 38, 38]), *place) for place in places] + [(61, None, 1.0, 9000), (None, 3.0, 3.0, 9001)]
    found = snap_nearest(spark.createDataFrame(grouped, "mun int, x double, y double"),
                         spark.createDataFrame(gates, "mun int, x double, y double, node_id long"),
                         broadcast_rows, "mun", beyond, share_rows=20)
    want = {}
    for mun, px, py in grouped:
        distances = [((px - x) ** 2 + (py - y) ** 2, node) for own, x, y, node in gates if own == mun and x is not None and mun is not None]
        distances = [entry for entry in distances if beyond is None or entry[0] > beyond ** 2]
        if distances:
            want[mun, px, py] = min(distances)
    assert {(r.mun, r.x, r.y): (r.d2, r.node_id) for r in found.collect()} == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_dealt_out(spark, how):
    left = spark.createDataFrame([(1, k) for k in range(2000)] + [(None, k) for k in range(500)] + [(2, 0), (2, 0), (3, 5)],
                                 "key int, n int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "other int, value string")
    got = dealt_join(left, right, [("key", "other")], how, share_rows=100)
    want = left.join(right, F.col("key") == F.col("other"), how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_ties_and_missing_points(spark):
    places = [(x * 10, y * 10, 1000 - x - 20 * y) for x in range(20) for y in range(20)]
    points = [(x * 5, y * 5) for x in range(-3, 45) for y in range(-3, 45)] + [(None, None), (3, None)]
    assert snapped(spark, points, places, kind="long") == brute(points, places)


def test_no_places_and_one_place(spark):
    assert snapped(spark, [(1.0, 2.0)], []) == {}
    assert snapped(spark, [(1.0, 2.0)], [(4.0, 6.0, 7)]) == {(1.0, 2.0): (7, 25.0)}


def test_routable_nodes(spark):
    nodes = spark.createDataFrame(
        [(1, 10, "Y", 0, 0), (2, 10, "N", 1, 1), (3, 11, "Y", 2, 2), (4, 10, "Y", 0, 0), (5, 12, None, 3, 3)],
        "node_id long, link_id long, intrsect string, x long, y long")
    links = spark.createDataFrame([(10,), (10,), (12,)], "link_id long")
    assert [tuple(r) for r in routable_nodes(nodes, links).collect()] == [(0, 0, 1)]


GATES = [(1, 61, None, "shorter_points", 3000, 0), (2, 61, "outbound", "shorter_points", 100, 0),
         (3, 61, "inbound", "shorter_points", 50, 0), (4, 61, None, "longer_points", 3000, 1),
         (5, 61, None, "longer_points", 200, 0), (6, 38, "inbound", "longer_points", 9000, 0)]


@pytest.mark.parametrize(("list_rows", "broadcast_rows"), [(10_000, 1_000_000), (0, 1_000_000), (0, 0)])
def test_gateway_choice(spark, monkeypatch, list_rows, broadcast_rows):
    monkeypatch.setattr(gateways, "LIST_ROWS", list_rows)
    gates = spark.createDataFrame(GATES, "node_id long, mun_id int, bound string, short_long string, x long, y long")
    trips = spark.createDataFrame(
        [("near", 61, 0, 0), ("exact", 61, 0, -3000 * 0), ("far", 61, -6000, 0), ("none", 38, 0, 0), ("no point", 61, None, None),
         ("city", 69, 0, 0), ("unknown", None, 0, 0), ("at bound", 61, 6000, 0)], "id string, mun int, px long, py long")

    def chosen(direction):
        return {r.id: r.gate for r in gateways.match_gateway(trips, gates, direction, "mun", "px", "py", "gate",
                                                                    broadcast_rows=broadcast_rows, share_rows=2).collect()}

    out = chosen("outbound")
    assert out["near"] == 2 and out["far"] == 5 and out["none"] is None
    assert out["no point"] is None and out["city"] is None and out["unknown"] is None
    # From (6000, 0) gateway 1 is exactly 3000 away, which still counts as near.
    assert out["at bound"] == 1
    assert chosen("inbound")["near"] == 3
    assert chosen("inbound")["none"] == 6


def test_projection_is_in_metres(spark):
    from odflow.functions.geo import project_xy
    x, y = project_xy(F.lit(-79.0), F.lit(44.0), -79.4, 43.6)
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(row.x - 32_210) < 60 and abs(row.y - 44_478) < 60
