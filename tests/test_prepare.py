"""Hand-written cases of the preparation rules, and trip ids of any size."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from checks.compare import spark_rows
from odflow import ALL_IMPUTED, CITY, CITY_AS_WRITTEN, CITY_SENTINEL, EXTERNAL, TripInputs, prepare
from odflow.plans import prepare as plans_prepare
from odflow.plans.prepare import slice_days
from odflow.sources.tables import with_precise_times

POOL, OTHER = 28608558, 1
NEVER = datetime(1900, 1, 1)
TRIPS = ("mlsassignedptc string, ptctripid string, trippassengerid string, provider_id int, "
         "request_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
         "pickup_mun_id int, dropoff_mun_id int, pickup_gc_intersection_id long, dropoff_gc_intersection_id long")


def at(minute, day=13):
    return datetime(2018, 9, day, 8, minute) if minute is not None else NEVER


def trip(company, trip_id, passenger, pickup, dropoff, orig=1, dest=2, muns=(69, 69), provider=POOL, request=0):
    return (company, trip_id, passenger, provider, at(request), at(pickup), at(dropoff), *muns, orig, dest)


def inputs(spark, trips):
    points = [(i, i * 1000, 0) for i in range(1, 10)] + [(99999999, None, None), (50, None, None)]
    nodes = [(100 + i, i, "Y", i * 1000, 0) for i in range(1, 10)]
    gates = [(900, 61, None, "shorter_points", 1000, 0), (901, 61, None, "longer_points", 9000, 0)]
    return TripInputs(
        spark.createDataFrame(trips, TRIPS),
        spark.createDataFrame(points, "int_id long, x long, y long"),
        spark.createDataFrame(nodes, "node_id long, link_id long, intrsect string, x long, y long"),
        spark.createDataFrame([(i,) for i in range(1, 10)], "link_id long"),
        spark.createDataFrame(gates, "node_id long, mun_id int, bound string, short_long string, x long, y long"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_city_rules(spark):
    trips = [
        # Two passengers sharing: a picked up, b picked up, a dropped, b dropped.
        trip("u", "pool", "a", 1, 5, 1, 3), trip("u", "pool", "b", 2, 9, 2, 4),
        # The same trip id at another company that is not shared: whole trips, not interleaved.
        trip("v", "pool", "z", 3, 4, 5, 6),
        # Not a pooling provider.
        trip("u", "plain", "c", 1, 5, provider=OTHER), trip("u", "plain", "d", 1, 5, provider=OTHER),
        # b's stops have no valid time, but b still makes the trip a pool.
        trip("u", "late", "a", 1, 5, 1, 3), trip("u", "late", "b", 2, None, 2, 4),
        # A pooled passenger whose only segment is filtered out falls back to the whole trip.
        trip("u", "fall", "a", 1, 4, 1, 2), trip("u", "fall", "b", 2, 3, 50, 50),
        # Two companies sharing one id, both pooled: their stops interleave.
        trip("u", "both", "a", 1, 10, 1, 1), trip("u", "both", "b", 2, 11, 2, 2),
        trip("v", "both", "c", 3, 12, 3, 3), trip("v", "both", "d", 4, 13, 4, 4),
        # No such intersection; no point.
        trip("u", "gone", "a", 1, 5, 77, 2), trip("u", "blank", "a", 1, 5, 50, 2),
    ]
    out = rows(prepare(inputs(spark, trips), CITY), "ptctripid", "trippassengerid", "source", "target", "pooled")
    assert [r for r in out if r[0] == "pool"] == [
        ("pool", "a", 101, 102, True), ("pool", "a", 103, 104, True), ("pool", "b", 102, 103, True),
        ("pool", "z", 105, 106, False)]
    assert [r for r in out if r[0] == "plain"] == [("plain", "c", 101, 102, False), ("plain", "d", 101, 102, False)]
    assert [r for r in out if r[0] == "late"] == [("late", "a", 101, 103, True), ("late", "b", 102, 104, False)]
    # a: 1 -> 50 and 2 are cut by the blank points on both sides, so both of a's stops go.
    assert [r for r in out if r[0] == "fall"] == [("fall", "a", 101, 102, False)]
    assert [r for r in out if r[0] == "both"] == [
        ("both", "a", 101, 102, True), ("both", "a", 101, 102, True), ("both", "b", 102, 103, True),
        ("both", "b", 102, 103, True), ("both", "c", 103, 104, True), ("both", "c", 103, 104, True),
        ("both", "d", 104, 101, True)]
    assert not [r for r in out if r[0] in ("gone", "blank")]


def test_sentinel_rules(spark):
    trips = [trip("u", "t", "a", 1, 5, 1, 3), trip("u", "t", "b", 2, None, 2, 4),
             trip("u", "p", "a", 1, 5, 1, 3), trip("u", "p", "b", 2, 9, 2, 99999999)]
    out = prepare(inputs(spark, trips), CITY_SENTINEL)
    assert "pooled" not in out.columns
    got = rows(out, "ptctripid", "trippassengerid", "pickup_datetime", "source", "target")
    # Segments carry the passenger's pickup; the one to the outside goes, after resequencing.
    assert got[:2] == [("p", "a", at(1), 101, 102), ("p", "b", at(2), 102, 103)]
    # Without b's dropoff time the trip "t" is not a pool.
    assert got[2:] == [("t", "a", at(1), 101, 103), ("t", "b", at(2), 102, 104)]


def test_gateways_and_flags(spark):
    trips = [
        trip("u", "out", "a", 1, 5, 2, 99999999, (69, 61), OTHER), trip("u", "in", "a", 1, 5, 99999999, 5, (61, 69), OTHER),
        trip("u", "city", "a", 1, 5, 1, 2, (69, 69), OTHER), trip("u", "odd", "a", 1, 5, 1, 2, (None, 69), OTHER),
        trip("u", "else", "a", 1, 5, 1, 2, (5, 5), OTHER),
        # The last passenger's only stop in the set is the last one: no row at all for them.
        trip("u", "last", "a", 1, 9, 1, 99999999, (69, 61)), trip("u", "last", "b", 2, 3, 2, 3, (69, 69)),
    ]
    external = rows(prepare(inputs(spark, trips), EXTERNAL), "ptctripid", "trippassengerid", "source", "target", "pooled")
    # From x=2000 the near gateway at 1000 is used; from x=5000 only the far one counts.
    assert external == [("in", "a", 901, 105, False), ("last", "b", 103, 900, True), ("out", "a", 102, 900, False)]
    everything = rows(prepare(inputs(spark, trips), ALL_IMPUTED), "ptctripid", "trippassengerid", "ext_trip", "pooled")
    assert everything == [
        ("city", "a", False, False), ("in", "a", True, False), ("last", "a", False, True), ("last", "b", False, True),
        ("last", "b", True, True), ("odd", "a", None, False), ("out", "a", True, False)]


def test_days_are_half_open_and_separate(spark):
    trips = [trip("u", "t", "a", 1, 5), trip("u", "t", "b", 2, 6)]
    other = [(*t[:4], datetime(2018, 9, 14), *t[5:]) for t in trips[:1]]
    sliced = slice_days(inputs(spark, trips + other).trips, "request_datetime", [(date(2018, 9, 13), date(2018, 9, 14))])
    assert sliced.count() == 2
    out = rows(prepare(inputs(spark, trips + other), CITY), "service_date", "trippassengerid", "pooled")
    # On the 14th the trip has one passenger and is not a pool.
    assert out[-1] == (date(2018, 9, 14), "a", False) and len(out) == 4


def test_precise_times_replace_recorded_ones(spark):
    df = spark.createDataFrame([(1, 2, 3)], "pickup_datetime int, pickup_datetime_precise int, dropoff_datetime_precise int")
    assert with_precise_times(df).first().asDict() == {"pickup_datetime": 2, "dropoff_datetime": 3}


@pytest.mark.parametrize("spec", [CITY, CITY_AS_WRITTEN, CITY_SENTINEL, EXTERNAL, ALL_IMPUTED], ids=lambda s: s.name)
def test_large_trip_ids_take_chunks_with_the_same_result(spark, sf_dir, spec):
    tables = fixtures.trip_inputs(spark, sf_dir)
    assert spark_rows(prepare(tables, spec, hot_rows=3)) == spark_rows(prepare(tables, spec))


def test_one_shuffle_of_the_trips(spark, sf_dir):
    plan = prepare(fixtures.trip_inputs(spark, sf_dir), ALL_IMPUTED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(service_date") == 1
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_day_filter_and_columns_reach_the_scan(spark, tmp_path):
    trips = inputs(spark, [trip("u", "t", "a", 1, 5)]).trips.withColumn("unused", F.lit(1))
    trips.write.parquet(str(tmp_path / "trips"))
    sliced = slice_days(spark.read.parquet(str(tmp_path / "trips")), "request_datetime",
                        [(date(2018, 9, 13), date(2018, 9, 14))])
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(request_datetime" in plan and "unused" not in plan


def test_trips_are_shuffled_once_beside_very_many_places_and_before_they_get_wider(spark, sf_dir, monkeypatch):
    """A million and more intersections are still looked up by broadcasts, on trips as they were read."""
    many = spark.range(1_100_000).selectExpr("id AS int_id", "id AS x", "id AS y", "id AS node")
    monkeypatch.setattr(plans_prepare, "snapped_places", lambda *_: many)
    plan = prepare(fixtures.trip_inputs(spark, sf_dir), ALL_IMPUTED)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(service_date") == 1
    # A plan is printed from its end: the joins come after the shuffle.
    assert plan.rindex("HashJoin [") < plan.index("Exchange hashpartitioning(service_date")
