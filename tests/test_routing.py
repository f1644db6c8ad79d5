"""Bins, routing runs, their tables and their accounts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from odflow import RouteJob, TimedNetwork, run_jobs
from odflow.functions.bins import bins_of, in_days, step_of_day
from odflow.operators.ranges import numbered_in
from odflow.plans.routing import batch_arrays, od_batches, with_bins
from odflow.runtime import session_conf
from odflow.sources import network as network_module
from odflow.sources.tables import read_routed, write_prepared

DAY = [(date(2018, 9, 13), date(2018, 9, 14))]
PREPARED = ("service_date date, mlsassignedptc string, ptctripid string, trippassengerid string, "
            "pickup_datetime timestamp_ntz, source long, target long")


def row(trip, passenger, when, source, target):
    return (date(2018, 9, 13), "u", trip, passenger, when, source, target)


def at(hour, minute, second=0, day=13):
    return datetime(2018, 9, day, hour, minute, second)


ROWS = [
    row("a", "1", at(8, 0), 1, 3), row("a", "1", at(8, 4, 59), 1, 3), row("b", "1", at(8, 5), 1, 3),
    row("c", "1", at(8, 0), 1, 1), row("d", "1", at(8, 0), 3, 1), row("e", "1", at(8, 0), None, 3),
    row("f", "1", at(8, 0), 7, 3), row("g", "1", at(0, 1, day=14), 1, 3), row("h", "1", None, 1, 3),
    # Node 5 is two vertices.
    row("i", "1", at(8, 0), 5, 3),
]
VERTICES = [(10, 1), (10, 1), (20, 2), (30, 3), (50, 5), (51, 5)]
# From 10 the cheap way changes at 08:05.
NETWORK = [(at(8, 0), 1, 10, 20, 1), (at(8, 0), 2, 20, 30, 1), (at(8, 0), 3, 10, 30, 5),
           (at(8, 5), 1, 10, 20, 9), (at(8, 5), 2, 20, 30, 1), (at(8, 5), 3, 10, 30, 5),
           (at(8, 0), 4, 50, 30, 2), (at(8, 0), 5, 51, 50, 2)]


def tables(spark):
    return (spark.createDataFrame(ROWS, PREPARED),
            spark.createDataFrame(VERTICES, "vertex_id long, node_id long"),
            TimedNetwork.from_table(spark.createDataFrame(
                NETWORK, "bin_start timestamp_ntz, id long, source long, target long, cost long")))


def test_bins(spark):
    bins = bins_of(spark, [*DAY, (date(2018, 11, 4), date(2018, 11, 5))])
    # A day has 288 bins, also the one on which clocks change.
    assert bins.count() == 576 and bins.distinct().count() == 576
    binned = with_bins(tables(spark)[0], DAY)
    assert [r.bin_start for r in binned.orderBy("ptctripid", "pickup_datetime").collect()] == [
        at(8, 0), at(8, 0), at(8, 5), at(8, 0), at(8, 0), at(8, 0), at(8, 0), None, None, at(8, 0)]
    assert bins.agg(F.max(step_of_day(F.col("bin_start")))).first()[0] == 287


def test_run_twice(spark, tmp_path):
    prepared, vertices, network = tables(spark)
    source, routed, audit = (str(tmp_path / name) for name in ("prepared", "routed", "audit"))
    write_prepared(prepared, source)
    for _ in range(2):
        run_jobs(spark, [RouteJob(DAY, source, routed, audit)], vertices, network)
    rows = read_routed(spark, routed)
    got = sorted((r.ptctripid, r.bin_start, r.start_vid, r.path_seq, r.node, r.edge, r.agg_cost) for r in rows.collect())
    # Equal trips of a passenger within a bin are one; the path follows the costs of the bin.
    assert got == [
        ("a", at(8, 0), 10, 1, 10, 1, 0), ("a", at(8, 0), 10, 2, 20, 2, 1), ("a", at(8, 0), 10, 3, 30, -1, 2),
        ("b", at(8, 5), 10, 1, 10, 3, 0), ("b", at(8, 5), 10, 2, 30, -1, 5),
        ("i", at(8, 0), 50, 1, 50, 4, 0), ("i", at(8, 0), 50, 2, 30, -1, 2),
        ("i", at(8, 0), 51, 1, 51, 5, 0), ("i", at(8, 0), 51, 2, 50, 4, 2), ("i", at(8, 0), 51, 3, 30, -1, 4)]
    counts = spark.read.parquet(audit)
    assert counts.count() == 289
    eight = counts.filter(F.col("bin_start") == F.lit("2018-09-13 08:00:00").cast("timestamp_ntz")).first()
    # The node of two vertices counts once per vertex.
    assert (eight.prepared, eight.routed, eight.same_vertex, eight.unreachable, eight.no_node, eight.no_vertex) == (
        8, 4, 1, 1, 1, 1)
    assert counts.filter("bin_start IS NULL").first().outside_bins == 2


def test_batches(spark):
    rows = [row(f"t{i:04d}", "1", at(8, 0), 1, 3) for i in range(501)] + [row("t0400", str(i), at(8, 0), 1, 3) for i in range(40)]
    rows += [row(None, str(i), at(8, 0), 1, 3) for i in range(3)]
    prepared = spark.createDataFrame(rows, PREPARED)
    pairs = od_batches(prepared, tables(spark)[1], DAY)
    # Ranks start at 1, so the first batch has 249 trip ids; trips without an id share the last rank.
    assert {r.batch: r["count"] for r in pairs.groupBy("batch").count().collect()} == {0: 249, 1: 290, 2: 5}
    assert pairs.filter("ptctripid IS NULL").count() == 3
    arrays = batch_arrays(pairs).collect()
    assert sum(len(r.sources) for r in arrays) == 544
    assert all(s == 10 and t == 30 for r in arrays for s, t in zip(r.sources, r.targets, strict=True))


def test_arrays_follow_the_pairs_of_a_hot_trip(spark):
    rows = [row("hot", str(i), at(8, 0), 1 + i % 2, 3) for i in range(3000)] + [row("a", "1", at(8, 0), 1, 3)]
    rows += [row(None, str(i), at(8, 0), 2, 3) for i in range(30)]
    pairs = od_batches(spark.createDataFrame(rows, PREPARED), tables(spark)[1], DAY)
    arrays = batch_arrays(pairs, 100).orderBy("batch", "part").collect()
    # Three trip ids are one batch; all its arrays but the last are full.
    assert [len(r.sources) for r in arrays] == [100] * 30 + [31] and [r.part for r in arrays] == list(range(31))
    assert [s for r in arrays for s in r.sources] == [10] + [10] * 1500 + [20] * 1500 + [20] * 30
    numbered = numbered_in(pairs, ["batch"], ["ptctripid", "source"], "place", rows_per_chunk=97).collect()
    assert sorted(r.place for r in numbered) == list(range(1, 3032))
    assert all(r.place > 3001 for r in numbered if r.ptctripid is None)


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto", "Asia/Tokyo"])
def test_days_and_bins_do_not_move_with_the_session_zone(spark, zone):
    moments = [at(0, 0), at(0, 4, 59), at(23, 55), at(23, 59, 59), at(23, 59, 59, day=12), at(0, 0, day=14)]
    prepared = spark.createDataFrame([row(str(k), "1", when, 1, 3) for k, when in enumerate(moments)], PREPARED)
    with session_conf(spark, **{"spark.sql.session.timeZone": zone}):
        assert prepared.filter(in_days(F.col("pickup_datetime"), DAY)).count() == 4
        binned = with_bins(prepared, DAY).orderBy("ptctripid").collect()
        assert [r.bin_start for r in binned] == [at(0, 0), at(0, 0), at(23, 55), at(23, 55), None, None]
        bins = bins_of(spark, DAY).agg(F.min("bin_start"), F.max("bin_start"), F.countDistinct("service_date")).first()
        assert tuple(bins) == (at(0, 0), at(23, 55), 1)


def test_a_rerun_empties_bins_that_have_no_rows_now(spark, tmp_path):
    prepared, vertices, network = tables(spark)
    source, routed = str(tmp_path / "prepared"), str(tmp_path / "routed")
    other = spark.createDataFrame([(date(2018, 9, 14), "u", "z", "1", at(8, 0, day=14), 1, 3)], PREPARED)
    write_prepared(prepared.unionByName(other), source)
    timed = TimedNetwork(network.edges.filter("profile = TIMESTAMP_NTZ'2018-09-13 08:00:00'").drop("profile")
                         .withColumn("profile", F.lit(0)), profile=lambda bin_start: F.lit(0))
    both = [(date(2018, 9, 13), date(2018, 9, 15))]
    run_jobs(spark, [RouteJob(both, source, routed)], vertices, timed)
    before = {r.bin_start for r in read_routed(spark, routed).select("bin_start").distinct().collect()}
    assert before == {at(8, 0), at(8, 5), at(8, 0, day=14)}
    write_prepared(prepared.filter("ptctripid <> 'b'"), source, DAY)
    run_jobs(spark, [RouteJob(DAY, source, routed)], vertices, timed)
    assert {r.bin_start for r in read_routed(spark, routed).select("bin_start").distinct().collect()} == before - {at(8, 5)}
    write_prepared(prepared.limit(0), source, both)
    assert not list((tmp_path / "prepared").glob("service_date=*"))


def test_days_in_a_gap_are_left_alone(spark, tmp_path):
    _, vertices, network = tables(spark)
    rows = [(date(2018, 9, day), "u", "a", "1", at(8, 0, day=day), 1, 3) for day in (13, 14, 15)]
    source, routed, audit = (str(tmp_path / name) for name in ("prepared", "routed", "audit"))
    write_prepared(spark.createDataFrame(rows, PREPARED), source)
    days = [(date(2018, 9, 13), date(2018, 9, 14)), (date(2018, 9, 15), date(2018, 9, 16))]
    run_jobs(spark, [RouteJob(days, source, routed, audit)], vertices, network)
    assert {str(r.service_date) for r in spark.read.parquet(audit).select("service_date").distinct().collect()} == {
        "2018-09-13", "2018-09-15"}


def test_a_failed_job_is_recorded_and_the_others_run(spark, tmp_path):
    prepared, vertices, network = tables(spark)
    source, routed = str(tmp_path / "prepared"), str(tmp_path / "routed")
    write_prepared(prepared, source)
    records = run_jobs(spark, [RouteJob(DAY, str(tmp_path / "missing"), routed), RouteJob(DAY, source, routed)], vertices, network)
    assert [record.error is None for record in records] == [False, True] and "missing" in records[0].error
    assert read_routed(spark, routed).count() > 0


def test_few_files_in_order(spark, tmp_path):
    rows = [row(f"t{k:04d}", "1", at(8, k % 10), 1, 3) for k in range(400)]
    prepared = spark.createDataFrame(rows, PREPARED).repartition(16)
    write_prepared(prepared, str(tmp_path / "prepared"))
    files = list((tmp_path / "prepared").glob("service_date=*/part-*"))
    assert len(files) == 1
    ids = [r.ptctripid for r in spark.read.parquet(str(files[0])).collect()]
    assert ids == sorted(ids)


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_a_bin_is_looked_at_once_however_many_edges_it_has(spark, max_rows, monkeypatch):
    every = network_module.every_edge
    monkeypatch.setattr(network_module, "every_edge", lambda *args: every(*args, max_rows=max_rows))
    looks = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def profile(bin_start):
        looks.add(1)
        return bin_start.hour

    edges = spark.range(200).selectExpr("id", "id AS source", "id + 1 AS target", "id * 10 AS base")
    network = TimedNetwork(edges, profile=profile, cost=lambda profile, edge: edge("base") + profile)
    rows = network.for_days([(date(2024, 3, 1), date(2024, 3, 2))]).agg(F.count("*"), F.sum("cost")).first()
    assert tuple(rows) == (288 * 200, 288 * sum(range(200)) * 10 + 200 * 12 * sum(range(24)))
    assert looks.value <= 2 * 288


def test_a_rewrite_stores_its_rows_once(spark, tmp_path, monkeypatch):
    """No copy of the rows beside the table, and the days without rows lose what they had."""
    trips = spark.createDataFrame([row("t1", "p1", datetime(2018, 9, 13, 8), 1, 2)], PREPARED)
    path = str(tmp_path / "prepared")
    write_prepared(trips, path, DAY)
    made = []
    plain = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda df, *args, **named: (made.append(df), plain(df, *args, **named))[1])
    write_prepared(trips, path, DAY)
    assert not made and spark.read.parquet(path).count() == 1
    write_prepared(trips.limit(0), path, DAY)
    assert not made and not list((tmp_path / "prepared").glob("service_date=*"))
