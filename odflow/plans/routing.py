"""Route prepared trips: all bins of all days in one run, and an account of every bin."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.functions.bins import DayRange, bin_of, bins_of, in_days
from odflow.operators.paths import PAIR, Search, od_pairs, path_rows, search
from odflow.operators.ranges import dense_rank_in, numbered_in
from odflow.runtime import broadcast_if_small, checkpointed, stored
from odflow.sources.network import TimedNetwork
from odflow.sources.tables import read_prepared, read_routed, write_audit, write_routed

log = logging.getLogger(__name__)

TRIP = ["mlsassignedptc", "ptctripid", "trippassengerid"]
ROUTE = ["service_date", "bin_start", *TRIP, "start_vid", "end_vid"]
# Trip ranks per batch of origins and destinations, and the most pairs of an array.
BATCH_RANKS = 250
ARRAY_PAIRS = 100_000
# Rows without an end match no path; they are dealt out over this many keys of their own.
LOOSE_KEYS = 64

OUTCOMES = ["routed", "unreachable", "same_vertex", "no_vertex", "no_node", "outside_bins"]


def with_bins(prepared: DataFrame, days: list[DayRange]) -> DataFrame:
    """Add ``bin_start``, the five-minute bin of the pickup.

    It is NULL for a pickup outside the bins of the trip's own service day, such as a trip
    requested before and picked up after midnight.
    """
    # A missing pickup gets a stand-in, because the window expression discards rows without a time.
    some_time = F.coalesce("pickup_datetime", F.lit("1970-01-01").cast("timestamp_ntz"))
    own_day = (F.to_date("pickup_datetime") == F.col("service_date")) & in_days(F.col("pickup_datetime"), days)
    return (prepared.withColumn("bin_start", bin_of(some_time))
            .withColumn("bin_start", F.when(own_day, F.col("bin_start"))))


def distinct_vertices(vertex_map: DataFrame) -> DataFrame:
    return vertex_map.select("vertex_id", "node_id").distinct()


def map_vertices(binned: DataFrame, vertex_map: DataFrame, how: str = "inner") -> DataFrame:
    """Turn end nodes into vertices; a node with several vertices gives several rows.

    The nodes stay in ``source_node`` and ``target_node``.
    """
    vertices = distinct_vertices(vertex_map)
    source = vertices.select(F.col("node_id").alias("source_node"), F.col("vertex_id").alias("source"))
    target = vertices.select(F.col("node_id").alias("target_node"), F.col("vertex_id").alias("target"))
    return (binned.withColumnsRenamed({"source": "source_node", "target": "target_node"})
            .join(broadcast_if_small(source, sized_by=vertex_map), "source_node", how)
            .join(broadcast_if_small(target, sized_by=vertex_map), "target_node", how))


def trips_with_ends(prepared: DataFrame, vertex_map: DataFrame, network: TimedNetwork,
                    days: list[DayRange]) -> DataFrame:
    """The distinct trips to route, with their bin, cost profile and end vertices."""
    binned = with_bins(prepared, days).filter("bin_start IS NOT NULL")
    mapped = map_vertices(binned, vertex_map)
    return (mapped.select("service_date", "bin_start", *TRIP, "source", "target").distinct()
            .withColumn("profile", network.profile(F.col("bin_start"))))


def od_batches(prepared: DataFrame, vertex_map: DataFrame, days: list[DayRange],
               ranks: int = BATCH_RANKS) -> DataFrame:
    """Origins and destinations of each bin, ``ranks`` trip ids a batch, one row per pair.

    (service_date, bin_start, batch, ptctripid, source, target). Trips without an id are ranked
    last. The router does not need batches; they feed an outside many-to-many solver.
    """
    group = ["service_date", "bin_start"]
    mapped = map_vertices(with_bins(prepared, days).filter("bin_start IS NOT NULL"), vertex_map)
    mapped = checkpointed(mapped.select(*group, "ptctripid", "source", "target"))
    ranked = dense_rank_in(mapped, group, "ptctripid", "trip_rank")
    batch = F.call_function("div", "trip_rank", F.lit(ranks).cast("long"))
    return ranked.select(*group, batch.alias("batch"), "ptctripid", "source", "target")


def batch_arrays(batches: DataFrame, array_pairs: int = ARRAY_PAIRS) -> DataFrame:
    """The pairs of ``od_batches`` as parallel arrays: (service_date, bin_start, batch, part, sources, targets).

    The pairs of a batch are numbered by trip id, source and target; every ``array_pairs`` of them fill an
    array, so a batch has as many arrays as its pairs need, and a trip id with very many of them several.
    """
    batch = ["service_date", "bin_start", "batch"]
    numbered = numbered_in(batches, batch, ["ptctripid", "source", "target"], "place")
    part = F.call_function("div", F.col("place") - 1, F.lit(array_pairs).cast("long")).alias("part")
    arrays = (numbered.select(*batch, part, F.struct("place", "source", "target").alias("pair"))
              .groupBy(*batch, "part").agg(F.array_sort(F.collect_list("pair")).alias("pairs")))
    return arrays.select(*batch, "part", F.col("pairs.source").alias("sources"), F.col("pairs.target").alias("targets"))


def found_in(routed: DataFrame, network: TimedNetwork) -> DataFrame:
    """The pairs that have a path, (profile, source, target, dist), read off routed rows: each path has one row with edge -1."""
    last = routed.filter("edge = -1").select(network.profile(F.col("bin_start")).alias("profile"), F.col("start_vid").alias("source"),
                                             F.col("end_vid").alias("target"), "agg_cost")
    return last.groupBy(*PAIR).agg(F.min("agg_cost").alias("dist"))


@dataclass(frozen=True)
class Routing:
    """The searched paths of some days, from which rows and accounts are drawn."""

    prepared: DataFrame
    vertex_map: DataFrame
    network: TimedNetwork
    days: list[DayRange]
    trips: DataFrame
    result: Search

    def paths(self) -> DataFrame:
        return path_rows(self.result)

    def routed(self) -> DataFrame:
        """Path rows of every trip that has a path."""
        return self.routes().filter("error IS NULL").select(*ROUTE, F.inline("steps"))

    def routes(self) -> DataFrame:
        """A row per trip that has a path, with its ``steps``, and rows with an ``error`` for profiles whose network cannot be searched.

        Trips go along to the search, so paths are neither stored nor shuffled to meet them.
        """
        met = self.result.along(self.trips.filter("source <> target"))
        return met.withColumnsRenamed({"source": "start_vid", "target": "end_vid"}).select(*ROUTE, "steps", "profile", "error")

    def failures(self, known: DataFrame | None = None) -> DataFrame:
        """Bins whose network cannot be searched: (service_date, bin_start, error), those with trips to route only.

        ``known`` are the failures (profile, error) of a search that was made.
        """
        bins = self.trips.select("service_date", "bin_start", "profile").distinct()
        known = checkpointed(self.result.failures) if known is None else known
        return bins.join(broadcast_if_small(known), "profile").select("service_date", "bin_start", "error")

    def outcomes(self, found: DataFrame | None = None) -> DataFrame:
        """Every prepared row, once per pair of end vertices, and what became of it.

        ``found`` are the pairs that have a path, (profile, source, target, dist), if a search was made.
        """
        binned = with_bins(self.prepared, self.days)
        mapped = (map_vertices(binned, self.vertex_map, "left")
                  .withColumn("profile", self.network.profile(F.col("bin_start"))))
        loose = F.col("bin_start").isNull() | F.col("source").isNull() | F.col("target").isNull()
        spread = F.when(loose, 1 + F.pmod(F.xxhash64(*TRIP, "pickup_datetime"), F.lit(LOOSE_KEYS))).otherwise(F.lit(0))
        mapped = mapped.withColumn("spread", spread)
        found = (self.result.found if found is None else found).select(*PAIR, "dist", F.lit(0).cast("long").alias("spread"))
        outcome = (F.when(F.col("bin_start").isNull(), "outside_bins")
                   .when(F.col("source_node").isNull() | F.col("target_node").isNull(), "no_node")
                   .when(F.col("source").isNull() | F.col("target").isNull(), "no_vertex")
                   .when(F.col("source") == F.col("target"), "same_vertex")
                   .when(F.col("dist").isNull(), "unreachable").otherwise("routed"))
        return mapped.join(found, [*PAIR, "spread"], "left").drop("spread").withColumn("outcome", outcome)

    def unrouted(self) -> DataFrame:
        """The rows that yield no path, with the reason."""
        return self.outcomes().filter("outcome <> 'routed'").select(
            "service_date", "bin_start", *TRIP, "source", "target", "outcome")

    def audit(self, found: DataFrame | None = None) -> DataFrame:
        """Counts per bin, a row for every bin of the days and one per day for rows outside them."""
        counts = [F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]
        per_bin = self.outcomes(found).groupBy("service_date", "bin_start").agg(
            F.count("*").alias("prepared"), *counts)
        bins = bins_of(self.prepared.sparkSession, self.days)
        empty = bins.select("service_date", "bin_start", *[F.lit(0).cast("long").alias(name)
                                                           for name in ["prepared", *OUTCOMES]])
        return (per_bin.unionByName(empty).groupBy("service_date", "bin_start")
                .agg(*[F.sum(name).alias(name) for name in ["prepared", *OUTCOMES]]))


def route_days(prepared: DataFrame, vertex_map: DataFrame, network: TimedNetwork,
               days: list[DayRange]) -> Routing:
    """Search the paths of all trips of the days."""
    trips = stored(trips_with_ends(prepared, vertex_map, network, days), "trips")
    return Routing(prepared, vertex_map, network, days, trips, search(od_pairs(trips), network))


def route_trips(prepared: DataFrame, vertex_map: DataFrame, network: TimedNetwork,
                days: list[DayRange]) -> DataFrame:
    """Path rows of all trips of the days."""
    return route_days(prepared, vertex_map, network, days).routed()


@dataclass(frozen=True)
class RouteJob:
    """Days to route, the prepared table to read, and the tables to write."""

    days: list[DayRange]
    prepared_path: str
    routed_path: str
    audit_path: str | None = None


@dataclass(frozen=True)
class JobRecord:
    """What became of a job: ``error`` is None for one that was written."""

    job: RouteJob
    error: str | None = None


def run_job(spark, job: RouteJob, vertex_map: DataFrame, network: TimedNetwork) -> Routing:
    """Route a prepared table into its destination; a rerun replaces all bins of the job's days."""
    prepared = read_prepared(spark, job.prepared_path)
    prepared = prepared.filter(in_days(F.col("service_date").cast("timestamp_ntz"), job.days))
    routing = route_days(prepared, vertex_map, network, job.days)
    write_routed(routing.routed(), job.routed_path, job.days)
    if job.audit_path is not None:
        found = found_in(read_routed(spark, job.routed_path).filter(in_days(F.col("bin_start"), job.days)), network)
        write_audit(routing.audit(found), job.audit_path, job.days)
    return routing


def run_jobs(spark, jobs: list[RouteJob], vertex_map: DataFrame, network: TimedNetwork) -> list[JobRecord]:
    """Several (days, source, destination) jobs in one run; a job holds all its bins.

    A job that fails does not stop the ones after it; its record has the error.
    """
    records = []
    for job in jobs:
        try:
            run_job(spark, job, vertex_map, network)
            records.append(JobRecord(job))
        except Exception as error:
            log.exception("routing %s into %s failed", job.days, job.routed_path)
            records.append(JobRecord(job, f"{type(error).__name__}: {error}"))
    return records
