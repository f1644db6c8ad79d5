"""Prepare trips for routing: slice days, place both ends on the network, split pooled trips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.bins import DayRange, in_days
from odflow.operators import pooled
from odflow.operators.gateways import is_short, match_gateway
from odflow.operators.snap import routable_nodes, snap_nearest
from odflow.plans.views import ViewSpec
from odflow.runtime import broadcast_if_small, checkpointed

# The city's municipality, its neighbours, and the intersection for "outside".
CITY_MUN = 69
NEIGHBOUR_MUNS = (61, 38, 71, 57, 8, 41)
OUTSIDE = 99999999

# Intersections that are broadcast at most, four numbers each.
PLACE_ROWS = 2_000_000

# A trip id with more rows than this on one day is split over tasks.
HOT_TRIP_ROWS = 1_000_000

TRIP_COLUMNS = ["mlsassignedptc", "ptctripid", "trippassengerid", "provider_id",
                "pickup_datetime", "dropoff_datetime", "pickup_mun_id", "dropoff_mun_id",
                "pickup_gc_intersection_id", "dropoff_gc_intersection_id"]


@dataclass(frozen=True)
class TripInputs:
    """The tables a preparation reads; gateways only where the rules use them."""

    trips: DataFrame
    intersections: DataFrame
    nodes: DataFrame
    links: DataFrame
    gateways: DataFrame | None = None


def slice_days(trips: DataFrame, time_column: str, days: list[DayRange] | None = None) -> DataFrame:
    """Trips of the given days, or of all, with their service day.

    Each service day is prepared on its own: every later step has it in its key.
    """
    if days is not None:
        trips = trips.filter(in_days(F.col(time_column), days))
    sliced = trips.filter(F.col(time_column).isNotNull())
    return sliced.select(F.to_date(time_column).alias("service_date"), *TRIP_COLUMNS)


def snapped_places(intersections: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Every intersection with its nearest routable node: (int_id, x, y, node).

    Intersections are snapped, not trips: there are a few thousand of them however many trips.
    The table is kept, because both ends of the trips are looked up in it.
    """
    places = checkpointed(routable_nodes(nodes, links))
    nearest = snap_nearest(intersections, places).select("x", "y", F.col("node_id").alias("node"))
    return checkpointed(intersections.select("int_id", "x", "y").join(nearest, ["x", "y"], "left")
                        .select("int_id", "x", "y", "node"))


def place_ends(trips: DataFrame, inputs: TripInputs, spec: ViewSpec,
               broadcast_rows: int = PLACE_ROWS, dealt_by: list[str] | None = None) -> DataFrame:
    """Add source and target nodes and whether each end has a point.

    A trip whose intersection is not listed is dropped; one whose intersection has no point
    keeps a NULL node. With ``dealt_by`` the rows are left partitioned by these columns; where every lookup is broadcast, trips
    are shuffled before they get wider.
    """
    places = snapped_places(inputs.intersections, inputs.nodes, inputs.links)
    small = places.limit(broadcast_rows + 1).count() <= broadcast_rows
    short = is_short(inputs.gateways) if spec.gateways else True
    first = dealt_by is not None and small and short
    if first:
        trips = trips.repartition(*dealt_by)
    places = F.broadcast(places) if small else places
    orig = places.select(F.col("int_id").alias("pickup_gc_intersection_id"), F.col("x").alias("ox"),
                         F.col("y").alias("oy"), F.col("node").alias("source"))
    dest = places.select(F.col("int_id").alias("dropoff_gc_intersection_id"), F.col("x").alias("dx"),
                         F.col("y").alias("dy"), F.col("node").alias("target"))
    placed = (trips.join(orig, "pickup_gc_intersection_id").join(dest, "dropoff_gc_intersection_id")
              .withColumns({"has_orig": F.col("ox").isNotNull(), "has_dest": F.col("dx").isNotNull()}))
    if spec.snap == "all":
        # With no candidate node at all there is nothing to snap to, and no trip is kept.
        if places.filter("node IS NOT NULL").isEmpty() and routable_nodes(inputs.nodes, inputs.links).isEmpty():
            placed = placed.limit(0)
    else:
        placed = placed.withColumns({
            "source": F.when(F.col("pickup_mun_id") == CITY_MUN, F.col("source")),
            "target": F.when(F.col("dropoff_mun_id") == CITY_MUN, F.col("target")),
        })
    if spec.gateways:
        placed = match_gateway(placed, inputs.gateways, "outbound", "dropoff_mun_id", "ox", "oy", "gate_out", short)
        placed = match_gateway(placed, inputs.gateways, "inbound", "pickup_mun_id", "dx", "dy", "gate_in", short)
        placed = placed.withColumns({
            "source": F.coalesce("gate_in", "source"),
            "target": F.coalesce("gate_out", "target"),
        })
    placed = placed.select("service_date", *TRIP_COLUMNS, "source", "target", "has_orig", "has_dest")
    return placed if first or dealt_by is None else placed.repartition(*dealt_by)


def _external(orig_mun: Column, dest_mun: Column) -> Column:
    return dest_mun.isin(*NEIGHBOUR_MUNS) | orig_mun.isin(*NEIGHBOUR_MUNS)


def _keeps(spec: ViewSpec) -> Column:
    """The endpoint rule on a row and its ``next``, for segments and whole trips alike."""
    if spec.endpoint_rule == "has_geom":
        kept = F.col("has_point") & F.col("next.has_point")
    elif spec.endpoint_rule == "null_geom":
        kept = ~F.col("has_point") & ~F.col("next.has_point")
    elif spec.endpoint_rule == "sentinel":
        kept = (F.col("int_id") != OUTSIDE) & (F.col("next.int_id") != OUTSIDE)
    else:
        kept = _external(F.col("mun_id"), F.col("next.mun_id"))
        if spec.endpoint_rule == "external_or_city":
            kept = kept | (F.col("mun_id") == CITY_MUN) | (F.col("next.mun_id") == CITY_MUN)
    if spec.drop_last == "set":
        kept = kept & F.col("next").isNotNull()
    return F.coalesce(kept, F.lit(False))


def _has_stops(spec: ViewSpec) -> Column:
    # Without valid times a passenger still counts towards a pool but has no stops in it.
    return pooled.has_valid_times() if spec.valid_time == "row" else F.lit(True)


def _by_windows(placed: DataFrame, spec: ViewSpec) -> DataFrame:
    """Segments and the trips they leave over; ``placed`` is partitioned by trip id, which serves all windows."""
    trips = pooled.with_pool_flag(placed, spec.valid_time)
    stops_of = F.coalesce(F.col("is_pooled") & _has_stops(spec), F.lit(False))
    rows = pooled.with_next_stop(pooled.trip_stops(trips, where=stops_of)).withColumn("kept", _keeps(spec))
    passenger = Window.partitionBy(*pooled.TRIP_KEY, "trippassengerid")
    named = F.col("ptctripid").isNotNull() & F.col("trippassengerid").isNotNull()
    covered = named & F.max(F.col("kept") & F.col("kind").isNotNull()).over(passenger)
    return rows.withColumn("covered", covered).filter("kept AND (kind IS NOT NULL OR NOT covered)")


def _by_chunks(placed: DataFrame, spec: ViewSpec) -> DataFrame:
    """The same rows for trip ids of any size, by aggregates, joins and chunked order."""
    keys = pooled.pooled_keys(placed, spec.valid_time)
    shared = placed.join(keys, ["service_date", "mlsassignedptc", "ptctripid"], "left_semi")
    segments = pooled.lead_in_chunks(pooled.trip_stops(shared.filter(_has_stops(spec)))).filter(_keeps(spec))
    covered = segments.select("service_date", "ptctripid", "trippassengerid").distinct()
    rest = placed.join(covered, ["service_date", "ptctripid", "trippassengerid"], "left_anti")
    return segments.unionByName(pooled.whole_trips(rest).filter(_keeps(spec)))


def _hot_trips(sliced: DataFrame, hot_rows: int) -> DataFrame:
    """Trip ids with more than ``hot_rows`` rows on a day; at most rows / hot_rows of them."""
    return sliced.groupBy(*pooled.TRIP_KEY).count().filter(F.col("count") > hot_rows).select(*pooled.TRIP_KEY)


def _rows(inputs: TripInputs, spec: ViewSpec, days: list[DayRange] | None, hot_rows: int) -> DataFrame:
    sliced = slice_days(inputs.trips, spec.time_column, days)
    hot = _hot_trips(sliced, hot_rows)
    if hot.isEmpty():
        return _by_windows(place_ends(sliced, inputs, spec, dealt_by=pooled.TRIP_KEY), spec)
    hot = broadcast_if_small(hot.select(*[F.col(name).alias(f"hot_{name}") for name in pooled.TRIP_KEY]))
    is_hot = (F.col("service_date").eqNullSafe(F.col("hot_service_date"))
              & F.col("ptctripid").eqNullSafe(F.col("hot_ptctripid")))
    usual = place_ends(sliced.join(hot, is_hot, "left_anti"), inputs, spec, dealt_by=pooled.TRIP_KEY)
    large = place_ends(sliced.join(hot, is_hot, "left_semi"), inputs, spec)
    rows = _by_chunks(large, spec)
    return _by_windows(usual, spec).select(*rows.columns).unionByName(rows)


def _output(rows: DataFrame, spec: ViewSpec) -> DataFrame:
    is_segment = F.col("kind").isNotNull()
    if spec.drop_last == "final":
        rows = rows.filter(~is_segment | F.col("next.ts").isNotNull())
    flags = [is_segment.alias("pooled")] if spec.emit_pooled else []
    if spec.emit_ext_trip:
        # A segment is external or not; for a whole trip an unknown municipality stays unknown.
        external = _external(F.col("mun_id"), F.col("next.mun_id"))
        flags.append(F.when(is_segment, F.coalesce(external, F.lit(False))).otherwise(external).alias("ext_trip"))
    starts = "ts" if spec.segment_pickup == "stop" else "pickup_datetime"
    return rows.select("service_date", "mlsassignedptc", "ptctripid", "trippassengerid",
                       F.col(starts).alias("pickup_datetime"), F.col("int_id").alias("pickup_gc_intersection_id"),
                       F.col("node").alias("source"), F.col("next.ts").alias("dropoff_datetime"),
                       F.col("next.int_id").alias("dropoff_gc_intersection_id"),
                       F.col("next.node").alias("target"), *flags)


def prepare(inputs: TripInputs, spec: ViewSpec, days: list[DayRange] | None = None,
            hot_rows: int = HOT_TRIP_ROWS) -> DataFrame:
    """Trips ready for routing: whole trips and the segments of pooled ones, by service day."""
    return _output(_rows(inputs, spec, days, hot_rows), spec)


def resequence_stops(inputs: TripInputs, spec: ViewSpec, days: list[DayRange] | None = None,
                     hot_rows: int = HOT_TRIP_ROWS) -> DataFrame:
    """Only the segments between consecutive stops of pooled trips."""
    return _output(_rows(inputs, spec, days, hot_rows).filter("kind IS NOT NULL"), spec)


def unpooled_trips(inputs: TripInputs, spec: ViewSpec, days: list[DayRange] | None = None,
                   hot_rows: int = HOT_TRIP_ROWS) -> DataFrame:
    """Only the trips of passengers that no segment covers."""
    return _output(_rows(inputs, spec, days, hot_rows).filter("kind IS NULL"), spec)
