"""The registered queries: each operator over the whole of the driver's tables, and its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import fixtures
from checks.oracles import statement
from odflow.functions.bins import bins_of
from odflow.operators import pooled
from odflow.operators.gateways import match_gateway
from odflow.operators.paths import od_pairs, path_rows, search
from odflow.operators.snap import routable_nodes, snap_nearest
from odflow.plans import prepare as prep
from odflow.plans import routing
from odflow.plans.journal import BinRun, read_routed_bins, run_bins
from odflow.runtime import checkpointed, shared_folder
from odflow.sources import tables
from odflow.sources.network import TimedNetwork
from odflow.sources.quarantine import constraints, split
from odflow.sources.versions import lookup
from odflow.plans.views import ALL_IMPUTED, CITY, CITY_AS_WRITTEN, CITY_SENTINEL, EXTERNAL, ViewSpec

DAYS = [(date(*fixtures.FIRST_DAY), date(*fixtures.AFTER_LAST_DAY))]
PREPARED = ("service_date, mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, pickup_gc_intersection_id, "
            "source, dropoff_datetime, dropoff_gc_intersection_id, target")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, oracle: str):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = query
        ORACLES[name] = statement(oracle)
        return query
    return add


def _placed(spark: SparkSession, sf_dir: str, spec: ViewSpec) -> DataFrame:
    inputs = fixtures.trip_inputs(spark, sf_dir)
    return prep.place_ends(prep.slice_days(inputs.trips, spec.time_column, DAYS), inputs, spec)


@_register("day_slice", """SELECT CAST(request_datetime AS DATE) AS service_date, mlsassignedptc, ptctripid,
    trippassengerid, pickup_datetime FROM trips
    WHERE request_datetime >= TIMESTAMP '2024-01-01' AND request_datetime < TIMESTAMP '2024-01-31'""")
def day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    sliced = prep.slice_days(fixtures.trips(spark, sf_dir), "request_datetime", DAYS)
    return sliced.select("service_date", "mlsassignedptc", "ptctripid", "trippassengerid", "pickup_datetime")


@_register("routable_nodes", "SELECT x, y, min(node_id) AS node_id FROM places GROUP BY x, y")
def query_routable_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routable_nodes(fixtures.nodes(spark, sf_dir), fixtures.links(spark, sf_dir))


@_register("nearest_node", "SELECT x, y, best.node AS node_id, best.d AS d2 FROM snapped")
def nearest_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = routable_nodes(fixtures.nodes(spark, sf_dir), fixtures.links(spark, sf_dir))
    return snap_nearest(fixtures.intersections(spark, sf_dir), places)


@_register("nearest_node_by_cells", "SELECT x, y, best.node AS node_id, best.d AS d2 FROM snapped")
def nearest_node_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as if no level of cells were small enough to be broadcast."""
    places = routable_nodes(fixtures.nodes(spark, sf_dir), fixtures.links(spark, sf_dir))
    return snap_nearest(fixtures.intersections(spark, sf_dir), places, broadcast_rows=0)


_ENDS = "mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, source, target"


@_register("snap_unguarded", f"SELECT {_ENDS} FROM placed_all WHERE request_datetime < TIMESTAMP '2024-01-31' "
                             "AND request_datetime >= TIMESTAMP '2024-01-01'")
def snap_unguarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir, CITY).select(*_ENDS.split(", "))


@_register("snap_city", """SELECT mlsassignedptc, ptctripid, trippassengerid, pickup_datetime,
    CASE WHEN pickup_mun_id = 69 THEN o_node END AS source, CASE WHEN dropoff_mun_id = 69 THEN d_node END AS target
    FROM ends WHERE request_datetime < TIMESTAMP '2024-01-31' AND request_datetime >= TIMESTAMP '2024-01-01'""")
def snap_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir, ViewSpec("guarded", snap="city")).select(*_ENDS.split(", "))


def _gateway(spark: SparkSession, sf_dir: str, direction: str, mun: str, near: str, **options) -> DataFrame:
    points = fixtures.intersections(spark, sf_dir).withColumnRenamed("int_id", near)
    trips = fixtures.trips(spark, sf_dir).join(points, near)
    chosen = match_gateway(trips, fixtures.gateways(spark, sf_dir), direction, mun, "x", "y", "gate", **options)
    return chosen.select("mlsassignedptc", "ptctripid", "trippassengerid", "pickup_datetime", "gate")


@_register("gateway_dest", """SELECT mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, gate
    FROM ends LEFT JOIN gate_out USING (rid)""")
def gateway_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gateway(spark, sf_dir, "outbound", "dropoff_mun_id", "pickup_gc_intersection_id")


@_register("gateway_origin", """SELECT mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, gate
    FROM ends LEFT JOIN gate_in USING (rid)""")
def gateway_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gateway(spark, sf_dir, "inbound", "pickup_mun_id", "dropoff_gc_intersection_id")


@_register("gateway_dest_by_cells", """SELECT mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, gate
    FROM ends LEFT JOIN gate_out USING (rid)""")
def gateway_dest_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as if the gateways were too many for lists and broadcasts."""
    return _gateway(spark, sf_dir, "outbound", "dropoff_mun_id", "pickup_gc_intersection_id", short=False, broadcast_rows=0)


@_register("gateway_origin_by_cells", """SELECT mlsassignedptc, ptctripid, trippassengerid, pickup_datetime, gate
    FROM ends LEFT JOIN gate_in USING (rid)""")
def gateway_origin_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gateway(spark, sf_dir, "inbound", "pickup_mun_id", "dropoff_gc_intersection_id", short=False, broadcast_rows=0)


@_register("endpoint_resolved", f"SELECT {_ENDS} FROM external_trips WHERE service_date >= DATE '2024-01-01'")
def endpoint_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir, EXTERNAL).select(*_ENDS.split(", "))


@_register("pooled_keys", "SELECT service_date, mlsassignedptc, ptctripid FROM city_keys WHERE service_date >= DATE '2024-01-01'")
def query_pooled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pooled.pooled_keys(prep.slice_days(fixtures.trips(spark, sf_dir), "request_datetime", DAYS))


@_register("trip_stops", """SELECT service_date, ptctripid, trippassengerid, kind, ts, node, mun_id, int_id, has_point
    FROM city_stops WHERE service_date >= DATE '2024-01-01'""")
def query_trip_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _placed(spark, sf_dir, CITY)
    shared = placed.join(pooled.pooled_keys(placed), ["service_date", "mlsassignedptc", "ptctripid"], "left_semi")
    return pooled.trip_stops(shared.filter(pooled.has_valid_times())).select(
        "service_date", "ptctripid", "trippassengerid", "kind", "ts", "node", "mun_id", "int_id", "has_point")


_VIEWS = {"city": CITY, "city_as_written": CITY_AS_WRITTEN, "city_sentinel": CITY_SENTINEL,
          "external": EXTERNAL, "all": ALL_IMPUTED}


def _flags(spec: ViewSpec) -> str:
    return (", pooled" if spec.emit_pooled else "") + (", ext_trip" if spec.emit_ext_trip else "")


def _register_view(key: str, spec: ViewSpec) -> None:
    for query, build, table in ((f"pooled_segments_{key}", prep.resequence_stops, "segments"),
                                (f"unpooled_trips_{key}", prep.unpooled_trips, "unpooled"),
                                (f"prepared_{key}", prep.prepare, "prepared")):
        oracle = (f"SELECT {PREPARED}{_flags(spec)} FROM {spec.name}_{table} "
                  "WHERE service_date >= DATE '2024-01-01' AND service_date < DATE '2024-01-31'")

        def run(spark: SparkSession, sf_dir: str, build=build) -> DataFrame:
            return build(fixtures.trip_inputs(spark, sf_dir), spec, DAYS)

        _register(query, oracle)(run)


for _key, _spec in _VIEWS.items():
    _register_view(_key, _spec)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.prepare(fixtures.trip_inputs(spark, sf_dir), ALL_IMPUTED, DAYS)


def _routing(spark: SparkSession, sf_dir: str, network: TimedNetwork | None = None) -> routing.Routing:
    return routing.route_days(_prepared(spark, sf_dir), fixtures.vertex_map(spark, sf_dir),
                              network or fixtures.network(spark, sf_dir), DAYS)


@_register("bins", """SELECT b.service_date, b.bin_start, count(p.ptctripid) AS n_prepared FROM bins b
    LEFT JOIN binned p ON p.bin_start = b.bin_start AND p.service_date = b.service_date GROUP BY ALL""")
def query_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = routing.with_bins(_prepared(spark, sf_dir), DAYS).select("service_date", "bin_start", "ptctripid")
    return (bins_of(spark, DAYS).join(binned, ["service_date", "bin_start"], "left")
            .groupBy("service_date", "bin_start").agg(F.count("ptctripid").alias("n_prepared")))


@_register("vertex_map", "SELECT vertex_id, node_id FROM vertices")
def query_vertex_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.distinct_vertices(fixtures.vertex_map(spark, sf_dir))


@_register("od_batches", """SELECT b.service_date, b.bin_start, dense_rank() OVER (PARTITION BY b.service_date, b.bin_start
    ORDER BY ptctripid NULLS LAST) // 250 AS batch, b.ptctripid, s.vertex_id AS source, t.vertex_id AS target FROM binned b
    JOIN vertices s ON s.node_id = b.source JOIN vertices t ON t.node_id = b.target WHERE b.bin_start IS NOT NULL""")
def query_od_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.od_batches(_prepared(spark, sf_dir), fixtures.vertex_map(spark, sf_dir), DAYS)


ARRAY_PAIRS = 3


@_register("od_batch_arrays", f"""SELECT service_date, bin_start, batch, part, count(*) AS n_pairs,
    string_agg(CAST(source AS VARCHAR), ',' ORDER BY place) AS sources, string_agg(CAST(target AS VARCHAR), ',' ORDER BY place) AS targets
    FROM (SELECT *, (place - 1) // {ARRAY_PAIRS} AS part FROM (
      SELECT *, row_number() OVER (PARTITION BY service_date, bin_start, batch ORDER BY ptctripid NULLS LAST, source, target) AS place
      FROM (SELECT b.service_date, b.bin_start, dense_rank() OVER (PARTITION BY b.service_date, b.bin_start
        ORDER BY ptctripid NULLS LAST) // 250 AS batch, b.ptctripid, s.vertex_id AS source, t.vertex_id AS target FROM binned b
        JOIN vertices s ON s.node_id = b.source JOIN vertices t ON t.node_id = b.target WHERE b.bin_start IS NOT NULL)))
    GROUP BY service_date, bin_start, batch, part""")
def od_batch_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrays of all batches, short ones, so that batches have several; spelled out as text."""
    arrays = routing.batch_arrays(query_od_batches(spark, sf_dir), ARRAY_PAIRS)
    return arrays.select("service_date", "bin_start", "batch", "part", F.size("sources").cast("long").alias("n_pairs"),
                         *[F.array_join(F.col(name).cast("array<string>"), ",").alias(name) for name in ("sources", "targets")])


@_register("trips_with_ends", """SELECT service_date, bin_start, mlsassignedptc, ptctripid, trippassengerid, source, target
    FROM od_trips""")
def query_trips_with_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.trips_with_ends(_prepared(spark, sf_dir), fixtures.vertex_map(spark, sf_dir),
                                   fixtures.network(spark, sf_dir), DAYS).drop("profile")


@_register("od_pairs", "SELECT profile, source, target FROM od_pairs")
def query_od_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od_pairs(routing.trips_with_ends(_prepared(spark, sf_dir), fixtures.vertex_map(spark, sf_dir),
                                            fixtures.network(spark, sf_dir), DAYS))


@_register("network_for_bins", f"""SELECT bin_start, count(*) AS n_edges, CAST(sum(cost) AS BIGINT) AS total_cost,
    CAST(sum(cost * (source + 2 * target)) AS BIGINT) AS weighted_cost FROM (
    SELECT bin_start, id, source, target, {fixtures.COST} AS cost FROM edges,
      (SELECT bin_start, (hour(bin_start) * 60 + minute(bin_start)) // 5 AS profile FROM bins)) GROUP BY bin_start""")
def network_for_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    costed = fixtures.network(spark, sf_dir).for_days(DAYS)
    return costed.groupBy("bin_start").agg(
        F.count("*").alias("n_edges"), F.sum("cost").alias("total_cost"),
        F.sum(F.col("cost") * (F.col("source") + 2 * F.col("target"))).alias("weighted_cost"))


@_register("shortest_dist", "SELECT profile, source, target, dist, hops FROM found")
def shortest_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir).result.found


@_register("path_rows", "SELECT profile, start_vid, end_vid, path_seq, node, edge, cost, agg_cost FROM path_rows")
def query_path_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir).paths()


@_register("routed_trips", "SELECT * FROM routed")
def routed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir).routed()


@_register("shortest_dist_streets", "SELECT profile, source, target, dist, hops FROM found_streets")
def shortest_dist_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir, fixtures.streets(spark, sf_dir)).result.found


@_register("path_rows_streets", "SELECT profile, start_vid, end_vid, path_seq, node, edge, cost, agg_cost FROM path_rows_streets")
def path_rows_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir, fixtures.streets(spark, sf_dir)).paths()


@_register("path_rows_by_rounds", "SELECT profile, start_vid, end_vid, path_seq, node, edge, cost, agg_cost FROM path_rows_streets")
def path_rows_by_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same paths as if no profile fitted a task: contraction, then rounds of joins."""
    network = fixtures.streets(spark, sf_dir)
    trips = routing.trips_with_ends(_prepared(spark, sf_dir), fixtures.vertex_map(spark, sf_dir), network, DAYS)
    return path_rows(search(od_pairs(trips), network, task_edges=0))


@_register("shortest_dist_snapshots", "SELECT profile, source, target, dist, hops FROM found_snapshots")
def shortest_dist_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir, fixtures.snapshots(spark, sf_dir, DAYS)).result.found


@_register("routed_trips_snapshots", "SELECT * FROM routed_snapshots")
def routed_trips_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir, fixtures.snapshots(spark, sf_dir, DAYS)).routed()


@_register("bin_failures", f"""SELECT DISTINCT service_date, bin_start, 'ValueError: an edge costs no finite number' AS error FROM od_trips
    WHERE source <> target AND ((hour(bin_start) * 60 + minute(bin_start)) // 5) % {fixtures.BROKEN_EVERY} = 7""")
def bin_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir, fixtures.broken_snapshots(spark, sf_dir, DAYS)).failures()


def _journaled(spark: SparkSession, sf_dir: str) -> tuple[BinRun, DataFrame, StructType]:
    """Two runs on the record: with bins that fail, and again with their network mended."""
    run = BinRun(DAYS, shared_folder(spark, "routed-bins"), shared_folder(spark, "journal"))
    prepared, vertices = checkpointed(_prepared(spark, sf_dir)), fixtures.vertex_map(spark, sf_dir)
    run_bins(spark, run, prepared, vertices, fixtures.broken_snapshots(spark, sf_dir, DAYS))
    mended = fixtures.snapshots(spark, sf_dir, DAYS)
    mended = replace(mended, edges=mended.edges.withColumn("cost", F.col("cost").cast("double")))
    again = run_bins(spark, run, prepared, vertices, mended)
    return run, again, routing.route_days(prepared.limit(0), vertices, mended, DAYS).routed().schema


@_register("journal_of_a_rerun", f"""SELECT service_date, bin_start, 'done' AS state FROM od_trips
    WHERE source <> target AND ((hour(bin_start) * 60 + minute(bin_start)) // 5) % {fixtures.BROKEN_EVERY} = 7 GROUP BY ALL""")
def journal_of_a_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rerun tries the bins that failed and no others."""
    return _journaled(spark, sf_dir)[1].select("service_date", "bin_start", "state")


@_register("routed_trips_rerun", """SELECT service_date, bin_start, mlsassignedptc, ptctripid, trippassengerid, start_vid, end_vid, path_seq,
    node, edge, CAST(cost AS DOUBLE) AS cost, CAST(agg_cost AS DOUBLE) AS agg_cost FROM routed_snapshots""")
def routed_trips_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both runs stored, read back from the table."""
    run, _, schema = _journaled(spark, sf_dir)
    return read_routed_bins(spark, run, schema)


_IDS = ", ".join(f"lpad(CAST({name} AS VARCHAR), {fixtures.ID_CHARS}, '0') AS {name}" for name in ("ptctripid", "trippassengerid"))


def _inputs_from_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    folder = shared_folder(spark, "inputs")
    fixtures.write_files(spark, sf_dir, folder, DAYS)
    tables.write_prepared(prep.prepare(fixtures.read_inputs(spark, folder), ALL_IMPUTED, DAYS), f"{folder}/prepared")
    return folder, tables.read_prepared(spark, f"{folder}/prepared")


@_register("prepared_from_files", f"""SELECT service_date, mlsassignedptc, {_IDS}, pickup_datetime, pickup_gc_intersection_id, source,
    dropoff_datetime, dropoff_gc_intersection_id, target, pooled, ext_trip FROM all_imputed_prepared
    WHERE service_date >= DATE '2024-01-01' AND service_date < DATE '2024-01-31'""")
def prepared_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables written in their declared schemas, read, split by constraints, prepared, stored and read back."""
    return _inputs_from_files(spark, sf_dir)[1].select(*PREPARED.split(", "), "pooled", "ext_trip")


@_register("lookup_trips", f"""SELECT service_date, bin_start, mlsassignedptc, {_IDS}, start_vid, end_vid, path_seq, node, edge,
    CAST(cost AS DOUBLE) AS cost, CAST(agg_cost AS DOUBLE) AS agg_cost FROM routed_snapshots
    WHERE ptctripid IN (SELECT ptctripid FROM all_imputed_prepared WHERE pooled AND service_date >= DATE '2024-01-01'
      AND service_date < DATE '2024-01-31')""")
def lookup_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routed rows of all pooled trips, looked up in the table that a job over the files wrote."""
    folder, prepared = _inputs_from_files(spark, sf_dir)
    network = TimedNetwork.from_table(split(tables.read_network(spark, f"{folder}/network"), constraints("network"),
                                            f"{folder}/split-network").good)
    records = routing.run_jobs(spark, [routing.RouteJob(DAYS, f"{folder}/prepared", f"{folder}/routed")],
                               tables.read_vertex_map(spark, f"{folder}/vertex_map"), network)
    if records[0].error is not None:
        raise RuntimeError(records[0].error)
    return lookup(tables.read_routed(spark, f"{folder}/routed"), prepared.filter("pooled").select("ptctripid"))


@_register("quarantine_counts", """SELECT 'point' AS fault, count(*) AS rows FROM intersections WHERE x IS NULL
    UNION ALL SELECT 'far', count(*) FILTER (x > 100000 OR y > 100000) FROM intersections HAVING count(*) FILTER (x > 100000 OR y > 100000) > 0""")
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersections that a stricter reader would set aside: those without a point, and those a hundred kilometres away."""
    rules = {"point": F.col("x").isNotNull() & F.col("y").isNotNull(),
             "far": F.coalesce((F.col("x") <= 100_000) & (F.col("y") <= 100_000), F.lit(True))}
    return split(fixtures.intersections(spark, sf_dir), rules, shared_folder(spark, "quarantine")).counts()


@_register("bin_audit", """SELECT service_date, bin_start, CAST(sum(prepared) AS BIGINT) AS prepared,
    CAST(sum(routed) AS BIGINT) AS routed, CAST(sum(unreachable) AS BIGINT) AS unreachable,
    CAST(sum(same_vertex) AS BIGINT) AS same_vertex, CAST(sum(no_vertex) AS BIGINT) AS no_vertex,
    CAST(sum(no_node) AS BIGINT) AS no_node, CAST(sum(outside_bins) AS BIGINT) AS outside_bins FROM (
    SELECT service_date, bin_start, 1 AS prepared, outcome = 'routed' AS routed, outcome = 'unreachable' AS unreachable,
      outcome = 'same_vertex' AS same_vertex, outcome = 'no_vertex' AS no_vertex, outcome = 'no_node' AS no_node,
      outcome = 'outside_bins' AS outside_bins FROM judged
    UNION ALL SELECT service_date, bin_start, 0, FALSE, FALSE, FALSE, FALSE, FALSE, FALSE FROM bins) GROUP BY ALL""")
def bin_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir).audit()


@_register("unrouted_pairs", """SELECT service_date, bin_start, mlsassignedptc, ptctripid, trippassengerid, source, target,
    outcome FROM judged WHERE outcome <> 'routed'""")
def unrouted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir).unrouted()
