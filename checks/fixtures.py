"""The input tables of the engine, derived from the driver's tables.

Each derived table is one list of expressions that Spark and DuckDB read alike, so the two
sides of a check start from the same rows. Everything is whole-number arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odflow.functions.bins import DayRange, bins_of, step_of_day
from odflow.plans.prepare import TripInputs
from odflow import schemas
from odflow.sources import tables
from odflow.sources.network import TimedNetwork, bins_dealt, every_edge
from odflow.sources.quarantine import constraints, split

# The service days the events cover; a routing job names its days.
FIRST_DAY, AFTER_LAST_DAY = (2024, 1, 1), (2024, 1, 31)

# {ntz} is the word for a timestamp literal without time zone.
TRIPS = {
    "mlsassignedptc": "concat('ops', CAST(user_id % 2 AS STRING))",
    "ptctripid": "CASE WHEN event_id % 12 >= 8 THEN event_id ELSE event_id - event_id % 4 END",
    "trippassengerid": "CASE WHEN event_id % 8 = 7 THEN event_id - 1 ELSE event_id END",
    "provider_id": "CASE WHEN user_id % 10 = 0 OR event_id % 12 >= 8 THEN 1 "
                   "WHEN event_id % 12 < 4 THEN 28608558 ELSE 1608409 END",
    "request_datetime": "ts - INTERVAL '4' MINUTE",
    "pickup_datetime": "CASE WHEN event_type = 'error' AND value > 90 THEN {ntz} '1900-01-01 00:00:00' ELSE ts END",
    "dropoff_datetime": "CASE WHEN event_type = 'error' AND value < 6 THEN {ntz} '1900-01-01 00:00:00' "
                        "ELSE ts + (event_id % 4) * INTERVAL '5' MINUTE + INTERVAL '4' MINUTE END",
    "pickup_mun_id": "CAST(CASE WHEN user_id % 8 = 0 THEN 61 WHEN user_id % 8 = 1 THEN 38 WHEN user_id % 8 = 2 THEN 5 "
                     "WHEN user_id % 16 = 5 THEN NULL ELSE 69 END AS INT)",
    "dropoff_mun_id": "CAST(CASE WHEN (user_id + event_id) % 9 = 0 THEN 71 WHEN (user_id + event_id) % 9 = 1 THEN 8 "
                      "ELSE 69 END AS INT)",
    "pickup_gc_intersection_id": "CASE WHEN user_id % 8 <= 2 THEN 99999999 "
                                 "ELSE (user_id * 31 + event_id % 3) % n_part END",
    # Up to 36 intersections east or west and north or south of the pickup.
    "dropoff_gc_intersection_id":
        "CASE WHEN (user_id + event_id) % 9 <= 1 THEN 99999999 ELSE "
        "(user_id * 31 + event_id % 3 + (event_id * 7) % 73 - 36 + ((event_id * 11) % 73 - 36) * wide + 36 * n_part) "
        "% n_part END",
}

# Intersections lie on a square as wide as the node grid; every 97th has no point.
INTERSECTIONS = {
    "int_id": "p_partkey",
    "x": "CASE WHEN p_partkey % 97 = 96 THEN NULL ELSE (p_partkey % wide) * (span - span % wide) / wide "
         "+ (p_partkey * 7919) % 97 END",
    "y": "CASE WHEN p_partkey % 97 = 96 THEN NULL ELSE ((p_partkey - p_partkey % wide) / wide) "
         "* (span - span % wide) / wide + (p_partkey * 6101) % 97 END",
}

# One node every 500 m on a square grid of all suppliers.
NODES = {
    "node_id": "s_suppkey + 500000",
    "link_id": "s_suppkey",
    "intrsect": "CASE WHEN s_suppkey % 11 = 0 THEN 'N' ELSE 'Y' END",
    "x": "(s_suppkey % wide) * 500",
    "y": "CAST((s_suppkey - s_suppkey % wide) / wide AS BIGINT) * 500",
}

LINKS = {"link_id": "s_suppkey"}
LINKS_WHERE = "s_suppkey % 13 <> 0"

GATEWAYS = {
    "node_id": "v + 500000",
    "mun_id": "CAST(CASE n % 6 WHEN 0 THEN 61 WHEN 1 THEN 38 WHEN 2 THEN 71 WHEN 3 THEN 57 WHEN 4 THEN 8 ELSE 41 END AS INT)",
    "bound": "CASE WHEN n BETWEEN 6 AND 11 THEN 'inbound' WHEN n BETWEEN 12 AND 17 OR n > 23 THEN 'outbound' END",
    "short_long": "CASE WHEN n < 6 OR n BETWEEN 12 AND 17 OR n > 23 THEN 'shorter_points' ELSE 'longer_points' END",
    "x": "(v % wide) * 500",
    "y": "CAST((v - v % wide) / wide AS BIGINT) * 500",
}

# Most nodes are one vertex; every 23rd has none, every 31st a second one, every other is listed twice.
VERTEX_COPIES = (
    ("s_suppkey", "s_suppkey % 23 <> 0"),
    ("s_suppkey", "s_suppkey % 2 = 0 AND s_suppkey % 23 <> 0"),
    ("s_suppkey + 1", "s_suppkey % 31 = 3 AND s_suppkey + 1 < n_supp"),
)

# k: step to the other end, its length, and where the edge exists.
STEPS = (
    ("1", 1, "s_suppkey % wide < wide - 1"),
    ("-1", 1, "s_suppkey % wide > 0"),
    ("wide", 1, "TRUE"),
    ("-wide", 1, "TRUE"),
    ("5", 3, "s_suppkey % 5 = 0 AND s_suppkey % wide < wide - 5"),
    ("-5", 3, "s_suppkey % 5 = 0 AND s_suppkey % wide >= 5"),
    ("5 * wide", 3, "s_suppkey % 5 = 0"),
    ("-5 * wide", 3, "s_suppkey % 5 = 0"),
)
# Nothing leads into every 29th vertex.
EDGE_WHERE = "target >= 0 AND target < n_supp AND target % 29 <> 7"
EDGES = {"id": "s_suppkey * 8 + k", "source": "s_suppkey", "target": "target",
         "base": "1000 * length + ((s_suppkey * 8 + k) * 7919) % 997"}
COST = "base + (id * 31 + profile * 17) % 500"
# Streets alone: no edge is longer than one step.
STREETS_WHERE = "id % 8 < 4"
# A snapshot per bin: costs of a step of the day differ from day to day.
BROKEN_EVERY = 40
SNAPSHOT_COST = "base + (id * 31 + ({step}) * 17 + day({bin}) * 13) % 500"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as_exprs(columns: dict[str, str]) -> list[str]:
    return [f"{text.format(ntz='TIMESTAMP_NTZ')} AS {name}" for name, text in columns.items()]


def _sized(df: DataFrame, counted: DataFrame, name: str) -> DataFrame:
    """``df`` with the row count of ``counted`` and the width of its square."""
    return (df.withColumn(name, counted.agg(F.count("*")).scalar())
            .withColumn("wide", F.expr(f"CAST(ceil(sqrt({name})) AS BIGINT)")))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _sized(_table(spark, sf_dir, "events"), _table(spark, sf_dir, "part"), "n_part")
    return events.selectExpr(*_as_exprs(TRIPS))


def intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = _table(spark, sf_dir, "part"), _table(spark, sf_dir, "supplier")
    span = _sized(part, supplier, "n_supp").withColumn("span", F.expr("wide * 500"))
    listed = _sized(span, part, "n_part").selectExpr(*_as_exprs(INTERSECTIONS))
    outside = spark.range(1).selectExpr("99999999L AS int_id", "CAST(NULL AS DOUBLE) AS x", "CAST(NULL AS DOUBLE) AS y")
    both = listed.unionByName(outside)
    return both.select("int_id", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    return _sized(supplier.select("s_suppkey"), supplier, "n_supp")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suppliers(spark, sf_dir).selectExpr(*_as_exprs(NODES))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").filter(LINKS_WHERE).selectExpr(*_as_exprs(LINKS))


def gateways(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS n")
    placed = _sized(nation, _table(spark, sf_dir, "supplier"), "n_supp").withColumn("v", F.expr("(n * 53) % n_supp"))
    return placed.selectExpr(*_as_exprs(GATEWAYS))


def vertex_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _suppliers(spark, sf_dir)
    parts = [base.filter(where).selectExpr("s_suppkey + 500000 AS node_id", f"{vertex} AS vertex_id")
             for vertex, where in VERTEX_COPIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [f"CASE WHEN {where} THEN struct({k} AS k, {length} AS length, s_suppkey + {step} AS target) END"
             for k, (step, length, where) in enumerate(STEPS)]
    stepped = _suppliers(spark, sf_dir).selectExpr("s_suppkey", "n_supp", f"inline(array({', '.join(steps)}))")
    return stepped.filter(EDGE_WHERE).selectExpr(*_as_exprs(EDGES))


def _cost(profile: Column, edge: Callable[[str], Column]) -> Column:
    """COST as a column expression."""
    return edge("base") + (edge("id") * 31 + profile * 17) % 500


def network(spark: SparkSession, sf_dir: str) -> TimedNetwork:
    """Costs depend on the five-minute step of the day, the same on every day."""
    return TimedNetwork(edges(spark, sf_dir), profile=step_of_day, cost=_cost)


def streets(spark: SparkSession, sf_dir: str) -> TimedNetwork:
    """The network without its long edges: paths have many."""
    return TimedNetwork(edges(spark, sf_dir).filter(STREETS_WHERE), profile=step_of_day, cost=_cost)


def snapshots(spark: SparkSession, sf_dir: str, days: list[DayRange]) -> TimedNetwork:
    """The network as a table with the costed edges of every bin of the days."""
    # The step and the day are worked out once per bin.
    bins = bins_of(spark, days).selectExpr("bin_start", "hour(bin_start) * 12 + minute(bin_start) div 5 AS step", "day(bin_start) AS month_day")
    listed = edges(spark, sf_dir)
    costed = every_edge(bins, "bin_start", listed)
    cost = SNAPSHOT_COST.format(step="step", bin="bin_start").replace("day(bin_start)", "month_day")
    return TimedNetwork.from_table(costed.selectExpr("bin_start", "id", "source", "target", f"{cost} AS cost"),
                                   by_bin=bins_dealt(listed))


def broken_snapshots(spark: SparkSession, sf_dir: str, days: list[DayRange]) -> TimedNetwork:
    """The snapshots with costs that are no numbers in some bins."""
    whole = snapshots(spark, sf_dir, days)
    step = step_of_day(F.col("profile"))
    cost = F.when((step % BROKEN_EVERY == 7) & (F.col("id") % 8 == 2), float("nan")).otherwise(F.col("cost").cast("double"))
    return replace(whole, edges=whole.edges.withColumn("cost", cost))


def trip_inputs(spark: SparkSession, sf_dir: str) -> TripInputs:
    return TripInputs(trips(spark, sf_dir), intersections(spark, sf_dir), nodes(spark, sf_dir),
                      links(spark, sf_dir), gateways(spark, sf_dir))


# The same tables as DuckDB common table expressions.

def _select(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(f"{text.format(ntz='TIMESTAMP')} AS {name}" for name, text in columns.items())
    return f"SELECT {listed} FROM {source}"


def _sql_sized(columns: str, table: str, counted: str, name: str) -> str:
    return (f"(SELECT {columns}, n.{name}, CAST(ceil(sqrt(n.{name})) AS BIGINT) AS wide FROM {table}, "
            f"(SELECT count(*) AS {name} FROM {counted}) n)")


_SUPPLIERS = _sql_sized("s_suppkey", "supplier", "supplier", "n_supp")

SQL = {
    "trips": _select(TRIPS, _sql_sized("events.*", "events", "part", "n_part")),
    "intersections": (
        "SELECT int_id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM ("
        + _select(INTERSECTIONS, "(SELECT p.*, 500 * CAST(ceil(sqrt(s.n_supp)) AS BIGINT) AS span FROM "
                  + _sql_sized("p_partkey", "part", "part", "n_part")
                  + " p, (SELECT count(*) AS n_supp FROM supplier) s)")
        + " UNION ALL SELECT 99999999, NULL, NULL)"),
    "nodes": _select(NODES, _SUPPLIERS),
    "links": _select(LINKS, "supplier") + f" WHERE {LINKS_WHERE}",
    "gateways": _select(GATEWAYS, "(SELECT n, wide, (n * 53) % n_supp AS v FROM "
                        + _sql_sized("CAST(n_nationkey AS BIGINT) AS n", "nation", "supplier", "n_supp") + ")"),
    "vertex_map": " UNION ALL ".join(f"SELECT s_suppkey + 500000 AS node_id, {vertex} AS vertex_id FROM {_SUPPLIERS} "
                                     f"WHERE {where}" for vertex, where in VERTEX_COPIES),
    "edges": _select(EDGES, "(" + " UNION ALL ".join(
        f"SELECT s_suppkey, n_supp, {k} AS k, {length} AS length, s_suppkey + {step} AS target FROM {_SUPPLIERS} "
        f"WHERE {where}" for k, (step, length, where) in enumerate(STEPS)) + ")") + f" WHERE {EDGE_WHERE}",
}


# As files in the declared schemas, read through the library's readers; ids of trips are text there, padded to keep their order.
ID_CHARS = 12


def _as_declared(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[(F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
                       for field in schema])


def write_files(spark: SparkSession, sf_dir: str, folder: str, days: list[DayRange]) -> None:
    """All input tables as Parquet below ``folder``."""
    padded = {name: F.lpad(F.col(name).cast("string"), ID_CHARS, "0") for name in ("ptctripid", "trippassengerid")}
    precise = {name: F.col(plain) for name, plain in tables.PRECISE_TIMES.items()}
    found = {
        "trips": (trips(spark, sf_dir).withColumns({**padded, **precise}), schemas.IMPUTED_TRIPS),
        "intersections": (intersections(spark, sf_dir), schemas.INTERSECTIONS),
        "nodes": (nodes(spark, sf_dir), schemas.NODES), "links": (links(spark, sf_dir), schemas.LINKS),
        "gateways": (gateways(spark, sf_dir), schemas.GATEWAYS), "vertex_map": (vertex_map(spark, sf_dir), schemas.VERTEX_MAP),
        "network": (snapshots(spark, sf_dir, days).edges.withColumnRenamed("profile", "bin_start"), schemas.NETWORK)}
    for name, (df, schema) in found.items():
        _as_declared(df, schema).write.parquet(f"{folder}/{name}")


def read_inputs(spark: SparkSession, folder: str) -> TripInputs:
    """The trip inputs from the files, without rows that break a constraint."""
    read = {"trips": tables.read_imputed_trips, "intersections": tables.read_intersections, "nodes": tables.read_nodes,
            "links": tables.read_links, "gateways": tables.read_gateways}
    return TripInputs(*[split(reader(spark, f"{folder}/{name}"), constraints(name), f"{folder}/split-{name}").good
                        for name, reader in read.items()])
