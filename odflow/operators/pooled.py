"""Pooled trips: find shared trips and turn their stops into consecutive segments.

All the steps work within one (service_date, ptctripid), so the trips are shuffled once, on
that key, and every window reuses the partitioning. A trip id so frequent that one task
could not hold it takes ``lead_in_chunks`` instead of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.operators.ranges import range_chunks

# The providers that pool passengers, and the time that stands for "not recorded".
POOLING_PROVIDERS = (28608558, 1608409)
NO_TIME = "1900-01-01 00:00:00"

TRIP_KEY = ["service_date", "ptctripid"]
# Stops go by time; the rest makes equal times come out the same on every run.
STOP_ORDER = ["ts", "trippassengerid", "kind", "mlsassignedptc", "int_id", "node"]
STOP_VALUES = ["ts", "node", "mun_id", "int_id", "has_point"]


def has_valid_times() -> Column:
    limit = F.lit(NO_TIME).cast("timestamp_ntz")
    return (F.col("dropoff_datetime") > limit) & (F.col("pickup_datetime") > limit)


def _counted_passenger(valid_time: str) -> Column:
    counted = F.col("provider_id").isin(*POOLING_PROVIDERS)
    if valid_time == "having":
        counted = counted & has_valid_times()
    return F.when(counted, F.col("trippassengerid"))


def pooled_keys(trips: DataFrame, valid_time: str = "row") -> DataFrame:
    """(service_date, mlsassignedptc, ptctripid) shared by more than one passenger.

    More than one distinct value is the same as a smallest unlike the largest, which needs
    neither a set per key nor a second shuffle.
    """
    passenger = _counted_passenger(valid_time)
    return (trips.groupBy("service_date", "mlsassignedptc", "ptctripid")
            .agg(F.min(passenger).alias("first_passenger"), F.max(passenger).alias("last_passenger"))
            .filter("first_passenger <> last_passenger")
            .select("service_date", "mlsassignedptc", "ptctripid"))


def with_pool_flag(trips: DataFrame, valid_time: str) -> DataFrame:
    """The same test as ``pooled_keys``, as a flag on each trip."""
    company_trip = Window.partitionBy(*TRIP_KEY, "mlsassignedptc")
    passenger = _counted_passenger(valid_time)
    shared = F.min(passenger).over(company_trip) != F.max(passenger).over(company_trip)
    named = F.col("mlsassignedptc").isNotNull() & F.col("ptctripid").isNotNull()
    return trips.withColumn("is_pooled", F.coalesce(shared & named, F.lit(False)))


def _pickup() -> list[Column]:
    return [F.col("pickup_datetime").alias("ts"), F.col("source").alias("node"), F.col("pickup_mun_id").alias("mun_id"),
            F.col("pickup_gc_intersection_id").alias("int_id"), F.col("has_orig").alias("has_point")]


def _dropoff() -> list[Column]:
    return [F.col("dropoff_datetime").alias("ts"), F.col("target").alias("node"), F.col("dropoff_mun_id").alias("mun_id"),
            F.col("dropoff_gc_intersection_id").alias("int_id"), F.col("has_dest").alias("has_point")]


def _row(kind: int | None, values: list[Column]) -> Column:
    return F.struct(F.lit(kind).cast("int").alias("kind"), *values)


def trip_stops(trips: DataFrame, where: Column | None = None) -> DataFrame:
    """Two rows per trip, its pickup (kind 0) and its dropoff (kind 1).

    With ``where`` every trip keeps a row of its own as well (kind NULL, placed at its
    pickup), and only the trips that satisfy it get stop rows.
    """
    stops = [_row(0, _pickup()), _row(1, _dropoff())]
    if where is None:
        return trips.select("*", F.inline(F.array(*stops)))
    alone = _row(None, _pickup())
    return trips.select("*", F.inline(F.when(where, F.array(alone, *stops)).otherwise(F.array(alone))))


def whole_trips(trips: DataFrame) -> DataFrame:
    """Trips as rows of kind NULL that run from their own pickup to their own dropoff."""
    return trips.select("*", F.inline(F.array(_row(None, _pickup()))), F.struct(*_dropoff()).alias("next"))


def _ascending() -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in STOP_ORDER]


def with_next_stop(rows: DataFrame) -> DataFrame:
    """Add ``next``: for a stop the following stop of the same trip id, NULL on the last one;
    for a trip's own row its dropoff.

    The company is not part of the key: companies that share a trip id are interleaved.
    """
    is_stop = F.col("kind").isNotNull()
    route = Window.partitionBy(*TRIP_KEY, is_stop).orderBy(*_ascending())
    following = F.lead(F.struct(*STOP_VALUES)).over(route)
    return rows.withColumn("next", F.when(is_stop, following).otherwise(F.struct(*_dropoff())))


def lead_in_chunks(stops: DataFrame) -> DataFrame:
    """``with_next_stop`` for trip ids of any size.

    The stops are range-partitioned by trip and stop order, so that a large trip spreads over
    many tasks. Each chunk numbers its own stops; its last one takes the first stop of the
    trip's next chunk, of which there are only as many as there are partitions.
    """
    order = [*TRIP_KEY, *STOP_ORDER]
    chunks = range_chunks(stops, order)
    in_chunk = Window.partitionBy(*TRIP_KEY, "chunk").orderBy(*_ascending(), "tie")
    local = chunks.withColumns({
        "next": F.lead(F.struct(*STOP_VALUES)).over(in_chunk),
        "is_last": F.lead("tie").over(in_chunk).isNull(),
        "is_first": F.lag("tie").over(in_chunk).isNull(),
    })
    heads = (local.filter("is_first")
             .select(*TRIP_KEY, "chunk", F.struct(*STOP_VALUES).alias("head"))
             .withColumn("head_of", F.lag("chunk").over(Window.partitionBy(*TRIP_KEY).orderBy("chunk")))
             .select(*[F.col(name).alias(f"h_{name}") for name in TRIP_KEY], "head_of", "head"))
    follows = (F.col("is_last") & (F.col("chunk") == F.col("head_of"))
               & F.col("service_date").eqNullSafe(F.col("h_service_date"))
               & F.col("ptctripid").eqNullSafe(F.col("h_ptctripid")))
    return (local.join(heads, follows, "left")
            .withColumn("next", F.coalesce("next", "head"))
            .drop("h_service_date", "h_ptctripid", "head_of", "head", "chunk", "tie", "is_first", "is_last"))
