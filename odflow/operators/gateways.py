"""Gateway nodes that stand for the out-of-town end of a trip.

A gateway is chosen by the *other* end of the trip: among the gateways of the out-of-town
municipality in the right direction, the nearest one of the class that fits the distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.functions.geo import squared_distance, within
from odflow.operators.dealt import SHARE_ROWS, dealt_join
from odflow.operators.snap import snap_nearest
from odflow.runtime import BROADCAST_ROWS, checkpointed

# Within this many metres a trip uses the 'shorter_points', beyond it the 'longer_points'.
NEAR_METRES = 3000
SHORTER, LONGER = "shorter_points", "longer_points"
# Gateway tables are a few dozen rows; beyond this a municipality's list is not kept in one array.
LIST_ROWS = 10_000


def _open_for(gateways: DataFrame, direction: str) -> DataFrame:
    """Gateways usable in ``direction`` ('inbound' or 'outbound'); no bound means both."""
    return gateways.filter(F.col("bound").isNull() | (F.col("bound") == direction))


def _eligible(d2: Column, short_long: Column) -> Column:
    near = within(d2, NEAR_METRES)
    return (near & (short_long == SHORTER)) | (~near & (short_long == LONGER))


def is_short(gateways: DataFrame) -> bool:
    """Whether a gateway table is small enough to be kept in lists."""
    return gateways.limit(LIST_ROWS + 1).count() <= LIST_ROWS


def match_gateway(trips: DataFrame, gateways: DataFrame, direction: str,
                  mun: str, x: str, y: str, out: str, short: bool | None = None,
                  broadcast_rows: int = BROADCAST_ROWS, share_rows: int = SHARE_ROWS) -> DataFrame:
    """Add column ``out``: the gateway node for municipality ``mun`` seen from (x, y), or NULL.

    The usual gateway table is tiny: each municipality's gateways are joined as one list and
    the choice is a column expression, so trips are not shuffled. A table too large for
    that is matched once per distinct (municipality, place) instead, by cells and not by pairs. ``short`` passes on a
    size check that was already made.
    """
    usable = _open_for(gateways, direction)
    if not (is_short(gateways) if short is None else short):
        return _match_by_place(trips, usable, mun, x, y, out, broadcast_rows, share_rows)
    lists = usable.groupBy(F.col("mun_id").alias("_mun")).agg(
        F.collect_list(F.struct("node_id", "x", "y", "short_long")).alias("_gates"))

    def d2(gate: Column) -> Column:
        return squared_distance(F.col(x), F.col(y), gate["x"], gate["y"])

    fitting = F.filter("_gates", lambda gate: _eligible(d2(gate), gate["short_long"]))
    ranked = F.transform(fitting, lambda gate: F.struct(d2(gate).alias("d2"), gate["node_id"].alias("node_id")))
    return (trips.join(F.broadcast(lists), F.col(mun) == F.col("_mun"), "left")
            .withColumn(out, F.array_min(ranked)["node_id"]).drop("_mun", "_gates"))


def _match_by_place(trips: DataFrame, usable: DataFrame, mun: str, x: str, y: str, out: str,
                    broadcast_rows: int, share_rows: int) -> DataFrame:
    """Of the near ones the nearest, or else of the far ones: two searches for nearest places within the municipality."""
    asked = checkpointed(trips.select(F.col(mun).alias("mun_id"), F.col(x).alias("x"), F.col(y).alias("y")).dropna().distinct())

    def nearest(kind: str, beyond: float | None = None) -> DataFrame:
        return snap_nearest(asked, usable.filter(F.col("short_long") == kind), broadcast_rows, "mun_id", beyond, share_rows)

    found = nearest(SHORTER).filter(within(F.col("d2"), NEAR_METRES)).unionByName(nearest(LONGER, NEAR_METRES))
    chosen = (found.groupBy(F.col("mun_id").alias("_mun"), F.col("x").alias("_x"), F.col("y").alias("_y"))
              .agg(F.min(F.struct("d2", "node_id"))["node_id"].alias(out)))
    # Very many trips may end at one place.
    return dealt_join(trips, chosen, [(mun, "_mun"), (x, "_x"), (y, "_y")], "left", share_rows).drop("_mun", "_x", "_y")
