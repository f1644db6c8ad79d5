"""Exact nearest-node snap.

The candidate nodes are summarised by a hierarchy of square cells. Every point starts at
the cell that covers everything and goes down one level at a time, keeping only the cells
that can still hold its nearest node: those whose nearest corner is no farther than the
farthest corner of the best cell. That is exact wherever the nodes are dense or sparse, pairs
a point with a handful of cells, and needs neither a search radius nor a cross join.

The cells of a level are counted; those few enough are broadcast. Finer levels are shuffled by cell, and a cell with very
many points is dealt out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.geo import gap_to_range, reach_over_range, squared_distance
from odflow.operators.dealt import SHARE_ROWS, dealt_join
from odflow.runtime import BROADCAST_ROWS, checkpointed

# Cells per side shrink fourfold a level; no level is finer than this share of the extent.
FANOUT = 4
MAX_LEVELS = 12
# A leaf may hold this many places; below it, looking at each is cheaper than another level.
LEAF_PLACES = 16


def routable_nodes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Intersection nodes that touch a routable link, one row per place.

    Nodes at the same place are equally near to everything; the smallest id stands for them.
    """
    return (nodes.filter((F.col("intrsect") == "Y") & F.col("x").isNotNull() & F.col("y").isNotNull())
            .join(links.select("link_id"), "link_id", "left_semi")
            .groupBy("x", "y").agg(F.min("node_id").alias("node_id")))


def _cell(value: Column, origin: float, size: float) -> Column:
    return F.floor((value - F.lit(origin)) / F.lit(size))


def _levels(places: DataFrame, key: list[str], x0: float, y0: float, extent: float) -> list[tuple[float, int]]:
    """Cell sizes, and numbers of cells, from the second coarsest level down to the first whose cells are all small."""
    sizes = [extent / FANOUT ** level for level in range(1, MAX_LEVELS + 1)]
    fullest = (
        places.select(*key, "x", "y", F.posexplode(F.array(*[F.lit(size) for size in sizes])).alias("level", "size"))
        .groupBy("level", *key, F.floor((F.col("x") - x0) / F.col("size")).alias("cx"),
                 F.floor((F.col("y") - y0) / F.col("size")).alias("cy"))
        .count().groupBy("level").agg(F.max("count").alias("n"), F.count("*").alias("cells")).collect())
    cells = {row["level"]: row["cells"] for row in fullest}
    fit = [row["level"] for row in fullest if row["n"] <= LEAF_PLACES]
    used = min(fit) + 1 if fit else len(sizes)
    return [(sizes[level], cells[level]) for level in range(used)]


def snap_nearest(points: DataFrame, places: DataFrame, broadcast_rows: int = BROADCAST_ROWS, by: str | None = None,
                 beyond: float | None = None, share_rows: int = SHARE_ROWS) -> DataFrame:
    """Nearest place of every distinct (x, y) in ``points``: (x, y, node_id, d2).

    ``places`` is (x, y, node_id). Equal distances go to the smallest node_id. Points
    without coordinates have no nearest place and are left out. With ``by``, a column of both tables and of the
    result, only places of the point's own group count; with ``beyond``, only those farther than that. A point
    for which no place counts is left out.
    """
    key = [] if by is None else [by]
    points = points.select(*key, "x", "y").dropna().distinct()
    places = places.select(*key, "x", "y", "node_id").dropna(subset=[*key, "x", "y"])
    box = places.agg(F.min("x").alias("x0"), F.max("x").alias("x1"),
                     F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("n")).first()
    if box["n"] == 0:
        return points.limit(0).select(*key, "x", "y", F.lit(None).cast("long").alias("node_id"),
                                      F.lit(None).cast("double").alias("d2"))
    x0, y0 = box["x0"], box["y0"]
    # A little over the span, so that the largest coordinates fall inside the last cell.
    extent = math.nextafter(max(box["x1"] - x0, box["y1"] - y0, 1), math.inf) * 1.001
    at = [*key, "cx", "cy"]

    def meet(near: DataFrame, cells: DataFrame, n_cells: int) -> DataFrame:
        """Points with the rows of ``cells`` below the cell they are in."""
        if n_cells <= max(broadcast_rows, FANOUT * FANOUT):
            return near.join(F.broadcast(cells), at)
        near = checkpointed(near)
        named = cells.withColumnsRenamed({name: f"_{name}" for name in at})
        return dealt_join(near, named, [(name, f"_{name}") for name in at], share_rows=share_rows).drop(*[f"_{name}" for name in at])

    own = Window.partitionBy(*key, "px", "py")
    clear = None if beyond is None else beyond * beyond
    # Partitioned by point once; broadcast joins and the windows below keep it that way.
    near = (points.select(*key, F.col("x").alias("px"), F.col("y").alias("py")).repartition("px", "py")
            .withColumns({"cx": F.lit(0).cast("long"), "cy": F.lit(0).cast("long")}))
    coarser = extent
    for size, n_cells in _levels(places, key, x0, y0, extent):
        cells = (places.groupBy(*key, _cell(F.col("x"), x0, size).alias("nx"), _cell(F.col("y"), y0, size).alias("ny"))
                 .agg(F.min("x").alias("lx"), F.max("x").alias("hx"),
                      F.min("y").alias("ly"), F.max("y").alias("hy"),
                      F.min(_cell(F.col("x"), x0, coarser)).alias("cx"),
                      F.min(_cell(F.col("y"), y0, coarser)).alias("cy")))
        joined = meet(near, cells, n_cells)
        gx, gy = gap_to_range(F.col("px"), F.col("lx"), F.col("hx")), gap_to_range(F.col("py"), F.col("ly"), F.col("hy"))
        rx, ry = reach_over_range(F.col("px"), F.col("lx"), F.col("hx")), reach_over_range(F.col("py"), F.col("ly"), F.col("hy"))
        joined = joined.withColumns({"at_least": gx * gx + gy * gy, "at_most": rx * rx + ry * ry})
        counts = F.col("at_most")
        if clear is not None:
            # Only a cell that is beyond as a whole is sure to have a place that counts.
            joined = joined.filter(F.col("at_most") > clear)
            counts = F.when(F.col("at_least") > clear, F.col("at_most"))
        near = (joined.withColumn("surely", F.min(counts).over(own))
                .filter("surely IS NULL OR at_least <= surely")
                .select(*key, "px", "py", F.col("nx").alias("cx"), F.col("ny").alias("cy")))
        coarser = size
    leaves = places.select(*key, "node_id", F.col("x").alias("nx"), F.col("y").alias("ny"),
                           _cell(F.col("x"), x0, coarser).alias("cx"), _cell(F.col("y"), y0, coarser).alias("cy"))
    d2 = squared_distance(F.col("px"), F.col("py"), F.col("nx"), F.col("ny"))
    met = meet(near, leaves, box["n"]).withColumn("d2", d2)
    if clear is not None:
        met = met.filter(F.col("d2") > clear)
    best = met.groupBy(*key, "px", "py").agg(F.min(F.struct("d2", "node_id")).alias("best"))
    return best.select(*key, F.col("px").alias("x"), F.col("py").alias("y"), "best.node_id", "best.d2")
