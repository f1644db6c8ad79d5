"""Mixing sources to target weights by Pfair scheduling.

A source of weight w gets its j-th block (from 1) released at slot floor((j - 1) / w) and due by slot
ceil(j / w). Earliest deadline first then deals one block to each slot; every block meets its
deadline, so at any slot a source has had less than one block more or less than its weight asks for.

Weights are exact fractions, and so are the windows; nothing repeats. The driver works out one slot for every block, of which
there are at most MAX_BLOCKS: with more rows the blocks are larger, and the guarantee is in blocks. Rows are
numbered within their source by range partitions, whatever a source's share, and look their block's slot up.
When a source runs out its later slots stay empty, and the others go on among themselves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import packed
from odflow.runtime import checkpointed

BLOCK_ROWS = 16
# The schedule and the sources' weights are held by the driver; more sources are an error.
MAX_BLOCKS = 1 << 19
MAX_SOURCES = 100_000
ROWS_PER_CHUNK = 500_000


def shares(weights: dict[str | None, float]) -> dict[str | None, Fraction]:
    """The exact share of each source in the slots."""
    total = sum(map(Fraction, weights.values()), Fraction(0))
    return {name: Fraction(weight) / total for name, weight in weights.items()}


def pfair(parts: dict[str | None, Fraction], blocks: dict[str | None, int]) -> Iterator[tuple[int, str | None, int]]:
    """The schedule of all blocks: (slot, source, number of the block), by slot.

    Equal deadlines go to the block released first, then to the first source in order. Slots at which no
    block is released are skipped.
    """
    order = sorted((name for name in parts if blocks.get(name)), key=lambda name: (name is None, name or ""))
    sizes = [(parts[name].numerator, parts[name].denominator) for name in order]

    def released(rank: int, block: int) -> int:
        weight, whole = sizes[rank]
        return block * whole // weight

    waiting = [(0, rank, 0) for rank in range(len(order))]
    ready: list[tuple[int, int, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, rank, block = heapq.heappop(waiting)
            weight, whole = sizes[rank]
            heapq.heappush(ready, (-(-(block + 1) * whole // weight), release, rank, block))
        due, _, rank, block = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        yield slot, order[rank], block
        if block + 1 < blocks[order[rank]]:
            heapq.heappush(waiting, (released(rank, block + 1), rank, block + 1))
        slot += 1


def source_sizes(rows: DataFrame) -> dict[str | None, int]:
    """The number of rows of each source."""
    sizes = rows.groupBy("source").count().limit(MAX_SOURCES + 1).collect()
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: the schedule would not fit its bound")
    return {row["source"]: row["count"] for row in sizes}


def tempered_weights(sizes: dict[str | None, int], exponent: float = 0.5) -> dict[str | None, float]:
    """Target weights by size: each source's number of rows to the power ``exponent``."""
    return {name: float(size) ** exponent for name, size in sizes.items()}


def rows_to_a_block(sizes: dict[str | None, int], least: int, max_blocks: int) -> int:
    """``least`` rows, or as many as keep the blocks within ``max_blocks``; a source has one block at least."""
    size = least
    while sum(-(-rows // size) for rows in sizes.values()) > max(max_blocks, len(sizes)):
        size *= 2
    return size


def numbered(keys: DataFrame, order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``keys`` (narrow rows with ``source``) with ``rank``, from 0 within the source by ``order``.

    Rows are range-partitioned by source, order and a tie-breaker, so a hot source or a run of equal
    rows spreads over tasks; a chunk's ranks start after the counts of the source's earlier chunks.
    """
    spark = keys.sparkSession
    tied = checkpointed(keys.withColumn("tie", F.monotonically_increasing_id()))
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tied.count() // rows_per_chunk))
    ranged = tied.repartitionByRange(chunks, "source", *order, "tie")
    placed = checkpointed(ranged.withColumn("chunk", F.spark_partition_id()))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # A chunk is a range of the order, so there are no more pairs than chunks and sources.
    offsets = (placed.groupBy("source", "chunk").count()
               .select(F.col("source").alias("o_source"), F.col("chunk").alias("o_chunk"),
                       F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")))
    within = Window.partitionBy("source", "chunk").orderBy(*order, "tie")
    same = (F.col("chunk") == F.col("o_chunk")) & F.col("source").eqNullSafe(F.col("o_source"))
    return (placed.withColumn("n", F.row_number().over(within)).join(offsets, same)
            .withColumn("rank", F.col("before") + F.col("n") - 1)
            .drop("tie", "chunk", "o_source", "o_chunk", "before", "n"))


def schedule(keys: DataFrame, order: list[str], weights: dict[str | None, float] | None = None,
             block_rows: int = BLOCK_ROWS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``keys`` with ``rank`` and ``block`` (within the source), ``slot`` and ``position``, which orders the mixture.

    ``keys`` holds ``source`` and what ``order`` needs; a NULL source is a source of its own. Without
    weights those of ``tempered_weights`` are taken. A source the weights do not name is an error,
    since its rows would have no slot; names without rows are no matter. Every row appears once, repeated rows as
    often as they are there. Columns of ``keys`` called rank, block, slot or position are replaced.
    """
    keys = keys.drop("rank", "block", "slot", "position")
    sizes = source_sizes(keys)
    weights = tempered_weights(sizes) if weights is None else weights
    if unnamed := [name for name in sizes if name not in weights]:
        raise ValueError(f"no weight for source {unnamed[0]}")
    if any(not weight > 0 for weight in weights.values()):
        raise ValueError("weights are positive")
    size = rows_to_a_block(sizes, block_rows, max_blocks)
    dealt = pfair(shares(weights), {name: -(-rows // size) for name, rows in sizes.items()})
    pattern = pd.DataFrame(dealt, columns=["slot", "s_source", "s_block"]).astype({"slot": "int64", "s_block": "int64"})
    slots = keys.sparkSession.createDataFrame(pattern, "slot long, s_source string, s_block long")
    ranked = numbered(keys, order).withColumn("block", F.floor(F.col("rank") / size))
    # The schedule has a row per block, at most max_blocks or the number of sources.
    same = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("block") == F.col("s_block"))
    slotted = ranked.join(F.broadcast(slots), same).drop("s_source", "s_block")
    return slotted.withColumn("position", F.col("slot") * size + F.col("rank") % size)


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS,
        max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """All rows of ``docs`` in the order of the mixture, with its columns.

    Written as files the order is that of their names and of the rows in each; ``common.placed`` reads it back. Within a source rows go by a hash of their id. Fully equal rows share one place in the order.
    Only ids and hashes are numbered; texts move twice, to meet their position and into order.
    """
    keyed = docs.select(packed(docs), "source", "doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key"))
    places = (schedule(keyed.drop("row"), ["key", "doc_id"], weights, block_rows, max_blocks)
              .groupBy(F.col("key").alias("p_key"), F.col("doc_id").alias("p_id"))
              .agg(F.min("position").alias("position")))
    same = (F.col("key") == F.col("p_key")) & F.col("doc_id").eqNullSafe(F.col("p_id"))
    return keyed.select("row", "doc_id", "key").join(places, same, "left").orderBy("position").select("row.*")
