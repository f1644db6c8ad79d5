"""Order large groups without putting any group into one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.runtime import checkpointed

ROWS_PER_CHUNK = 2_000_000


def range_chunks(df: DataFrame, order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Range-partition by ``order`` and add ``chunk``, which rises with it, and ``tie``.

    ``tie`` is unique and part of the order, so even a run of equal rows is split. The result is
    checkpointed: chunk numbers are partition numbers and must not change on a retry.
    """
    tied = checkpointed(df.withColumn("tie", F.monotonically_increasing_id()))
    n_chunks = max(tied.sparkSession.sparkContext.defaultParallelism, -(-tied.count() // rows_per_chunk))
    keys = [F.col(name).asc_nulls_last() for name in order]
    ranged = tied.repartitionByRange(n_chunks, *keys, F.col("tie"))
    return checkpointed(ranged.withColumn("chunk", F.spark_partition_id()))


def numbered_in(df: DataFrame, group: list[str], order: list[str], out: str,
                rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add the running number, from 1, of each row within ``group`` by ``order``, for groups of any size.

    Rows are range-partitioned and numbered chunk by chunk; a chunk's numbers start after the counts of the
    group's earlier chunks. NULLs are last. Equal rows follow each other in any order.
    """
    chunks = range_chunks(df, [*group, *order], rows_per_chunk)
    in_chunk = Window.partitionBy(*group, "chunk").orderBy(*[F.col(name).asc_nulls_last() for name in order], "tie")
    earlier = Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = chunks.groupBy(*group, "chunk").count()
    offsets = counts.select(*group, "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    return (_join_nullable(chunks.withColumn("n", F.row_number().over(in_chunk)), offsets, [*group, "chunk"])
            .select(*df.columns, (F.col("before") + F.col("n")).alias(out)))


def dense_rank_in(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Add the dense rank of ``value`` within ``group``, for groups of any size: the running number of its distinct values."""
    ranks = numbered_in(df.select(*group, value).distinct(), group, [value], out)
    # NULL is a value and has a rank like the others.
    return _join_nullable(df, ranks, [*group, value])


def _join_nullable(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, where NULL equals NULL."""
    right = right.withColumnsRenamed({name: f"key_{name}" for name in keys})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"key_{name}")) for name in keys])
    return left.join(right, same).drop(*[f"key_{name}" for name in keys])
