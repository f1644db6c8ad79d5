"""Session helpers: size-checked broadcasts and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table of this many narrow rows stays well under 100 MB per executor.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, sized_by: DataFrame | None = None,
                       max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the table was counted and is within the bound.

    ``sized_by`` is a cheaper table known to have at least as many rows as ``df``
    (for example the raw scan that ``df`` was looked up from). Above the bound the
    join is left to the optimizer, which shuffles it and splits skewed partitions.
    """
    probe = df if sized_by is None else sized_by
    small = probe.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; a local session gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="odflow-checkpoint-")
    context.setCheckpointDir(shared)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder now and go on from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and go on from there; for tables of which often a few columns are read."""
    folder = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def settled(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` as checkpointed, and its number of rows; for loops that go on from it.

    A checkpoint by itself computes its last stage twice, and takes along the optimizer's estimate of its size. Every join
    multiplies the estimates of its sides, so after some dozens of rounds a number of millions of digits is multiplied for each
    plan. A copy held while it is written is computed once, and its size is measured.
    """
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    rows = held.count()
    # Planned after the copy is there, so that its size is the one measured.
    out = held.select("*").checkpoint(eager=True)
    held.unpersist()
    return out, rows


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL options for a while and put them back as they were."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
