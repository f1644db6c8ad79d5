"""What several operators share: table access, durable intermediates, hashed character n-grams."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflow.runtime import broadcast_if_small, ensure_checkpoint_dir

# Code points turned into n-grams at a time, so that a long text needs no more memory than a short one.
PIECE_CHARS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def packed(docs: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """A row of ``docs`` as the struct ``row``, so that no working column can clash with its columns."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in but]).alias("row")


def placed(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with ``out``, the place of each row in the order in which a sorted table was written, from 0.

    A scan packs files by their size, so the order is read off the files: by name, and by row within each. Rows that come
    from no file get rising numbers in the order they are in. A column of that name is replaced.
    """
    try:
        found = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return docs.withColumn(out, F.monotonically_increasing_id())
    # A row per file.
    sizes = found.groupBy("_file").agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_file").alias("_name"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_start"))
    at = F.col("_start") + F.col("_row")
    return found.join(broadcast_if_small(starts), F.col("_file") == F.col("_name")).withColumn(out, at).drop(
        "_file", "_row", "_name", "_start")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; NULL without an id."""
    return F.crc32(doc_id.cast("string")) % modulus


def text_pieces(text: str, overlap: int) -> Iterator[str]:
    """A text in pieces of bounded size; each starts with the last ``overlap`` characters of the one before."""
    start = 0
    while True:
        yield text[max(0, start - overlap): start + PIECE_CHARS]
        start += PIECE_CHARS
        if start >= len(text):
            return


def hashed_ngrams(text: str, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams of a whole text, a bounded piece at a time.

    Every occurrence appears once: later pieces overlap by order - 1 characters only.
    """
    shift = np.uint64(64 - bits)
    for order in orders:
        for piece in text_pieces(text, order - 1):
            codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
            if len(codes) < order:
                continue
            grams = np.full(len(codes) - order + 1, order, dtype=np.uint64)
            for k in range(order):
                grams *= np.uint64(1_000_003)
                grams += codes[k: len(codes) - order + 1 + k]
            grams *= _MIX
            grams ^= grams >> np.uint64(29)
            grams *= _MIX
            yield (grams >> shift).astype(np.int64)
