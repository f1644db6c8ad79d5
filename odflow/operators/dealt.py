"""Joins on keys of which one may hold any share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.runtime import broadcast_if_small, checkpointed

# Rows of one key that are left together.
SHARE_ROWS = 500_000


def dealt_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner",
               share_rows: int = SHARE_ROWS) -> DataFrame:
    """``left`` joined to ``right`` where each (left name, right name) of ``on`` is equal; for a right side of few rows a key.

    The keys of ``left`` are counted first. A key of more than ``share_rows`` rows, NULL among them, is dealt out over as many
    shares as it needs, by a hash of the row, and the right rows of such a key are copied to each share. Counting computes
    ``left`` once more, so a costly one should be checkpointed. Names in ``left`` and ``right`` must differ.
    """
    same = reduce(and_, [F.col(mine) == F.col(theirs) for mine, theirs in on])
    hot_names = [f"_hot_{n}" for n in range(len(on))]
    counted = left.groupBy(*[F.col(mine).alias(name) for (mine, _), name in zip(on, hot_names, strict=True)]).count()
    # At most rows / share_rows keys.
    hot = checkpointed(counted.filter(F.col("count") > share_rows)
                       .select(*hot_names, F.ceil(F.col("count") / share_rows).cast("int").alias("_shares")))
    if hot.isEmpty():
        return left.join(right, same, how)
    hot = broadcast_if_small(hot)
    shares = F.coalesce("_shares", F.lit(1))

    def with_shares(df: DataFrame, names: list[str]) -> DataFrame:
        is_hot = reduce(and_, [F.col(name).eqNullSafe(F.col(key)) for name, key in zip(names, hot_names, strict=True)])
        return df.join(hot, is_hot, "left")

    dealt = (with_shares(left, [mine for mine, _ in on])
             .withColumn("_share", F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in left.columns]), shares).cast("int"))
             .drop("_shares", *hot_names))
    copies = (with_shares(right, [theirs for _, theirs in on])
              .withColumn("_copy", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares", *hot_names))
    return dealt.join(copies, same & (F.col("_share") == F.col("_copy")), how).drop("_share", "_copy")
