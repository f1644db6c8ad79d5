"""The street network as costed for a point in time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.functions.bins import DayRange, bins_of
from odflow.runtime import BROADCAST_ROWS, broadcast_if_small

EDGE_COLUMNS = ("id", "source", "target", "cost")
# Costed edges that a task has at most, about, where bins are dealt out.
TASK_ROWS = 4_000_000


def bins_dealt(edges: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``every_edge`` deals out bins, so that all edges of a bin are in one task."""
    return edges.limit(max_rows + 1).count() <= max_rows


def every_edge(bins: DataFrame, key: str, edges: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every row of ``bins``, a few hundred a day, with every edge.

    While the edges are few enough to be broadcast, bins are dealt out, so that all edges of a bin are in one task, and a task has few
    enough of them to sort them without spilling. Else edges are dealt out. Either way the work is spread however few files the
    edges are in.
    """
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if bins_dealt(edges, max_rows):
        tasks = max(tasks, -(-bins.count() * edges.count() // TASK_ROWS))
        return bins.repartition(tasks, key).join(F.broadcast(edges), how="cross")
    return edges.repartition(tasks, "id").join(F.broadcast(bins), how="cross")


@dataclass(frozen=True)
class TimedNetwork:
    """Directed edges whose cost depends on the five-minute bin.

    ``profile`` maps a bin start to the key its costs depend on. Bins that share a
    profile share every path, so the search runs once per profile, not once per bin:
    a network costed by time of day is searched for at most 288 profiles however many
    days are routed.

    With ``cost`` the edges are static and ``cost(profile, edge)`` is a column expression,
    where ``edge(name)`` is a column of the edge; nothing the size of edges x bins is stored.
    Without it the edge table carries ``profile`` and ``cost`` columns itself. ``by_profile`` says that it is dealt out by them,
    as ``every_edge`` leaves it, so that a search may leave it where it is; of another table that is wasteful, not wrong.
    """

    edges: DataFrame
    profile: Callable[[Column], Column] = lambda bin_start: bin_start
    cost: Callable[[Column, Callable[[str], Column]], Column] | None = None
    by_profile: bool = False

    @classmethod
    def from_table(cls, costed: DataFrame, by_bin: bool = False) -> TimedNetwork:
        """A table (bin_start, id, source, target, cost) with one snapshot per bin; ``by_bin`` if it is dealt out by bin."""
        return cls(costed.withColumnRenamed("bin_start", "profile"), by_profile=by_bin)

    def of_profiles(self, keys: DataFrame) -> DataFrame:
        """The edges of a table of snapshots joined to ``keys``, which has a column ``profile`` and few rows an edge.

        The keys are broadcast while they are few, so a table stored by bin is read for the bins asked for only.
        """
        return self.edges.join(broadcast_if_small(keys), "profile")

    def leaving(self, at: DataFrame, node: str) -> DataFrame:
        """``at`` joined to the usable edges that leave its ``node``: adds id, target and cost."""
        return self._joined(at, node, "source", "target")

    def entering(self, at: DataFrame, node: str) -> DataFrame:
        """``at`` joined to the usable edges that enter its ``node``: adds id, source and cost."""
        return self._joined(at, node, "target", "source")

    def _joined(self, at: DataFrame, node: str, near: str, far: str) -> DataFrame:
        # An edge with a negative or missing cost is closed. Edge columns get a prefix, since
        # what they are joined to may have a source and a target of its own.
        edges = self.edges.select(*[F.col(name).alias(f"edge_{name}") for name in self.edges.columns])
        on = F.col(node) == F.col(f"edge_{near}")
        if self.cost is None:
            joined = at.join(edges, on & (F.col("profile") == F.col("edge_profile")))
            cost = F.col("edge_cost")
        else:
            joined = at.join(edges, on)
            cost = self.cost(F.col("profile"), lambda name: F.col(f"edge_{name}"))
        return joined.select(*at.columns, F.col("edge_id"), F.col(f"edge_{far}"),
                             cost.alias("edge_cost")).filter("edge_cost >= 0")

    def for_profiles(self, profiles: DataFrame) -> DataFrame:
        """The usable costed edges of each profile in ``profiles``, which has each once.

        (profile, edge_id, edge_source, edge_target, edge_cost). Of a table of snapshots only the
        profiles asked for are read on.
        """
        keys = profiles.select("profile")
        if self.cost is None:
            keyed = self.of_profiles(keys)
        else:
            # Every edge becomes a row per profile, so even a small edge table is spread out first.
            tasks = int(self.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            listed = keys.agg(F.collect_list("profile")).scalar()
            keyed = (self.edges.repartition(tasks, "id").select("*", F.explode(listed).alias("profile"))
                     .withColumn("cost", self.cost(F.col("profile"), F.col)))
        return keyed.filter("cost >= 0 AND source IS NOT NULL AND target IS NOT NULL").select(
            "profile", *[(F.col(name) if name == "cost" else F.col(name).cast("long")).alias(f"edge_{name}")
                         for name in EDGE_COLUMNS])

    def beside(self, keys: DataFrame) -> DataFrame:
        """Every row of ``keys``, which have a ``profile``, with the usable edges as costed for it: adds edge_id, edge_source, edge_target, edge_cost.

        For static edges that a task can hold: they are broadcast, and costed where the keys are, in their order, so nothing of the size
        of edges x profiles is shuffled or sorted.
        """
        edges = self.edges.select(*[F.col(name).alias(f"edge_{name}") for name in self.edges.columns])
        cost = self.cost(F.col("profile"), lambda name: F.col(f"edge_{name}"))
        costed = keys.join(F.broadcast(edges), how="cross").withColumn("edge_cost", cost)
        return costed.filter("edge_cost >= 0 AND edge_source IS NOT NULL AND edge_target IS NOT NULL").select(
            *keys.columns, *[F.col(f"edge_{name}").cast("long").alias(f"edge_{name}") for name in ("id", "source", "target")], "edge_cost")

    def for_days(self, days: list[DayRange]) -> DataFrame:
        """The costed edges of every bin of the days: (bin_start, id, source, target, cost)."""
        if self.cost is None:
            keyed = bins_of(self.edges.sparkSession, days).withColumn("profile", self.profile(F.col("bin_start")))
            return keyed.join(self.edges, "profile").select("bin_start", *EDGE_COLUMNS)
        # What depends on the bin is worked out once per bin, not once per edge of it.
        keyed = bins_of(self.edges.sparkSession, days).select("bin_start", self.profile(F.col("bin_start")).alias("profile"))
        keyed = every_edge(keyed, "bin_start", self.edges)
        return keyed.withColumn("cost", self.cost(F.col("profile"), F.col)).select("bin_start", *EDGE_COLUMNS)
