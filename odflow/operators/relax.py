"""Shortest paths where the network of one profile fits a task.

Pairs are grouped by profile and part of the sources, and every group meets the costed edges of its profile
once: static edges are costed where the group is, those of snapshots come packed, or stay where they are. Pairs that share their target with more others than their source are searched from the target, against the
edges. Inside a task all sources of a block are relaxed together, as arrays: round h offers every vertex that improved in
round h - 1 to its neighbours, so a label's round is its number of edges, and a long path costs rounds of a few
microseconds, not jobs. Offers that cannot lie on a wanted path are dropped early: costs to and from a few landmarks bound from
below what is left to a target, and from above what a target costs before it is reached. Paths are then read back over
tight edges for all pairs of the block at once.

That is for costs that round. Whole ones are searched by keys, numbers that order paths by cost and then by edges: sources with many targets in
windows of growing keys, so that a label is expanded about once, pairs that are found far apart one by one towards their target, by landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.runtime import broadcast_if_small, checkpointed, session_conf
from odflow.sources.network import TimedNetwork

PAIR = ["profile", "source", "target"]
EDGE = ["edge_id", "edge_source", "edge_target", "edge_cost"]
# Edges of one profile that a task may hold, the fewest sources and the most pairs of a part, and labels of a block held at once.
TASK_EDGES = 2_000_000
SOURCES_PER_PART = 128
PAIRS_PER_PART = 50_000
BLOCK_LABELS = 1 << 22
# Parts for each slot of the cluster, were all pairs of one profile; edges that a task packs at a time.
PARTS_PER_SLOT = 4
PACK_ROWS = 1 << 21
# Landmarks of a network, and sources in a part from which on bounds are worth the searches that make them.
LANDMARKS = 6
BOUNDED_SOURCES = 24
# Sources with more targets than this are bounded by their dearest target only.
GOALS = 8
# A path is first sought at up to these multiples of its lower bound, then at any cost.
TRIALS = (1.15, 1.5)
# Cost types whose sums are the same in arrays as in Spark: the type they are summed in and that of the result.
SUMMED_AS = {T.LongType: (np.int64, pa.int64()), T.IntegerType: (np.int64, pa.int32()),
             T.ShortType: (np.int64, pa.int16()), T.DoubleType: (np.float64, pa.float64())}
# Whole numbers below this are exact as doubles; why a network cannot be searched.
EXACT = 2.0 ** 53
NOT_FINITE = "ValueError: an edge costs no finite number"
NOT_EXACT = "OverflowError: the cost of a path may not be exact"


def fits_a_task(pairs: DataFrame, network: TimedNetwork, cost_type: T.DataType, task_edges: int) -> bool:
    """Whether every profile of the pairs has at most ``task_edges`` edges, counted, and costs of a type that arrays hold."""
    if type(cost_type) not in SUMMED_AS or task_edges < 1:
        return False
    if network.cost is not None:
        return network.edges.limit(task_edges + 1).count() <= task_edges
    asked = network.of_profiles(pairs.select("profile").distinct())
    return asked.groupBy("profile").count().filter(F.col("count") > task_edges).isEmpty()


@dataclass(frozen=True)
class _Graph:
    """Edges by their source, and by target and id; vertices are numbers from 0."""

    ids: np.ndarray
    tails: np.ndarray
    heads: np.ndarray
    costs: np.ndarray
    leaving: np.ndarray
    entering: np.ndarray
    by_head: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, tails: np.ndarray, heads: np.ndarray, costs: np.ndarray, size: int) -> _Graph:
        order = np.lexsort((ids, tails))
        ids, tails, heads, costs = ids[order], tails[order], heads[order], costs[order]
        places = np.arange(size + 1)
        by_head = np.lexsort((ids, heads))
        return cls(ids, tails, heads, costs, np.searchsorted(tails, places), np.searchsorted(heads[by_head], places), by_head)


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [start, end), and which range each belongs to."""
    lengths = ends - starts
    owner = np.repeat(np.arange(len(starts)), lengths)
    first = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(len(owner)) + first, owner


@dataclass(frozen=True)
class Bounds:
    """Costs from and to the landmarks, by (landmark, vertex); infinite where there is no path."""

    away: np.ndarray
    back: np.ndarray

    @classmethod
    def of(cls, graph: _Graph, size: int) -> Bounds:
        """Landmarks far from each other: each is the vertex dearest to reach from the ones before."""
        nearest, away, chosen, place = np.full(size, np.inf), [], [], 0
        for _ in range(LANDMARKS + 1):
            costs = _to_everywhere(graph, size, np.array([place]))[0]
            if chosen or place:
                chosen.append(place)
                away.append(costs)
                nearest = np.minimum(nearest, costs)
            reached = np.where(np.isfinite(nearest if chosen else costs), nearest if chosen else costs, -1.0)
            place = int(reached.argmax())
            if place in chosen:
                break
        if not chosen:
            chosen, away = [0], [_to_everywhere(graph, size, np.array([0]))[0]]
        turned = _Graph.of(graph.ids, graph.heads, graph.tails, graph.costs, size)
        return cls(np.array(away), _to_everywhere(turned, size, np.array(chosen)))

    def least(self, vertices: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """What a path from each vertex to its target costs at least; infinite if there is none."""
        with np.errstate(invalid="ignore"):
            ahead = self.away[:, targets] - self.away[:, vertices]
            behind = self.back[:, vertices] - self.back[:, targets]
        # The difference of two infinite costs says nothing.
        return np.fmax(np.fmax.reduce(np.vstack([ahead, behind]), axis=0), 0.0)

    def turned(self) -> Bounds:
        """The bounds in the network with its edges turned round."""
        return Bounds(self.back, self.away)

    def most(self, sources: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """What a path costs at most: that by way of the best landmark."""
        return (self.back[:, sources] + self.away[:, targets]).min(axis=0)


class Labels:
    """Costs and numbers of edges from the sources of a block, flat by (source, vertex); unreached ones have the greatest cost.

    The arrays serve block after block: a search notes what it touched, and only that is cleared.
    """

    def __init__(self, number: int, dtype: np.dtype):
        self.far = np.iinfo(np.int64).max if dtype == np.int64 else np.inf
        self.dist = np.full(number, self.far, dtype=dtype)
        self.hops = np.zeros(number, dtype=np.int32)
        self.touched: list[np.ndarray] = []

    def touch(self, places: np.ndarray) -> None:
        self.touched.append(places)

    def clear(self, size: int, sources: np.ndarray | None = None) -> None:
        """Forget all labels, or those of some sources."""
        touched = np.concatenate([np.zeros(0, dtype=np.int64), *self.touched])
        gone = touched if sources is None else touched[np.isin(touched // size, sources)]
        self.dist[gone], self.hops[gone] = self.far, 0
        self.touched = [] if sources is None else [touched[~np.isin(touched // size, sources)]]


def _to_everywhere(graph: _Graph, size: int, sources: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(sources)), size)
    dist, _, _ = relaxed(graph, size, sources, owner, np.tile(np.arange(size), len(sources)))
    costs = dist.astype(np.float64).reshape(len(sources), size)
    if dist.dtype == np.int64:
        costs[(dist == np.iinfo(np.int64).max).reshape(costs.shape)] = np.inf
    return costs


def relaxed(graph: _Graph, size: int, sources: np.ndarray, owner: np.ndarray, targets: np.ndarray,
            bounds: Bounds | None = None, at_most: np.ndarray | None = None,
            held: Labels | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Costs and numbers of edges from each source to each vertex, flat by (source, vertex), and how many labels were made.

    ``owner`` (sorted) says whose ``targets`` are wanted, at a cost of ``at_most``; a source that owns none is not searched from. A
    source takes no label dearer than its dearest target can be, and with few targets none from which each of them is too far; so only labels on wanted paths are
    final, and a target that is dearer than ``at_most`` may have any label or none. Unreached labels have the
    greatest number of their type. With ``held`` labels are made there, where the sources searched from have none yet.
    """
    whole = graph.costs.dtype == np.int64
    labels_held = Labels(len(sources) * size, graph.costs.dtype) if held is None else held
    dist, hops, far = labels_held.dist, labels_held.hops, labels_held.far
    wanted = owner * size + targets
    first_target = np.searchsorted(owner, np.arange(len(sources) + 1))
    goals = np.diff(first_target)
    searched = np.flatnonzero(goals)
    frontier = searched * size + sources[searched]
    dist[frontier] = 0
    labels_held.touch(frontier)
    # Bounds are sums in floating point, so a little more than them is let through.
    slack = 1.0 if whole else 1.0 + 1e-9
    at_most = np.full(len(wanted), np.inf) if at_most is None else at_most
    limit = np.full(len(sources), -1.0)
    steps = labels = 0
    while len(frontier):
        # What each target costs at most by now, and the most of them for each source.
        reached = dist[wanted]
        at_most = np.minimum(at_most, np.where(reached == far, np.inf, reached.astype(np.float64) * slack))
        limit[searched] = np.maximum.reduceat(at_most, first_target[searched])
        steps += 1
        mine, vertex = np.divmod(frontier, size)
        edge, offered = _spans(graph.leaving[vertex], graph.leaving[vertex + 1])
        mine, onto = mine[offered], graph.heads[edge]
        offer = dist[frontier[offered]] + graph.costs[edge]
        label = mine * size + onto
        good = (offer < dist[label]) & (offer <= limit[mine])
        label, offer, mine, onto = label[good], offer[good], mine[good], onto[good]
        if bounds is not None and len(label):
            few = np.flatnonzero(goals[mine] <= GOALS)
            goal, asked = _spans(first_target[mine[few]], first_target[mine[few] + 1])
            in_time = (offer[few[asked]] + bounds.least(onto[few[asked]], targets[goal]) * (1.0 - 1e-9)) <= at_most[goal]
            keep = np.ones(len(label), dtype=bool)
            keep[few] = np.bincount(asked, weights=in_time, minlength=len(few)) > 0
            label, offer = label[keep], offer[keep]
        np.minimum.at(dist, label, offer)
        frontier = np.unique(label)
        hops[frontier] = steps
        labels_held.touch(frontier)
        labels += len(frontier)
    return dist, hops, labels


def goal_directed(graph: _Graph, size: int, sources: np.ndarray, owner: np.ndarray, targets: np.ndarray,
                  bounds: Bounds, held: Labels | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``relaxed``, with paths sought close to their lower bounds first.

    A path found within what was allowed is the cheapest one, since every cheaper one was allowed, too. Sources with a target that
    was not are searched anew at a higher cost; a target that bounds rule out is not searched for. A source with many targets
    is searched once, up to the most that one of them can cost.
    """
    held = Labels(len(sources) * size, graph.costs.dtype) if held is None else held
    least = bounds.least(sources[owner], targets)
    no_path = np.isinf(least)
    most = np.where(no_path, -1.0, bounds.most(sources[owner], targets) * (1.0 + 1e-9) + 1.0)
    many = np.bincount(owner, minlength=len(sources))[owner] > GOALS
    mine, labels = np.ones(len(owner), dtype=bool), 0
    for factor in (*TRIALS, np.inf):
        allowed = most.copy()
        if np.isfinite(factor):
            near = ~many & ~no_path
            allowed[near] = np.minimum(most[near], least[near] * factor)
        allowed = allowed[mine]
        _, _, made = relaxed(graph, size, sources, owner[mine], targets[mine], bounds, allowed, held)
        labels += made
        reached = held.dist[owner[mine] * size + targets[mine]].astype(np.float64)
        open_ = np.unique(owner[mine][(reached > allowed) & ~no_path[mine] & ~many[mine]])
        if not len(open_) or not np.isfinite(factor):
            break
        held.clear(size, open_)
        mine = np.isin(owner, open_)
    return held.dist, held.hops, labels


def read_back(graph: _Graph, size: int, dist: np.ndarray, hops: np.ndarray, owner: np.ndarray,
              targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the path of each pair, by (pair, place): of the tight edges into a vertex the one with the smallest id."""
    walkers, here = np.arange(len(owner)), owner * size + targets
    pairs, places, taken = [], [], []
    while True:
        moving = hops[here] > 0
        walkers, here = walkers[moving], here[moving]
        if not len(walkers):
            break
        mine, vertex = np.divmod(here, size)
        place, walker = _spans(graph.entering[vertex], graph.entering[vertex + 1])
        edge = graph.by_head[place]
        tail = mine[walker] * size + graph.tails[edge]
        # A tail without a label has the greatest cost, to which nothing is added.
        ready = np.flatnonzero(hops[tail] == hops[here[walker]] - 1)
        edge, tail, walker = edge[ready], tail[ready], walker[ready]
        reached = dist[tail] <= dist[here[walker]]
        edge, tail, walker = edge[reached], tail[reached], walker[reached]
        tight = dist[tail] + graph.costs[edge] == dist[here[walker]]
        edge, tail, walker = edge[tight], tail[tight], walker[tight]
        _, chosen = np.unique(walker, return_index=True)
        pairs.append(walkers)
        places.append(hops[here])
        taken.append(edge[chosen])
        here = tail[chosen]
    if not pairs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pair, place, edge = np.concatenate(pairs), np.concatenate(places), np.concatenate(taken)
    order = np.lexsort((place, pair))
    return pair[order], edge[order]


def read_ahead(graph: _Graph, size: int, dist: np.ndarray, hops: np.ndarray, owner: np.ndarray,
               roots: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``read_back``, of labels that were made from the targets ``roots``, against the edges, for pairs that start at ``starts``.

    The tight edges ahead of the starts make up all the cheapest paths with the fewest edges. They are gathered by the
    number of edges left, and the choice is then made from the target back, as ``read_back`` makes it.
    """
    left = hops[owner * size + starts]
    by_left = np.argsort(left, kind="stable")
    first = np.searchsorted(left[by_left], np.arange(int(left.max(initial=0)) + 2))
    walkers, here, ways = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), {}
    for togo in range(int(left.max(initial=0)), 0, -1):
        joined = by_left[first[togo]: first[togo + 1]]
        walkers, here = np.concatenate([walkers, joined]), np.concatenate([here, starts[joined]])
        edge, walker = _spans(graph.leaving[here], graph.leaving[here + 1])
        mine = owner[walkers[walker]] * size
        label, ahead = mine + here[walker], mine + graph.heads[edge]
        ready = np.flatnonzero((hops[ahead] == togo - 1) & (dist[ahead] <= dist[label]))
        ready = ready[dist[ahead[ready]] + graph.costs[edge[ready]] == dist[label[ready]]]
        walker, edge = walkers[walker[ready]], edge[ready]
        ways[togo] = (walker, edge)
        # Paths that meet again go on as one.
        walkers, here = np.divmod(np.unique(walker * size + graph.heads[edge]), size)
    at = roots[owner]
    pairs, places, taken = [], [], []
    for togo in sorted(ways):
        walker, edge = ways[togo]
        chosen = graph.heads[edge] == at[walker]
        walker, edge = walker[chosen], edge[chosen]
        order = np.lexsort((graph.ids[edge], walker))
        walker, edge = walker[order], edge[order]
        walker, one = np.unique(walker, return_index=True)
        at[walker] = graph.tails[edge[one]]
        pairs.append(walker)
        places.append(left[walker] - togo)
        taken.append(edge[one])
    if not pairs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pair, place, edge = np.concatenate(pairs), np.concatenate(places), np.concatenate(taken)
    order = np.lexsort((place, pair))
    return pair[order], edge[order]


def _read_ahead_by_chunks(graph: _Graph, size: int, dist: np.ndarray, hops: np.ndarray, owner: np.ndarray, roots: np.ndarray,
                          starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``read_ahead`` of as many pairs at once as a block has labels for, should each of them have ties all over the network."""
    chunk = max(1, BLOCK_LABELS // size)
    parts = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for first in range(0, len(owner), chunk):
        pair, edge = read_ahead(graph, size, dist, hops, owner[first: first + chunk], roots, starts[first: first + chunk])
        parts.append((pair + first, edge))
    return np.concatenate([pair for pair, _ in parts]), np.concatenate([edge for _, edge in parts])


def _listed_steps(graph: _Graph, vertices: np.ndarray, edge: np.ndarray, before: np.ndarray, target: np.ndarray, whole: np.ndarray,
                  lengths: np.ndarray) -> pa.Array:
    """A list of steps for each pair, of its edges in order and the costs ``before`` them."""
    # Behind the edges of each pair comes the step at its target.
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    total = int(offsets[-1])
    at_end = np.zeros(total, dtype=bool)
    at_end[offsets[1:] - 1] = True
    node, taken = np.empty(total, dtype=np.int64), np.full(total, -1, dtype=np.int64)
    cost, up_to = np.zeros(total, dtype=whole.dtype), np.empty(total, dtype=whole.dtype)
    node[at_end], up_to[at_end] = vertices[target], whole
    node[~at_end], taken[~at_end] = vertices[graph.tails[edge]], graph.ids[edge]
    cost[~at_end], up_to[~at_end] = graph.costs[edge], before
    seq = (np.arange(total) - np.repeat(offsets[:-1], lengths + 1) + 1).astype(np.int32)
    steps = pa.StructArray.from_arrays([pa.array(seq), pa.array(node), pa.array(taken), pa.array(cost), pa.array(up_to)],
                                       ["path_seq", "node", "edge", "cost", "agg_cost"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)


def _block_paths_keyed(ways: Keyed, turned: Keyed | None, vertices: np.ndarray, roots: np.ndarray, owner: np.ndarray, ends: np.ndarray,
                       held: Keys, with_steps: bool, budget: int | None, guide: Guide | None) -> tuple[np.ndarray, tuple]:
    """The roots that are left for later, and of the others what ``_block_paths`` gives; for costs that are whole."""
    size, graph = len(vertices), ways.graph
    left, against = np.zeros(0, dtype=np.int64), ways if turned is None else turned
    if guide is None:
        left, _ = settled_keys(against, roots, owner, ends, held, budget)
    else:
        guided_keys(against, roots, ends, held, guide)
    keys = held.keys[owner * size + ends]
    found = np.flatnonzero((keys != held.FAR) & ~np.isin(owner, left))
    owner, ends, keys = owner[found], ends[found], keys[found]
    whole, lengths = ways.cost_of(keys), ways.hops_of(keys)
    steps = None
    if with_steps:
        if turned is None:
            pair, edge = _steps_from_source(ways, held, owner, ends)
            target, before = ends, ways.cost_of(held.keys[owner[pair] * size + graph.tails[edge]])
        else:
            pair, edge = _steps_to_target(ways, turned, held, owner, roots, ends)
            target, before = roots[owner], whole[pair] - ways.cost_of(held.keys[owner[pair] * size + graph.tails[edge]])
        steps = _listed_steps(graph, vertices, edge, before, target, whole, lengths)
    held.clear()
    return left, (found, whole, lengths, steps)


def _block_paths(graph: _Graph, turned: _Graph | None, vertices: np.ndarray, roots: np.ndarray, owner: np.ndarray, ends: np.ndarray,
                 bounds: Bounds | None, held: Labels, with_steps: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array | None]:
    """Which of the pairs have a path, and their costs, numbers of edges and, if they are asked for, steps.

    The ``roots`` that are searched from are sources and the ``ends`` targets; with ``turned``, the network with its edges turned
    round, the roots are targets and the ends sources.
    """
    size = len(vertices)
    ways = graph if turned is None else turned
    if bounds is None:
        dist, hops, _ = relaxed(ways, size, roots, owner, ends, held=held)
    else:
        dist, hops, _ = goal_directed(ways, size, roots, owner, ends, bounds, held)
    found = np.flatnonzero(dist[owner * size + ends] != held.far)
    owner, ends = owner[found], ends[found]
    whole, lengths = dist[owner * size + ends], hops[owner * size + ends].astype(np.int64)
    if not with_steps:
        held.clear(size)
        return found, whole, lengths, None
    if turned is None:
        pair, edge = read_back(graph, size, dist, hops, owner, ends)
        target, before = ends, dist[owner[pair] * size + graph.tails[edge]]
    else:
        pair, edge = _read_ahead_by_chunks(graph, size, dist, hops, owner, roots, ends)
        target, before = roots[owner], whole[pair] - dist[owner[pair] * size + graph.tails[edge]]
    held.clear(size)
    return found, whole, lengths, _listed_steps(graph, vertices, edge, before, target, whole, lengths)


# Whole costs: the cost and the number of edges of a path as one number.

# Labels for each root after which those with few ends are left to be guided by landmarks, and windows after which ends are looked at.
BUDGET = 400
LOOK_WINDOWS = 8
# Landmarks of a guide, of whose numbers so many guide one search.
GUIDES = 4
GUIDED_BY = 3
# Labels that are expanded at once, by how much they may be dearer than the least of their root, in widths of a window.
MARGIN = 1.0
# Keys of a block for each label that a block has of other costs.
KEYS_FOR_LABELS = 4
# Margins ahead up to which labels of a root are looked at in each turn.
HORIZON = 4
# Edges of a vertex that are read together as a row, rows of a vertex up to which each is gathered by itself, and windows ahead that are kept apart.
ROW_EDGES = 4
MASKED_ROWS = 8
WINDOWS_HELD = 15


class Keyed:
    """Edges of whole costs whose weight is ``cost << bits | 1``, so that sums of them order paths by cost and then by number of edges.

    ``bits`` hold the number of edges of any path. No weight is 0, also where costs are.
    """

    def __init__(self, graph: _Graph, size: int, like: Keyed | None = None):
        """``like`` are the keys of the same edges at other costs."""
        self.graph, self.size, self.bits = graph, size, size.bit_length()
        self.weights = (graph.costs.astype(np.int64) << self.bits) | 1
        # Within a window of the least weight no label improves another one, but cheap edges shall not make windows without number.
        self.width = max(int(self.weights.min()), int(self.weights.mean()) >> 2)
        # Edges by vertex in rows of a few, so that those of many vertices are read in one go; what is left of a row leads back at no use.
        if like is None:
            degree = np.diff(graph.leaving)
            self.rows = np.maximum(-(-degree // ROW_EDGES), 1)
            self.most_rows, self.first_row = int(self.rows.max(initial=0)), np.cumsum(self.rows) - self.rows
            self.place = np.arange(len(graph.tails)) - graph.leaving[graph.tails] + self.first_row[graph.tails] * ROW_EDGES
            heads = np.repeat(np.repeat(np.arange(size), self.rows), ROW_EDGES)
            heads[self.place] = graph.heads
            self.row_heads = heads.reshape(-1, ROW_EDGES)
        else:
            self.rows, self.most_rows, self.first_row = like.rows, like.most_rows, like.first_row
            self.place, self.row_heads = like.place, like.row_heads
        weights = np.full(self.row_heads.size, Keys.FAR, dtype=np.int64)
        weights[self.place] = self.weights
        self.row_weights = weights.reshape(-1, ROW_EDGES)

    @staticmethod
    def fits(costs: np.ndarray, size: int) -> bool:
        """Whether costs are whole and the weight of any path is far from the greatest number."""
        most = float(costs.max())
        whole = costs.dtype == np.int64 or most * size < EXACT and bool((costs == np.rint(costs)).all())
        return whole and (most + 1) * size * (1 << size.bit_length()) < 2.0 ** 61

    def cost_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.bits).astype(self.graph.costs.dtype)

    def hops_of(self, keys: np.ndarray) -> np.ndarray:
        return keys & ((1 << self.bits) - 1)


class _Part:
    """The costs or numbers of edges of keys, worked out where they are asked for."""

    def __init__(self, keys: np.ndarray, part):
        self.keys, self.part = keys, part

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        return self.part(self.keys[places])


class Keys:
    """Keys of the labels of a block, flat by (source, vertex), for block after block: only what was touched is cleared."""

    FAR = 1 << 62

    def __init__(self, number: int):
        self.keys = np.full(number, self.FAR, dtype=np.int64)
        self.touched: list[np.ndarray] = []

    def clear(self) -> None:
        for touched in self.touched:
            self.keys[touched] = self.FAR
        self.touched = []


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    new = np.ones(len(numbers), dtype=bool)
    np.not_equal(numbers[1:], numbers[:-1], out=new[1:])
    return numbers[new]


class _Windows:
    """Labels by the window they are due in, those far ahead in a heap of their own, which is dealt out when its first window is due."""

    def __init__(self):
        self.due, self.beyond, self.first_beyond = {}, [], None

    def put(self, window: int, labels: np.ndarray, keys: np.ndarray, windows: np.ndarray) -> None:
        """Add labels with their keys that are due in ``windows``, all after ``window`` or left out."""
        if not len(labels):
            return
        ahead = windows - window
        last = int(ahead.max())
        for step in range(1, min(last, WINDOWS_HELD) + 1):
            some = np.flatnonzero(ahead == step)
            if len(some):
                self.due.setdefault(window + step, []).append((labels.take(some), keys.take(some)))
        if last > WINDOWS_HELD:
            away = np.flatnonzero(ahead > WINDOWS_HELD)
            self.beyond.append((labels[away], keys[away], windows[away]))
            nearest = int(windows[away].min())
            self.first_beyond = nearest if self.first_beyond is None else min(self.first_beyond, nearest)

    def next(self, keys: np.ndarray) -> tuple[int, np.ndarray] | None:
        """The next window and its labels, without those that were reached at less since they were put."""
        while self.due or self.beyond:
            window = min(self.due, default=None)
            if self.beyond and (window is None or self.first_beyond <= window):
                labels, at, windows = (np.concatenate(part) for part in zip(*self.beyond))
                first, self.beyond, self.first_beyond = self.first_beyond, [], None
                self.put(first - 1, labels, at, windows)
                continue
            labels, at = (np.concatenate(part) for part in zip(*self.due.pop(window)))
            labels = _distinct(labels[keys.take(labels) == at])
            if len(labels):
                return window, labels
        return None


class Guide:
    """What is left to the ends at least, by a few landmarks: rows of numbers by vertex, whose differences are such bounds.

    A number is the key to a landmark, or that from it with its sign turned; where there is no path it is so great that a difference to it
    says that there is none, and a difference of two of them says nothing.
    """

    NONE = 1 << 60

    def __init__(self, ways: Keyed, turned: Keyed, landmarks: int):
        size, place, chosen, away = ways.size, 0, [], []
        nearest = np.full(size, self.NONE, dtype=np.int64)
        for number in range(landmarks + 1):
            keys = self._everywhere(ways, np.array([place]))[0]
            # The first search only leads to the vertex that is dearest to reach.
            if number or size == 1:
                chosen.append(place)
                away.append(keys)
                nearest = np.minimum(nearest, keys)
            seen = nearest if chosen else keys
            place = int(np.where(seen < self.NONE, seen, -1).argmax())
            if place in chosen:
                break
        if not chosen:
            chosen, away = [0], [self._everywhere(ways, np.array([0]))[0]]
        back = self._everywhere(turned, np.array(chosen))
        self.numbers = np.ascontiguousarray(np.concatenate([-np.array(away), back]).T)

    def _everywhere(self, ways: Keyed, roots: np.ndarray) -> np.ndarray:
        held = Keys(len(roots) * ways.size)
        owner, ends = np.divmod(np.arange(len(roots) * ways.size), ways.size)
        # Few roots have few labels in a window.
        settled_keys(ways, roots, owner, ends, held, widths=max(1, 16 // len(roots)))
        return np.minimum(held.keys, self.NONE).reshape(len(roots), ways.size)

    def turned(self) -> Guide:
        """The guide in the network with its edges turned round."""
        other = object.__new__(Guide)
        half = self.numbers.shape[1] // 2
        other.numbers = np.ascontiguousarray(-np.roll(self.numbers, half, axis=1))
        return other

    def towards(self, roots: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each root the numbers that say most about the way to its end, those of the end, the bound they give, and what the way costs at most."""
        here, there = self.numbers[roots], self.numbers[ends]
        best = np.argsort(there - here, axis=1)[:, :GUIDED_BY]
        at_end, half = np.take_along_axis(there, best, axis=1), self.numbers.shape[1] // 2
        start = np.maximum((np.take_along_axis(here, best, axis=1) - at_end).max(axis=1), 0)
        return best, at_end, start, np.minimum((here[:, half:] - there[:, :half]).min(axis=1), Keys.FAR)


def _expanded(ways: Keyed, keys: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offer the labels ``near`` to their neighbours, and return those that improved, maybe repeatedly, with their keys."""
    most_rows = ways.most_rows
    vertex = near % ways.size
    row, base, so_far = ways.first_row.take(vertex), near - vertex, keys.take(near)
    if most_rows > MASKED_ROWS:
        row, of = _spans(row, row + ways.rows.take(vertex))
        base, so_far = base.take(of), so_far.take(of)
    elif most_rows > 1:
        rows = ways.rows.take(vertex)
        more = [np.flatnonzero(rows > k) for k in range(1, most_rows)]
        of = np.concatenate([np.arange(len(row)), *more])
        row = np.concatenate([row, *[row.take(some) + k for k, some in enumerate(more, 1)]])
        base, so_far = base.take(of), so_far.take(of)
    label = ways.row_heads.take(row, axis=0)
    label += base[:, None]
    offer = ways.row_weights.take(row, axis=0)
    offer += so_far[:, None]
    label, offer = label.ravel(), offer.ravel()
    good = np.flatnonzero(offer < keys.take(label))
    label, offer = label.take(good), offer.take(good)
    np.minimum.at(keys, label, offer)
    kept = np.flatnonzero(offer == keys.take(label))
    label, offer = label.take(kept), offer.take(kept)
    return label, offer


def settled_keys(ways: Keyed, roots: np.ndarray, owner: np.ndarray, ends: np.ndarray, held: Keys, budget: int | None = None,
                 widths: int = 1) -> tuple[np.ndarray, int]:
    """Label ``held`` with the keys from each root until all ``ends`` it owns are final, and return how many labels were expanded.

    Labels are expanded in windows of growing keys, those of all roots together: what a window expands was not reached at less, so
    hardly any label is expanded twice. A root whose ends are all behind the window is done, and no label beyond its farthest end
    reached so far is expanded. Labels with a key up to that of the farthest end of their root are final.

    With a ``budget`` the search ends when so many labels for each root are expanded; the roots with ends ahead then come first in what is returned.
    """
    size, keys, width = ways.size, held.keys, ways.width * widths
    wanted = owner * size + ends
    limit = np.full(len(roots), held.FAR, dtype=np.int64)
    near = np.unique(owner)
    allowed = None if budget is None else budget * len(near)
    near = near * size + roots[near]
    keys[near] = 0
    held.touched.append(near)
    windows, window, expanded, looked, turn = _Windows(), 0, 0, 0, 0
    while True:
        # Ends behind the window are final. A root is limited by the farthest of its other ends, which may be unreached.
        turn += 1
        if len(wanted) <= 2 * len(near) or turn >= looked + LOOK_WINDOWS:
            looked, reached = turn, keys.take(wanted)
            ahead = reached >= window * width
            wanted, owner, reached = wanted[ahead], owner[ahead], reached[ahead]
            limit[:] = -1
            np.maximum.at(limit, owner, reached)
            if allowed is not None and expanded > allowed:
                return np.flatnonzero(limit >= 0), expanded
        near = near[keys.take(near) <= limit.take(near // size)]
        while len(near):
            expanded += len(near)
            label, offer = _expanded(ways, keys, near)
            held.touched.append(label)
            due = offer // width
            now = np.flatnonzero(due == window)
            near = _distinct(label.take(now)) if len(now) else label[:0]
            windows.put(window, label, offer, due)
        following = windows.next(keys)
        if following is None:
            return np.zeros(0, dtype=np.int64), expanded
        window, near = following


def guided_keys(ways: Keyed, roots: np.ndarray, ends: np.ndarray, held: Keys, guide: Guide) -> int:
    """As ``settled_keys`` for one end a root, labels on the way to it first.

    Each root expands, in each turn, those of its labels that with what is left to the end at least are hardly dearer than the least of
    them, as in a search by such sums. A root is done when the end costs less than all of them; labels whose sum is no more than the key of the end are final.
    """
    size, keys, margin = ways.size, held.keys, max(1, int(ways.width * MARGIN))
    wanted = np.arange(len(roots)) * size + ends
    best, at_end, start, limit = guide.towards(roots, ends)
    flat, columns = guide.numbers.ravel(), guide.numbers.shape[1]
    # No path where bounds say so.
    mine = np.flatnonzero(start < guide.NONE >> 1)
    label = mine * size + roots[mine]
    keys[label] = 0
    held.touched.append(label)
    # Labels that wait, with their keys, roots and sums: those up to the horizon of their root are looked at in each turn, others now and then.
    soon, later = (label, np.zeros(len(label), dtype=np.int64), mine, start[mine]), []
    turn = expanded = 0
    while True:
        look = turn % LOOK_WINDOWS == 0 or not len(soon[0])
        if look:
            soon, later = tuple(np.concatenate(parts) for parts in zip(soon, *later)), []
        label, key, mine, sums = soon
        if look:
            if not len(label):
                return expanded
            least = np.full(len(roots), held.FAR, dtype=np.int64)
            np.minimum.at(least, mine, sums)
            limit = np.minimum(limit, keys.take(wanted))
            limit[limit < least] = -1
            horizon = least + HORIZON * margin
        else:
            # A root without such labels waits for the next look.
            least = np.full(len(roots), held.FAR >> 1, dtype=np.int64)
            np.minimum.at(least, mine, sums)
        turn += 1
        edge = least + margin
        now = sums <= edge.take(mine)
        # What was reached at less, is dearer than the end by now, or belongs to a root that is done, goes.
        good = (sums <= limit.take(mine)) & (keys.take(label) == key)
        near = _distinct(label[now & good])
        expanded += len(near)
        fresh, offer = _expanded(ways, keys, near)
        held.touched.append(fresh)
        owner = fresh // size
        vertex = (fresh - owner * size) * columns
        left = np.zeros(len(fresh), dtype=np.int64)
        for k in range(best.shape[1]):
            np.maximum(left, flat.take(vertex + best[:, k].take(owner)) - at_end[:, k].take(owner), out=left)
        left += offer
        # A pair costs no more than by way of a landmark.
        useful = left <= limit.take(owner)
        far = left > horizon.take(owner)
        here, there = np.flatnonzero(useful & ~far), np.flatnonzero(useful & far)
        stays = good & ~now
        if look:
            distant = sums > horizon.take(mine)
            away = np.flatnonzero(stays & distant)
            later.append(tuple(part.take(away) for part in soon))
            stays &= ~distant
        stays = np.flatnonzero(stays)
        made = fresh, offer, owner, left
        soon = tuple(np.concatenate([part.take(stays), new.take(here)]) for part, new in zip(soon, made))
        later.append(tuple(new.take(there) for new in made))


def _walked(ways: Keyed, held: Keys, owner: np.ndarray, ends: np.ndarray, entering: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges of the paths from the ends to their roots, by (pair, place from the end), and the pairs that met a choice.

    With ``entering`` over tight edges into the vertices, of which the one with the smallest id is taken; else over those out of them,
    for keys that were made against the edges, where pairs that meet several of them stop.
    """
    graph, size, keys = ways.graph, ways.size, held.keys
    first, order, near_end = ((graph.entering, graph.by_head, graph.tails) if entering else (graph.leaving, None, graph.heads))
    walkers, here = np.arange(len(owner)), owner * size + ends
    pairs, places, taken, torn, place = [], [], [], [], 0
    while True:
        at = keys[here]
        moving = np.flatnonzero(at)
        walkers, here, at = walkers[moving], here[moving], at[moving]
        if not len(walkers):
            break
        vertex = here % size
        edge, walker = _spans(first[vertex], first[vertex + 1])
        edge = edge if order is None else order[edge]
        label = (here - vertex)[walker] + near_end[edge]
        tight = np.flatnonzero(keys[label] + ways.weights[edge] == at[walker])
        edge, walker, label = edge[tight], walker[tight], label[tight]
        again = walker[1:] == walker[:-1]
        if again.any():
            if not entering:
                alone = ~np.isin(np.arange(len(walkers)), walker[1:][again])
                torn.append(walkers[~alone])
                kept = alone[walker]
                edge, label, walkers = edge[kept], label[kept], walkers[alone]
            else:
                kept = np.concatenate([[True], ~again])
                edge, label = edge[kept], label[kept]
        pairs.append(walkers)
        places.append(np.full(len(walkers), place))
        taken.append(edge)
        here, place = label, place + 1
    nothing = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([nothing, *parts]) for parts in (pairs, places, taken, torn))


def _steps_from_source(ways: Keyed, held: Keys, owner: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``read_back``, of keys."""
    pair, place, edge, _ = _walked(ways, held, owner, targets, True)
    # From the root on: walked last, first.
    order = np.lexsort((-place, pair))
    return pair[order], edge[order]


def _steps_to_target(ways: Keyed, turned: Keyed, held: Keys, owner: np.ndarray, roots: np.ndarray,
                     starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``read_ahead``, of keys made against the edges: most pairs have one path only, others are read with their choices."""
    pair, place, edge, torn = _walked(ways, held, owner, starts, False)
    if len(torn):
        kept = ~np.isin(pair, torn)
        pair, place, edge = pair[kept], place[kept], edge[kept]
        torn = np.sort(torn)
        some, theirs = _read_ahead_by_chunks(ways.graph, ways.size, _Part(held.keys, ways.cost_of), _Part(held.keys, ways.hops_of),
                                             owner[torn], roots, starts[torn])
        pair, edge = np.concatenate([pair, torn[some]]), np.concatenate([edge, theirs])
        place = np.concatenate([place, np.arange(len(some))])
    order = np.lexsort((place, pair))
    return pair[order], edge[order]


# Edges in packs.

def _narrow(numbers: np.ndarray) -> pa.Array:
    """Whole numbers in the narrowest type that holds them all; others as they are."""
    if numbers.dtype.kind == "f":
        if not len(numbers) or not (np.abs(numbers) < 2.0 ** 53).all() or (numbers != np.rint(numbers)).any():
            return pa.array(numbers)
        numbers = numbers.astype(np.int64)
    low, high = int(numbers.min(initial=0)), int(numbers.max(initial=0))
    fits = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return pa.array(numbers.astype(fits))


def _pack(ids: np.ndarray, tails: np.ndarray, heads: np.ndarray, costs: np.ndarray) -> bytes:
    """Edges as one compressed record batch; ids and sources as differences, which are small in most tables."""
    batch = pa.record_batch([_narrow(np.diff(ids, prepend=np.int64(0))), _narrow(np.diff(tails, prepend=np.int64(0))),
                             _narrow(heads - tails), _narrow(costs)], names=["id", "source", "target", "cost"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(packs: pa.ChunkedArray, summed_as: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, tails, heads, costs = [], [], [], []
    for pack in packs:
        batch = pa.ipc.open_stream(pack.as_buffer()).read_next_batch()
        ids.append(np.cumsum(batch.column(0).to_numpy(), dtype=np.int64))
        tails.append(np.cumsum(batch.column(1).to_numpy(), dtype=np.int64))
        heads.append(tails[-1] + batch.column(2).to_numpy())
        costs.append(batch.column(3).to_numpy().astype(summed_as))
    return tuple(np.concatenate(column) for column in (ids, tails, heads, costs))


def _packer(cost_type: T.DataType):
    summed_as, _ = SUMMED_AS[type(cost_type)]

    def packs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        profiles = table.column("profile").combine_chunks().dictionary_encode()
        codes = profiles.indices.to_numpy()
        columns = [_numpy(table, "edge_id"), _numpy(table, "edge_source"), _numpy(table, "edge_target"),
                   _numpy(table, "edge_cost", summed_as)]
        # A table stored by profile is in order already.
        if (np.diff(codes) < 0).any():
            order = np.argsort(codes.astype(np.uint16) if len(profiles.dictionary) < 1 << 16 else codes, kind="stable")
            codes, columns = codes[order], [column[order] for column in columns]
        cuts = np.searchsorted(codes, np.arange(len(profiles.dictionary) + 1))
        # A pack at a time, so that no message holds very many.
        for code, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            yield pa.record_batch([profiles.dictionary.slice(code, 1), pa.array([_pack(*[column[low:high] for column in columns])])],
                                  names=["profile", "edges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield from packs(held)
                held, rows = [], 0
        if held:
            yield from packs(held)

    return run


def packed_edges(costed: DataFrame, cost_type: T.DataType) -> DataFrame:
    """Costed edges (profile, edge_id, edge_source, edge_target, edge_cost) as (profile, edges): a few packs a profile.

    Every task packs its rows by profile, ``PACK_ROWS`` of them at a time, so what is shuffled is a few bytes an edge.
    """
    schema = T.StructType([costed.schema["profile"], T.StructField("edges", T.BinaryType())])
    return costed.select("profile", *EDGE).mapInArrow(_packer(cost_type), schema)


def _numpy(table: pa.Table, name: str, dtype: type | None = None) -> np.ndarray:
    column = table.column(name).to_numpy()
    return column if dtype is None else column.astype(dtype)


def _checked(costs: np.ndarray, size: int) -> np.ndarray:
    if costs.dtype == np.float64:
        if not np.isfinite(costs).all():
            raise ValueError(NOT_FINITE.partition(": ")[2])
    elif float(costs.max()) * size >= EXACT:
        raise OverflowError(NOT_EXACT.partition(": ")[2])
    return costs


def _backward(source: np.ndarray, target: np.ndarray, costs: np.ndarray, size: int) -> np.ndarray:
    """Which pairs are searched from their targets: those whose target has more pairs than their source has.

    Costs that round add up otherwise from the other end; they are searched from the sources.
    """
    if costs.dtype == np.float64 and ((costs != np.rint(costs)).any() or float(costs.max()) * size >= 2.0 ** 53):
        return np.zeros(len(source), dtype=bool)
    return np.bincount(target, minlength=size)[target] > np.bincount(source, minlength=size)[source]


def _bounded(roots: np.ndarray) -> int:
    """How many roots have so few ends that bounds are asked for each of them."""
    return int((np.unique(roots, return_counts=True)[1] <= GOALS).sum())


def _edge_arrays(edges: pa.Table, summed_as: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sources, targets and costs of edges that come in packs or as they are."""
    if "edges" in edges.column_names:
        return _unpacked(edges.column("edges"), summed_as)
    return (_numpy(edges, "edge_id"), _numpy(edges, "edge_source"), _numpy(edges, "edge_target"), _numpy(edges, "edge_cost", summed_as))


class _Network:
    """Edges without their costs, put in order once for all groups of a task that have the same ones, as those of bins mostly do."""

    def __init__(self, ids: np.ndarray, tails: np.ndarray, heads: np.ndarray):
        self.given = ids, tails, heads
        self.vertices = np.unique(np.concatenate([tails, heads]))
        self.size = len(self.vertices)
        self.ends = np.searchsorted(self.vertices, tails), np.searchsorted(self.vertices, heads)
        self.ordered: dict[bool, tuple[np.ndarray, _Graph]] = {}
        self.keyed_before: dict[bool, Keyed] = {}

    def has(self, *edges: np.ndarray) -> bool:
        return all(np.array_equal(mine, theirs) for mine, theirs in zip(self.given, edges, strict=True))

    def graph(self, costs: np.ndarray, turned: bool) -> _Graph:
        """The edges at ``costs``, or turned round."""
        if turned not in self.ordered:
            ids, (tails, heads) = self.given[0], self.ends[::-1] if turned else self.ends
            self.ordered[turned] = np.lexsort((ids, tails)), _Graph.of(ids, tails, heads, costs, self.size)
        order, graph = self.ordered[turned]
        return replace(graph, costs=costs[order])

    def keyed(self, costs: np.ndarray, turned: bool) -> Keyed:
        made = Keyed(self.graph(costs, turned), self.size, self.keyed_before.get(turned))
        self.keyed_before[turned] = made
        return made


def _solver(cost_type: T.DataType, columns: list[str], with_steps: bool):
    """The search of a group: its rows with ``columns``, those that have a path, with its cost and number of edges or its steps."""
    summed_as, cost = SUMMED_AS[type(cost_type)]
    step = pa.struct([("path_seq", pa.int32()), ("node", pa.int64()), ("edge", pa.int64()), ("cost", cost), ("agg_cost", cost)])
    result = [("steps", pa.list_(step))] if with_steps else [("dist", cost), ("hops", pa.int32())]

    def run(rows: pa.Table, edges: pa.Table) -> pa.Table:
        schema = pa.schema([*[rows.schema.field(name) for name in columns], *[pa.field(*named) for named in result],
                            pa.field("error", pa.string())])
        if not rows.num_rows or not edges.num_rows:
            return schema.empty_table()
        try:
            return solved(rows, edges, schema)
        except (ArithmeticError, ValueError) as error:
            last.clear()
            # One network that cannot be searched costs its own profile only.
            known = {"profile": rows.column("profile").slice(0, 1).to_pylist(), "error": [f"{type(error).__name__}: {error}"]}
            return pa.table([pa.array(known.get(field.name, [None]), field.type) for field in schema],
                            schema=pa.schema([field.with_nullable(True) for field in schema]))

    # What the groups of a task hand on: the edges of the last one, and the keys, which are cleared.
    last: dict[str, _Network | Keys] = {}

    def keys_for(number: int) -> Keys:
        if "keys" not in last or len(last["keys"].keys) < number:
            last["keys"] = Keys(number)
        return last["keys"]

    def solved(rows: pa.Table, edges: pa.Table, schema: pa.Schema) -> pa.Table:
        *ends, costs = _edge_arrays(edges, summed_as)
        if "network" not in last or not last["network"].has(*ends):
            last["network"] = _Network(*ends)
        network = last["network"]
        vertices, size = network.vertices, network.size
        costs = _checked(costs, size)
        graph = network.graph(costs, False)
        source, target = _numpy(rows, "source"), _numpy(rows, "target")
        known = np.flatnonzero(np.isin(source, vertices) & np.isin(target, vertices))
        source, target = np.searchsorted(vertices, source[known]), np.searchsorted(vertices, target[known])
        # Nothing leaves some vertices and nothing enters others: no path starts or ends there.
        open_ = (graph.leaving[source] < graph.leaving[source + 1]) & (graph.entering[target] < graph.entering[target + 1])
        known, source, target = known[open_], source[open_], target[open_]
        # A pair of several rows is searched once.
        pairs, pair_of = np.unique(source * size + target, return_inverse=True)
        known = known[np.argsort(pair_of, kind="stable")]
        first_row = np.concatenate([[0], np.cumsum(np.bincount(pair_of, minlength=len(pairs)))])
        source, target = np.divmod(pairs, size)
        backward = _backward(source, target, costs, size)
        bounds, turned, keyed = None, None, Keyed.fits(costs, size)
        if backward.any():
            turned = network.graph(costs, True)
        if not keyed and _bounded(source[~backward]) + _bounded(target[backward]) >= BOUNDED_SOURCES:
            bounds = Bounds.of(graph, size)
        ways, ways_back, guide = network.keyed(costs, False) if keyed else None, network.keyed(costs, True) if keyed else None, None
        parts = []

        def note(found: np.ndarray, dist: np.ndarray, hops: np.ndarray, steps: pa.Array | None) -> None:
            place, pair = _spans(first_row[found], first_row[found + 1])
            met = rows.take(pa.array(known[place]))
            made = [steps.take(pa.array(pair))] if with_steps else [pa.array(dist[pair]), pa.array(hops[pair], pa.int32())]
            parts.append(pa.Table.from_arrays([*[met.column(name) for name in columns], *made, pa.nulls(met.num_rows, pa.string())],
                                              schema.names).cast(schema))

        for against, mine, root, end in ((None, ~backward, source, target), (turned, backward, target, source)):
            order = np.flatnonzero(mine)
            order = order[np.lexsort((end[order], root[order]))]
            at, owner, goals = np.unique(root[order], return_inverse=True, return_counts=True)
            if not len(at):
                continue
            # Keys need no second array, and pay off by the block.
            per_block = max(1, min(len(order), (KEYS_FOR_LABELS if keyed else 1) * BLOCK_LABELS // size))
            first_end = np.concatenate([[0], np.cumsum(goals)])
            if keyed:
                held, against_keyed = keys_for(per_block * size), None if against is None else ways_back

                def search(some_roots: np.ndarray, some_owner: np.ndarray, some: np.ndarray, budget: int | None, guide: Guide | None) -> np.ndarray:
                    """Note the paths of some pairs, and return which roots are left for later."""
                    left, (found, *made) = _block_paths_keyed(ways, against_keyed, vertices, some_roots, some_owner, end[some], held, with_steps,
                                                              budget, guide)
                    note(some[found], *made)
                    return left

                # Roots with many ends have some far away; others may be near their ends.
                busy, waiting, far = np.flatnonzero(goals > GOALS), np.flatnonzero(goals <= GOALS), []
                for some, budget in ((busy, None), (waiting, BUDGET)):
                    for first in range(0, len(some), per_block):
                        block = some[first: first + per_block]
                        place, mine_of = _spans(first_end[block], first_end[block + 1])
                        far.append(block[search(at[block], mine_of, order[place], budget, None)])
                far = np.concatenate([np.zeros(0, dtype=np.int64), *far])
                place, mine_of = _spans(first_end[far], first_end[far + 1])
                far_order = order[place]
                if len(far) < BOUNDED_SOURCES:
                    for first in range(0, len(far), per_block):
                        low, high = np.searchsorted(mine_of, [first, first + per_block])
                        search(at[far[first: first + per_block]], mine_of[low:high] - first, far_order[low:high], None, None)
                else:
                    # A search for each pair.
                    if guide is None:
                        guide = Guide(ways, ways_back, GUIDES)
                    mine_guide = guide if against is None else guide.turned()
                    for first in range(0, len(far_order), per_block):
                        some = far_order[first: first + per_block]
                        search(root[some], np.arange(len(some)), some, None, mine_guide)
                continue
            held = Labels(per_block * size, costs.dtype)
            known_bounds = bounds if against is None or bounds is None else bounds.turned()
            for first in range(0, len(at), per_block):
                low, high = first_end[[first, min(first + per_block, len(at))]]
                found, *made = _block_paths(graph, against, vertices, at[first: first + per_block], owner[low:high] - first,
                                            end[order[low:high]], known_bounds, held, with_steps)
                note(order[low:high][found], *made)
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return run


def parts_of_profiles(pairs: DataFrame) -> DataFrame:
    """(profile, parts, hot), a row per profile: into how many parts its sources are dealt, and those of them with very many rows."""
    counted = checkpointed(pairs.groupBy("profile", "source").count().groupBy("profile").agg(
        F.count("*").alias("sources"), F.sum("count").alias("pairs"),
        F.collect_list(F.when(F.col("count") > PAIRS_PER_PART, F.col("source"))).alias("hot")))
    everything = counted.agg(F.sum("pairs")).first()[0] or 1
    busy = PARTS_PER_SLOT * pairs.sparkSession.sparkContext.defaultParallelism
    wanted = F.ceil(F.col("pairs") * busy / everything)
    by_source = F.least(F.ceil(F.col("sources") / SOURCES_PER_PART), wanted)
    return checkpointed(counted.select("profile", F.greatest(by_source, F.ceil(F.col("pairs") / PAIRS_PER_PART)).cast("int").alias("parts"), "hot"))


def _dealt(rows: DataFrame, per_profile: DataFrame) -> DataFrame:
    """``rows`` with their ``part``, that of their source; a source with very many rows is dealt over all parts of its profile."""
    keys = rows.columns
    marked = rows.join(broadcast_if_small(per_profile), "profile")
    dealt_by = F.xxhash64("source")
    if "hot" in per_profile.columns:
        dealt_by = F.when(F.array_contains("hot", F.col("source")), F.xxhash64(*keys)).otherwise(dealt_by)
    return marked.select(*keys, F.pmod(dealt_by, F.col("parts")).cast("int").alias("part"))


def paths_in_tasks(rows: DataFrame, network: TimedNetwork, cost_type: T.DataType, with_steps: bool,
                   per_profile: DataFrame | None = None) -> DataFrame:
    """``rows`` (profile, source, target and any others) that have a path, with its ``steps`` or with ``dist`` and ``hops``, and ``error``.

    Nothing is stored: what a task finds goes straight on, so rows that shall have their paths are best brought along. A pair
    of several rows is searched once in a part. ``per_profile`` are the parts of the rows, if they are known.

    A profile whose costs are no numbers, or too large to be added exactly, has one row or more with the ``error`` and no pair.
    A profile's sources are dealt into parts, and each part meets the edges of its profile. A profile has no more parts than
    its share of the pairs asks for to keep all tasks busy, or their number to fit a task, so there are hardly more copies of
    networks than profiles, however many sources there are; a profile with most of the pairs still spreads over tasks. Static edges are
    broadcast and costed in the tasks of the parts; those of a table of snapshots are packed and sent to them. Of a table of
    snapshots that is dealt out by profile the edges stay where they are, and the rows of profiles with one part go to them. A
    vertex id is a long.
    """
    rows = rows.withColumns({name: F.col(name).cast("long") for name in PAIR[1:]})
    per_profile = parts_of_profiles(rows) if per_profile is None else per_profile
    solver, schema = _solver(cost_type, rows.columns, with_steps), _solved_schema(rows, cost_type, with_steps)
    if network.cost is not None:
        return _met_in_place(rows, per_profile, network).applyInArrow(solver, schema)
    if not network.by_profile:
        return _met_by_packs(rows, per_profile, network, cost_type).applyInArrow(solver, schema)
    alone, shared = per_profile.filter("parts = 1").select("profile"), per_profile.filter("parts > 1")
    # Renamed, so that rows that were drawn from the network share no column with it.
    costed = network.for_profiles(alone).toDF("edge_profile", *EDGE).select(F.col("edge_profile").alias("profile"), *EDGE)
    met = rows.join(broadcast_if_small(alone), "profile", "left_semi").groupBy("profile").cogroup(costed.groupBy("profile"))
    found = met.applyInArrow(solver, schema)
    if shared.isEmpty():
        return found
    theirs = rows.join(broadcast_if_small(shared), "profile", "left_semi")
    return found.unionByName(_met_by_packs(theirs, shared, network, cost_type).applyInArrow(solver, schema))


def _search_tasks(spark: SparkSession) -> int:
    """Tasks of a search. Their number is given, since adaptive execution would put together what is small but takes long to search."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTS_PER_SLOT * spark.sparkContext.defaultParallelism)


def _part_keys(per_profile: DataFrame) -> DataFrame:
    return per_profile.select("profile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))


def _met_in_place(rows: DataFrame, per_profile: DataFrame, network: TimedNetwork):
    """Rows and static edges by profile and part: the edges are costed for each part in its own task.

    The parts are few rows, stored as they are dealt out and sorted, so that their edges need neither be shuffled nor sorted.
    Of a plan that adapts a checkpoint does not note how its rows are dealt out.
    """
    spark = rows.sparkSession
    tasks = _search_tasks(spark)
    with session_conf(spark, **{"spark.sql.adaptive.enabled": "false"}):
        keys = checkpointed(_part_keys(per_profile).repartition(tasks, "profile", "part").sortWithinPartitions("profile", "part"))
    dealt = _dealt(rows, per_profile).repartition(tasks, "profile", "part")
    # Renamed, so that the two sides share no column.
    costed = network.beside(keys).toDF("edge_profile", "edge_part", *EDGE).withColumnsRenamed({"edge_profile": "profile", "edge_part": "part"})
    return dealt.groupBy("profile", "part").cogroup(costed.groupBy("profile", "part"))


def _met_by_packs(rows: DataFrame, per_profile: DataFrame, network: TimedNetwork, cost_type: T.DataType):
    """Rows and packed edges by profile and part: packed once, then copied to the parts."""
    tasks, keys = _search_tasks(rows.sparkSession), _part_keys(per_profile)
    packs = packed_edges(network.for_profiles(per_profile.select("profile")), cost_type).join(broadcast_if_small(keys), "profile")
    dealt = _dealt(rows, per_profile).repartition(tasks, "profile", "part")
    return dealt.groupBy("profile", "part").cogroup(packs.repartition(tasks, "profile", "part").groupBy("profile", "part"))


def _solved_schema(rows: DataFrame, cost_type: T.DataType, with_steps: bool) -> T.StructType:
    step = T.StructType([T.StructField("path_seq", T.IntegerType()), T.StructField("node", T.LongType()),
                         T.StructField("edge", T.LongType()), T.StructField("cost", cost_type), T.StructField("agg_cost", cost_type)])
    made = ([T.StructField("steps", T.ArrayType(step))] if with_steps
            else [T.StructField("dist", cost_type), T.StructField("hops", T.IntegerType())])
    return T.StructType([*[T.StructField(field.name, field.dataType) for field in rows.schema], *made,
                         T.StructField("error", T.StringType())])
