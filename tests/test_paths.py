"""The path search against a heap-based solver on small networks."""

import heapq
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.operators import paths, relax
from odflow.operators.overlay import components, contracted, overlay_edges
from odflow.operators.paths import path_rows, search
from odflow.runtime import checkpointed, stored
from odflow.sources.network import TimedNetwork


def solve(edges, source):
    """(dist, hops) of every vertex, fewest edges among equals."""
    out = defaultdict(list)
    for _, a, b, cost in edges:
        if cost is not None and cost >= 0:
            out[a].append((b, cost))
    best, heap = {}, [(0, 0, source)]
    while heap:
        dist, hops, node = heapq.heappop(heap)
        if node in best:
            continue
        best[node] = (dist, hops)
        for other, cost in out[node]:
            if other not in best:
                heapq.heappush(heap, (dist + cost, hops + 1, other))
    return best


def run(spark, edges, pairs, kind="long", **options):
    costed = spark.createDataFrame([(p, *e) for p, es in edges.items() for e in es],
                                   f"profile int, id long, source long, target long, cost {kind}")
    wanted = spark.createDataFrame(pairs, "profile int, source long, target long")
    result = search(wanted, TimedNetwork(costed), **options)
    found = {(r.profile, r.source, r.target): (r.dist, r.hops) for r in result.found.collect()}
    paths = defaultdict(list)
    for r in sorted(path_rows(result).collect(), key=lambda r: r.path_seq):
        paths[(r.profile, r.start_vid, r.end_vid)].append(r)
    return found, paths


def check(edges, pairs, found, paths):
    truth = {(p, s): solve(edges[p], s) for p, s, _ in pairs}
    assert found == {(p, s, t): truth[(p, s)][t] for p, s, t in pairs if t in truth[(p, s)]}
    assert set(paths) == set(found)
    for (profile, source, target), rows in paths.items():
        dist, hops = found[(profile, source, target)]
        by_id = {e[0]: e for e in edges[profile]}
        assert [r.path_seq for r in rows] == list(range(1, hops + 2))
        assert rows[0].node == source and rows[-1].node == target
        assert (rows[-1].edge, rows[-1].cost, rows[-1].agg_cost) == (-1, 0, dist)
        assert rows[0].agg_cost == 0
        for here, after in zip(rows, rows[1:]):
            _, a, b, cost = by_id[here.edge]
            assert (a, b, cost) == (here.node, after.node, here.cost)
            assert after.agg_cost == here.agg_cost + here.cost
            # Of the edges that would do as well, the smallest id.
            labels = truth_labels = solve(edges[profile], source)
            tight = [e[0] for e in edges[profile] if e[2] == after.node and e[3] is not None and e[3] >= 0
                     and e[1] in labels and labels[e[1]][0] + e[3] == truth_labels[after.node][0]
                     and labels[e[1]][1] + 1 == truth_labels[after.node][1]]
            assert here.edge == min(tight)


def grid(rng, cost):
    edges, size = [], 7
    for v in range(size * size):
        for step, fits in ((1, v % size < size - 1), (-1, v % size > 0), (size, True), (-size, True)):
            if fits and 0 <= v + step < size * size:
                edges.append((len(edges), v, v + step, cost(rng)))
    return edges


# In tasks, by rounds with the network broadcast, and by rounds with every join shuffled.
WAYS = [{}, {"task_edges": 0}, {"task_edges": 0, "broadcast_rows": 0}]


@pytest.mark.parametrize("options", WAYS)
def test_whole_costs_with_free_and_closed_edges(spark, options):
    rng = random.Random(1)
    edges = {p: grid(rng, lambda r: r.choice([0, 0, 1, 2, 5, 9, -1, None])) for p in (0, 1)}
    # A hub with many targets, and pairs all over.
    pairs = {(0, 3, t) for t in range(49) if t != 3} | {(rng.randrange(2), rng.randrange(49), 24) for _ in range(20)}
    pairs = sorted(p for p in pairs if p[1] != p[2])
    check(edges, pairs, *run(spark, edges, pairs, **options))


@pytest.mark.parametrize("options", WAYS[:2])
def test_fractional_costs(spark, options):
    rng = random.Random(2)
    edges = {0: grid(rng, lambda r: r.uniform(0.1, 3))}
    pairs = sorted({(0, rng.randrange(24), rng.randrange(24, 49)) for _ in range(25)})
    check(edges, pairs, *run(spark, edges, pairs, kind="double", **options))


@pytest.mark.parametrize("options", WAYS[:2])
def test_unreachable_and_no_pairs(spark, options):
    edges = {0: [(1, 1, 2, 5), (2, 3, 1, 5)]}
    found, paths = run(spark, edges, [(0, 1, 3), (0, 1, 2), (0, 9, 1)], **options)
    assert found == {(0, 1, 2): (5, 1)} and list(paths) == [(0, 1, 2)]
    found, paths = run(spark, edges, [], **options)
    assert found == {} and not paths


def test_session_options_are_put_back(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    run(spark, {0: [(1, 1, 2, 5)]}, [(0, 1, 2)])
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_cost_rule(spark):
    edges = spark.createDataFrame([(1, 1, 2, 10), (2, 1, 3, 1), (3, 3, 2, 1)], "id long, source long, target long, base long")
    network = TimedNetwork(edges, cost=lambda profile, edge: edge("base") + profile * (edge("id") - 1))
    pairs = spark.createDataFrame([(0, 1, 2), (9, 1, 2)], "profile long, source long, target long")
    assert {(r.profile, r.dist, r.hops) for r in search(pairs, network).found.collect()} == {(0, 2, 2), (9, 10, 1)}
    assert search(pairs, network).found.filter(F.col("dist") < 0).isEmpty()


def test_a_long_chain_has_few_runs(spark, monkeypatch):
    """A path of 60 edges, as of a street network without short cuts."""
    edges = spark.createDataFrame([(0, k, k, k + 1, 1) for k in range(60)], "profile int, id long, source long, target long, cost long")
    pairs = spark.createDataFrame([(0, 0, 60), (0, 5, 7), (0, 3, 0), (0, 0, 99), (0, 99, 3)], "profile int, source long, target long")
    made = []
    add = paths._add_run
    monkeypatch.setattr(paths, "_add_run", lambda runs, *rest: (add(runs, *rest), made.append(len(runs))))
    # By rounds, with the whole chain as it is, after contraction, and in tasks.
    monkeypatch.setattr(paths, "contracted", lambda edges, kept: checkpointed(edges))
    for options in ({"task_edges": 0}, {"task_edges": 0}, {}):
        found = paths.search(pairs, TimedNetwork(edges), **options)
        assert max(made) <= 5
        assert {(r.source, r.target): r.dist for r in found.found.collect()} == {(0, 60): 60, (5, 7): 2}
        steps = {(r.source, r.target): [s.node for s in r.steps] for r in paths.pair_paths(found).collect()}
        assert steps == {(0, 60): list(range(61)), (5, 7): [5, 6, 7]}
        monkeypatch.setattr(paths, "contracted", contracted)


@pytest.mark.parametrize("options", WAYS[:2])
def test_a_chain_of_300_edges(spark, options):
    rng = random.Random(3)
    edges = {0: [(k, k, k + 1, rng.randrange(9)) for k in range(300)] + [(300 + k, k + 1, k, 1) for k in range(300)]}
    pairs = [(0, 0, 300), (0, 300, 0), (0, 17, 203), (0, 203, 202)]
    check(edges, pairs, *run(spark, edges, pairs, **options))


def test_contraction_keeps_paths_and_their_choice(spark):
    """Two profiles of a grid with many ties; only the ends of the pairs stay."""
    rng = random.Random(6)
    edges = {p: grid(rng, lambda r: r.choice([0, 1, 1, 2])) for p in (0, 1)}
    costed = spark.createDataFrame([(p, *e) for p, es in edges.items() for e in es], "profile int, id long, source long, target long, cost long")
    kept = spark.createDataFrame([(0, 3), (0, 45), (1, 24)], "profile int, node long")
    left = contracted(overlay_edges(costed), kept).collect()
    vertices = {(r.profile, v) for r in left for v in (r.source, r.target)}
    assert {(0, 3), (0, 45), (1, 24)} <= vertices and len(vertices) < 80
    for r in left:
        by_id = {e[0]: e for e in edges[r.profile]}
        path = [by_id[s.edge] for s in reversed(r.steps)]
        assert path[0][1] == r.source and path[-1][2] == r.target and len(path) == r.hops
        assert sum(e[3] for e in path) == r.cost and all(a[2] == b[1] for a, b in zip(path, path[1:]))
    truth = solve(edges[0], 3)[45]
    assert solve([(k, r.source, r.target, r.cost) for k, r in enumerate(left) if r.profile == 0], 3)[45][0] == truth[0]


def test_pairs_of_other_components_are_dropped(spark):
    rows = [(0, 1, 2), (0, 2, 3), (0, 10, 11), (0, 12, 11), (1, 1, 10)] + [(0, k, k + 1) for k in range(100, 140)]
    edges = spark.createDataFrame(rows, "profile int, source long, target long")
    labels = {(r.profile, r.node): r.component for r in components(edges).collect()}
    assert labels == {**{(0, k): 1 for k in (1, 2, 3)}, **{(0, k): 10 for k in (10, 11, 12)}, (1, 1): 1, (1, 10): 1,
                      **{(0, k): 100 for k in range(100, 141)}}
    pairs = spark.createDataFrame([(0, 1, 3), (0, 1, 11), (0, 3, 1), (0, 10, 12), (0, 12, 11), (0, 100, 140), (0, 1, 99)],
                                  "profile int, source long, target long")
    kept = {tuple(r) for r in paths.connected_pairs(pairs, edges, 1000).collect()}
    # Nothing leaves 3 and nothing enters 12 or 1.
    assert kept == {(0, 1, 3), (0, 12, 11), (0, 100, 140)}


def test_a_source_with_many_blocks_of_labels(spark, monkeypatch):
    rng = random.Random(4)
    edges = {p: grid(rng, lambda r: r.choice([0, 1, 2, 5])) for p in (0, 1)}
    pairs = sorted({(rng.randrange(2), rng.randrange(49), rng.randrange(49)) for _ in range(300)})
    pairs = [p for p in pairs if p[1] != p[2]]
    monkeypatch.setattr(relax, "BLOCK_LABELS", 100)
    monkeypatch.setattr(relax, "SOURCES_PER_PART", 7)
    check(edges, pairs, *run(spark, edges, pairs))


@pytest.mark.parametrize("seed", range(12))
def test_bounds_change_no_path(seed):
    """With landmarks and without: the same costs, numbers of edges and edges, ties and unreachable targets included."""
    rng = random.Random(seed)
    size = 80
    costs = [0, 1, 1, 2, 7] if seed % 2 else [rng.uniform(0, 3) for _ in range(40)]
    rows = [(k, rng.randrange(size), rng.randrange(size), rng.choice(costs)) for k in range(rng.choice([90, 200, 400]))]
    ids, tails, heads, cost = (np.array(column) for column in zip(*rows))
    graph = relax._Graph.of(ids, tails, heads, cost.astype(np.int64 if seed % 2 else np.float64), size)
    sources = np.array(sorted(rng.sample(range(size), 30)))
    pairs = sorted({(rng.randrange(30), rng.randrange(size)) for _ in range(120)} | {(4, t) for t in range(size)})
    owner, targets = (np.array(column) for column in zip(*[(o, t) for o, t in pairs + [(o, 0) for o in range(30)]]))
    order = np.argsort(owner, kind="stable")
    owner, targets = owner[order], targets[order]
    wanted = owner * size + targets
    plain, hops, _ = relax.relaxed(graph, size, sources, owner, targets)
    quick, quick_hops, _ = relax.goal_directed(graph, size, sources, owner, targets, relax.Bounds.of(graph, size))
    assert (plain[wanted] == quick[wanted]).all()
    reached = plain[wanted] < 1 << 60
    assert (hops[wanted] == quick_hops[wanted])[reached].all()
    one = relax.read_back(graph, size, plain, hops, owner[reached], targets[reached])
    two = relax.read_back(graph, size, quick, quick_hops, owner[reached], targets[reached])
    assert all((a == b).all() for a, b in zip(one, two))


def test_bounds_save_most_labels():
    size, rows = 900, []
    for v in range(size):
        for step, fits in ((1, v % 30 < 29), (-1, v % 30 > 0), (30, True), (-30, True)):
            if fits and 0 <= v + step < size:
                rows.append((len(rows), v, v + step, 1000 + len(rows) * 7919 % 997))
    ids, tails, heads, cost = (np.array(column) for column in zip(*rows))
    graph = relax._Graph.of(ids, tails, heads, cost, size)
    sources, targets = np.arange(0, 800, 25), np.arange(0, 800, 25) + 63
    owner = np.arange(len(sources))
    _, _, labels = relax.relaxed(graph, size, sources, owner, targets)
    _, _, fewer = relax.goal_directed(graph, size, sources, owner, targets, relax.Bounds.of(graph, size))
    assert fewer < labels / 2


@pytest.mark.parametrize("seed", range(8))
def test_paths_searched_from_the_target_are_the_same(seed):
    """Ties and unreachable starts included: labels made against the edges give the paths that labels along them give."""
    rng = random.Random(seed)
    size = 60
    rows = [(k, rng.randrange(size), rng.randrange(size), rng.choice([0, 1, 1, 2])) for k in range(rng.choice([70, 150, 400]))]
    ids, tails, heads, cost = (np.array(column) for column in zip(*rows))
    graph, turned = relax._Graph.of(ids, tails, heads, cost, size), relax._Graph.of(ids, heads, tails, cost, size)
    owner, ends = np.divmod(np.arange(10 * size), size)
    roots = np.array(rng.sample(range(size), 10))
    dist, hops, _ = relax.relaxed(turned, size, roots, owner, ends)
    reached = np.flatnonzero(dist < 1 << 60)
    pair, edge = relax._read_ahead_by_chunks(graph, size, dist, hops, owner[reached], roots, ends[reached])
    sources = np.arange(size)
    plain, plain_hops, _ = relax.relaxed(graph, size, sources, *np.divmod(np.arange(size * size), size))
    starts, targets = ends[reached], roots[owner[reached]]
    assert (plain[starts * size + targets] == dist[reached]).all() and (plain_hops[starts * size + targets] == hops[reached]).all()
    want_pair, want_edge = relax.read_back(graph, size, plain, plain_hops, starts, targets)
    assert (pair == want_pair).all() and (edge == want_edge).all()


def test_networks_are_not_copied_for_every_few_sources(spark):
    """A copy of a network for each part: hardly more parts than profiles, but a profile of its own spreads over the tasks."""
    many = spark.range(40 * 300).selectExpr("id % 40 AS profile", "id AS source", "0L AS target")
    slots = spark.sparkContext.defaultParallelism
    assert {r.parts for r in relax.parts_of_profiles(many).collect()} == {-(-relax.PARTS_PER_SLOT * slots // 40)}
    one = spark.range(128 * 1000).selectExpr("0L AS profile", "id AS source", "0L AS target")
    assert [r.parts for r in relax.parts_of_profiles(one).collect()] == [relax.PARTS_PER_SLOT * slots]


@pytest.mark.parametrize("kind", ["long", "double"])
def test_packed_edges_are_the_same_and_small(spark, kind):
    edges = spark.range(20_000).selectExpr(
        "id % 7 AS profile", "id AS edge_id", "id div 8 AS edge_source", "id div 8 + (id * 31) % 200 - 100 AS edge_target",
        f"CAST(1000 + (id * 7919) % 997 AS {kind}) + IF(id = 8, 1e18D, 0) AS edge_cost")
    edges = edges.withColumn("edge_cost", F.col("edge_cost").cast(kind))
    packs = relax.packed_edges(edges, edges.schema["edge_cost"].dataType).collect()
    assert sum(len(p.edges) for p in packs) < 20_000 * 8
    got = set()
    for pack in packs:
        columns = relax._unpacked([pa.scalar(pack.edges)], np.int64 if kind == "long" else np.float64)
        got |= {(pack.profile, *row) for row in zip(*[column.tolist() for column in columns])}
    assert got == {tuple(row) for row in edges.collect()}


def test_paths_are_not_stored(spark, tmp_path):
    """What a search leaves below the checkpoint folder grows with the pairs, not with the steps of their paths."""
    size = 400
    edges = spark.createDataFrame([(0, k, k, k + 1, 1 + k * 7919 % 997) for k in range(size)], "profile int, id long, source long, target long, cost long")
    pairs = spark.createDataFrame([(0, k, t) for k in range(10) for t in range(size - 100, size)], "profile int, source long, target long")
    folder = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().replace("file:", ""))

    def held():
        return sum(file.stat().st_size for file in folder.rglob("*") if file.is_file())

    before = held()
    rows = path_rows(search(pairs, TimedNetwork(edges))).count()
    assert rows > 300 * 1000 and held() - before < rows


def test_rows_bring_their_columns_and_pairs_are_searched_once(spark, monkeypatch):
    rng = random.Random(8)
    edges = {0: grid(rng, lambda r: r.choice([0, 1, 2, 5]))}
    costed = spark.createDataFrame([(0, *e) for e in edges[0]], "profile int, id long, source long, target long, cost long")
    wanted = [(0, s, t) for s in (0, 5, 24) for t in range(49) if s != t]
    trips = spark.createDataFrame([(f"t{k}", *p) for k in range(4) for p in wanted], "trip string, profile int, source long, target long")
    # A source has more rows than a part is meant to have, so that they are dealt out.
    monkeypatch.setattr(relax, "PAIRS_PER_PART", 50)
    result = search(trips.select("profile", "source", "target").distinct(), TimedNetwork(costed))
    plain = {(r.source, r.target): r.steps for r in paths.pair_paths(result).collect()}
    met = result.along(trips).filter("error IS NULL").collect()
    assert len(met) == 4 * len(plain) and len({(r.trip, r.source, r.target) for r in met}) == len(met)
    assert all(r.steps == plain[(r.source, r.target)] for r in met)


def test_edges_dealt_out_by_profile_stay_where_they_are(spark):
    rng = random.Random(9)
    edges = {p: grid(rng, lambda r: r.choice([0, 1, 2, 5])) for p in range(6)}
    pairs = sorted({(rng.randrange(6), rng.randrange(49), rng.randrange(49)) for _ in range(200)})
    pairs = [p for p in pairs if p[1] != p[2]]
    costed = spark.createDataFrame([(p, *e) for p, es in edges.items() for e in es], "profile int, id long, source long, target long, cost long")
    network = TimedNetwork(costed.repartition(5, "profile"), by_profile=True)
    wanted = spark.createDataFrame(pairs, "profile int, source long, target long")
    result = search(wanted, network)
    found = {(r.profile, r.source, r.target): (r.dist, r.hops) for r in result.found.collect()}
    rows = defaultdict(list)
    for r in sorted(path_rows(result).collect(), key=lambda r: r.path_seq):
        rows[(r.profile, r.start_vid, r.end_vid)].append(r)
    check(edges, pairs, found, rows)
    one = relax.paths_in_tasks(wanted.filter("source < 3"), network, costed.schema["cost"].dataType, True,
                               spark.createDataFrame([(p, 1) for p in range(6)], "profile int, parts int"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("REPARTITION_BY_NUM") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_static_edges_are_costed_where_the_parts_are(spark):
    """Edges x profiles are neither shuffled nor sorted, and the paths are those of a solver."""
    rng = random.Random(10)
    base = grid(rng, lambda r: r.choice([0, 1, 2, 5]))
    edges = {p: [(k, a, b, cost + (k + p) % 3 if k % 9 else -1) for k, a, b, cost in base] for p in range(6)}
    pairs = sorted({(rng.randrange(6), rng.randrange(49), rng.randrange(49)) for _ in range(200)})
    pairs = [p for p in pairs if p[1] != p[2]]
    static = spark.createDataFrame(base, "id long, source long, target long, base long")
    network = TimedNetwork(static, cost=lambda profile, edge: F.when(edge("id") % 9 == 0, -1).otherwise(edge("base") + (edge("id") + profile) % 3))
    wanted = spark.createDataFrame(pairs, "profile int, source long, target long")
    result = search(wanted, network)
    found = {(r.profile, r.source, r.target): (r.dist, r.hops) for r in result.found.collect()}
    rows = defaultdict(list)
    for r in sorted(path_rows(result).collect(), key=lambda r: r.path_seq):
        rows[(r.profile, r.start_vid, r.end_vid)].append(r)
    check(edges, pairs, found, rows)
    plan = result.along(wanted)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("REPARTITION_BY_NUM") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_sources_with_very_many_rows_are_known_from_the_count_of_parts(spark, monkeypatch):
    monkeypatch.setattr(relax, "PAIRS_PER_PART", 50)
    rows = spark.range(200).selectExpr("0 AS profile", "IF(id < 60, 7L, id) AS source", "id AS target")
    parts = relax.parts_of_profiles(rows)
    assert parts.first().hot == [7]
    dealt = relax._dealt(rows, parts)
    assert dealt.filter("source = 7").select("part").distinct().count() > 1
    assert "Exchange hashpartitioning" not in dealt._jdf.queryExecution().executedPlan().toString()


def test_rows_taken_along_need_no_pairs(spark, monkeypatch):
    """Who brings rows to the search neither draws nor stores nor counts the pairs first."""
    costed = spark.createDataFrame([(0, 1, 5, 6, 2), (0, 2, 6, 7, 3)], "profile int, id long, source long, target long, cost long")
    trips = spark.createDataFrame([("a", 0, 5, 7), ("b", 0, 5, 7), ("c", 0, 7, 5)], "trip string, profile int, source long, target long")
    stored = []
    monkeypatch.setattr(paths, "stored", lambda df, name: stored.append(name) or checkpointed(df))
    result = search(trips.select("profile", "source", "target").distinct(), TimedNetwork(costed))
    assert {(r.trip, len(r.steps)) for r in result.along(trips).collect()} == {("a", 3), ("b", 3)} and not stored
    assert [(r.source, r.target, r.dist) for r in result.found.collect()] == [(5, 7, 5)] and stored == ["pairs"]
    assert path_rows(result).count() == 3 and result.failures.isEmpty() and stored == ["pairs"]


def test_kept_tables_are_compressed_well(spark):
    """Trips and pairs of a search are kept once, in the smaller of the usual compressions."""
    kept = stored(spark.range(100).selectExpr("id", "id % 7 AS profile"), "kept")
    assert {name.split(".")[-2] for name in map(str, kept.inputFiles())} == {"zstd"}
    assert kept.count() == 100


@pytest.mark.parametrize("broken, kind, error", [(float("nan"), "double", "ValueError: an edge costs no finite number"),
                                                 (1 << 62, "long", "OverflowError: the cost of a path may not be exact")])
def test_failures_do_not_depend_on_the_size_of_the_network(spark, broken, kind, error):
    """By rounds, as for a network too large for a task, a profile fails alone and is reported as it is in tasks."""
    as_kind = float if kind == "double" else int
    edges = [(p, k, k, k + 1, as_kind(k + 1)) for p in range(3) for k in range(5)] + [(1, 9, 7, 8, broken), (4, 9, 7, 8, broken)]
    costed = spark.createDataFrame(edges, f"profile int, id long, source long, target long, cost {kind}")
    trips = spark.createDataFrame([("a", 0, 0, 3), ("b", 1, 0, 3), ("c", 2, 1, 5)], "trip string, profile int, source long, target long")
    seen = []
    for task_edges in (100, 0):
        result = search(trips.select("profile", "source", "target"), TimedNetwork(costed), task_edges=task_edges)
        found = sorted(tuple(r) for r in result.found.select("profile", "source", "target", "dist", "hops").collect())
        along = {(r.trip, r.profile, r.steps and len(r.steps), r.error) for r in result.along(trips).collect()}
        seen.append((found, {tuple(r) for r in result.failures.collect()}, along))
    assert seen[0][1] == {(1, error)} and seen[1] == seen[0]
    assert seen[0][2] == {("a", 0, 4, None), (None, 1, None, error), ("c", 2, 5, None)}


def solved(monkeypatch, rows, pairs, kind, keyed, **limits):
    """What a task finds for (source, target) pairs on (id, source, target, cost) edges: {pair: (dist, hops, steps)}."""
    with monkeypatch.context() as patch:
        for name, value in limits.items():
            patch.setattr(relax, name, value)
        if not keyed:
            patch.setattr(relax.Keyed, "fits", staticmethod(lambda costs, size: False))
        wanted = pa.table({"profile": [0] * len(pairs), "source": [a for a, _ in pairs], "target": [b for _, b in pairs]})
        edges = pa.table({"profile": [0] * len(rows), **{f"edge_{name}": list(column) for name, column in
                                                         zip(("id", "source", "target", "cost"), zip(*rows))}})
        cost_type = T.DoubleType() if kind == "double" else T.LongType()
        costs, steps = [relax._solver(cost_type, ["profile", "source", "target"], with_steps)(wanted, edges).to_pylist()
                        for with_steps in (False, True)]
    assert all(r["error"] is None for r in [*costs, *steps])
    found = {(r["source"], r["target"]): r["steps"] for r in steps}
    return {(r["source"], r["target"]): (r["dist"], r["hops"], found.pop((r["source"], r["target"]))) for r in costs}


@pytest.mark.parametrize("seed", range(24))
def test_keys_of_cost_and_edges_change_no_path(monkeypatch, seed):
    """Free edges, ties, hubs, dear edges, vertices that nothing leaves or enters, and roots left for another block."""
    rng = random.Random(seed)
    size, kind = rng.choice([8, 60, 150]), rng.choice(["long", "double"])
    cost = rng.choice([lambda: rng.choice([0, 1, 1, 2]), lambda: rng.randrange(1000, 2000), lambda: rng.choice([0, 1, 10 ** 6]), lambda: 1])
    ends = rng.choice([lambda: rng.randrange(size), lambda: rng.choice([0, 1, rng.randrange(size)])])
    number = rng.choice([size, 4 * size])
    rows = [(k * 7919 % 99991, ends(), rng.randrange(size), cost()) for k in range(number)] + [
        (100_000 + k, k, k + 1, cost()) for k in range(0, size - 1, 2)]
    rng.shuffle(rows)
    pairs = sorted({(rng.randrange(size), rng.randrange(size)) for _ in range(300)} | {(0, t) for t in range(size)} | {(s, 1) for s in range(size)})
    pairs = [p for p in pairs if p[0] != p[1]]
    plain = solved(monkeypatch, rows, pairs, kind, False)
    for limits in ({}, {"BLOCK_LABELS": 8 * size, "BUDGET": 2, "GUIDES": rng.choice([1, 4]), "BOUNDED_SOURCES": 1, "LOOK_WINDOWS": 1, "ROW_EDGES": 2, "MASKED_ROWS": rng.choice([1, 8]), "WINDOWS_HELD": 3}):
        assert solved(monkeypatch, rows, pairs, kind, True, **limits) == plain


def test_labels_of_a_search_are_expanded_once():
    """With the windows no wider than the cheapest edge a label is final when it is expanded."""
    size = 40 * 40
    steps = {1: 1000, -1: 1000, 40: 1000, -40: 1000, 5: 4800, -5: 4800, 200: 4800, -200: 4800}
    rows = [(k, v, v + s, steps[s] + k * 7919 % 997) for k, (v, s) in enumerate((v, s) for v in range(size) for s in steps) if 0 <= v + s < size]
    ids, tails, heads, cost = (np.array(column) for column in zip(*rows))
    graph = relax._Graph.of(ids, tails, heads, cost, size)
    owner, targets = np.divmod(np.arange(5 * size), size)
    _, _, made = relax.relaxed(graph, size, np.arange(5) * 300, owner, targets)
    left, expanded = relax.settled_keys(relax.Keyed(graph, size), np.arange(5) * 300, owner, targets, relax.Keys(5 * size))
    assert not len(left) and expanded == 5 * size < made / 1.3


@pytest.mark.parametrize("kind", ["long", "double"])
def test_groups_of_a_task_with_the_same_edges_order_them_once(monkeypatch, kind):
    """Bins differ in costs: edges are put in order once, for others anew, and paths are those of a task for each bin; a bad bin harms no other."""
    rng = random.Random(12)
    plain = [(k, a, b) for k, a, b, _ in grid(rng, lambda r: 0)]
    networks = [[(*e, rng.choice([0, 1, 2, 5])) for e in plain] for _ in range(3)]
    if kind == "double":
        networks.insert(1, [(*e, float("nan")) for e in plain])
    networks += [networks[0][5:], list(reversed(networks[0])), networks[0]]
    pairs = [(a, b) for a in range(0, 49, 3) for b in range(0, 49, 2) if a != b]
    cost_type = T.DoubleType() if kind == "double" else T.LongType()
    ordered = []
    made = relax._Network.__init__
    monkeypatch.setattr(relax._Network, "__init__", lambda self, *edges: ordered.append(1) or made(self, *edges))

    def tables(rows):
        return (pa.table({"profile": [0] * len(pairs), "source": [a for a, _ in pairs], "target": [b for _, b in pairs]}),
                pa.table({f"edge_{name}": pa.array(column, pa.float64() if name == "cost" and kind == "double" else pa.int64())
                          for name, column in zip(("id", "source", "target", "cost"), zip(*rows))}))

    one = relax._solver(cost_type, ["profile", "source", "target"], True)
    together = [one(*tables(rows)).to_pylist() for rows in networks]
    assert len(ordered) == (5 if kind == "double" else 4)
    apart = [relax._solver(cost_type, ["profile", "source", "target"], True)(*tables(rows)).to_pylist() for rows in networks]
    assert together == apart and all(len(found) > 300 for found in together if found[0]["error"] is None)
