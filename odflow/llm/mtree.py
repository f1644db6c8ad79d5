"""Exact top-k search by inner product with M-trees.

Rows are dealt into shards of bounded size. Each shard is an M-tree: pages of entries, where a routing
entry keeps its covering radius and its distance to the parent. Queries go through a tree best
first, in waves; stored parent distances rule out entries by the triangle inequality before their own distance
is computed, and a page is opened only if its bound can still beat the k-th best. The best rows of all
shards are merged per query.

Inner products become distances by one more coordinate: rows get sqrt(M - |x|^2), where M is the
largest squared norm of the shard, queries get 0; then |q' - x'|^2 = |q|^2 + M - 2 q.x. Bounds carry a
margin for rounding, and scores are integers, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 8192
# Queries that go through a tree at once.
TOGETHER = 1024
PAGE_ENTRIES = 64
# Rounding of a distance, relative to the coordinates; far above that of 64-bit floats.
SLACK = 1e-7


@dataclass
class Page:
    """Entries of one page: where they are, how far from the parent's centre, and, if routing, their pages."""

    members: np.ndarray
    to_parent: np.ndarray
    radius: np.ndarray | None = None
    children: list[Page] = field(default_factory=list)


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def build(points: np.ndarray, members: np.ndarray | None = None, centre: np.ndarray | None = None,
          page_entries: int = PAGE_ENTRIES) -> Page:
    """Bulk-load a tree over ``points``; ``members`` are the rows below this page.

    Routing objects are rows picked far from each other; each row goes to its nearest one. If all of them
    are at one place the rows are dealt out evenly, so equal rows end as full pages too.
    """
    members = np.arange(len(points)) if members is None else members
    centre = points[members[0]] if centre is None and len(members) else centre
    if len(members) <= page_entries:
        return Page(members, _distances(points[members], centre) if len(members) else np.zeros(0))
    below = points[members]
    picked = [0]
    nearest, owner = _distances(below, below[0]), np.zeros(len(members), dtype=np.int64)
    fanout = min(page_entries, -(-len(members) // (page_entries // 2)))
    while len(picked) < fanout and nearest.max() > 0:
        far = int(nearest.argmax())
        distance = _distances(below, below[far])
        closer = distance < nearest
        owner[closer], nearest[closer] = len(picked), distance[closer]
        picked.append(far)
    if len(picked) == 1:
        owner = np.arange(len(members)) * fanout // len(members)
        picked = [int(np.flatnonzero(owner == k)[0]) for k in range(fanout)]
        nearest = np.zeros(len(members))
    groups = [members[owner == k] for k in range(len(picked))]
    routing = members[picked]
    radius = np.array([nearest[owner == k].max() for k in range(len(picked))])
    children = [build(points, group, points[route], page_entries) for group, route in zip(groups, routing, strict=True)]
    return Page(routing, _distances(points[routing], centre), radius, children)


def _flat(root: Page) -> list[Page]:
    """All pages, each before the pages below it."""
    pages = [root]
    for page in pages:
        pages += page.children
    return pages


def _products(values: np.ndarray, queries: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Inner products of some queries with some rows, exact however large the components are.

    Sums below 2^53 are exact as doubles, those below 2^63 as 64-bit numbers; beyond that Python's numbers are used.
    """
    def size(rows: np.ndarray) -> float:
        return float(np.abs(rows.astype(np.float64)).max(initial=0.0))

    most = size(values) * size(queries) * max(1, values.shape[1])
    kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object
    left, right = queries.astype(kind), values.astype(kind)

    def product(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return left[asked] @ right[rows].T
    return product


def search(root: Page, values: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray,
           k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows below ``root`` of every query: (query, score, id), ties to smaller ids, never the query's own id.

    All queries go through the tree together. In each wave a query opens the pages with the least bounds among those
    that can still beat its k-th best, one at first and twice as many in each wave after; a page is met once a wave by all queries
    that open it, as one product of matrices.
    """
    pages = _flat(root)
    number = {id(page): n for n, page in enumerate(pages)}
    product = _products(values, queries)
    norms = np.einsum("ij,ij->i", values.astype(np.float64), values.astype(np.float64))
    base = np.einsum("ij,ij->i", queries.astype(np.float64), queries.astype(np.float64)) + norms.max()
    margin = SLACK * (2.0 * np.sqrt(base) + 1.0)
    every = np.arange(len(queries))

    def distance(asked: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, base[asked, None] - 2.0 * scores.astype(np.float64)))

    # Per query its best rows, the worst last; of each page the least distance to a row in it, and that to its centre.
    scores = np.zeros((len(queries), k), dtype=object if product(every[:1], every[:0]).dtype == object else np.int64)
    found = np.full((len(queries), k), -1, dtype=np.int64)
    filled = np.zeros((len(queries), k), dtype=bool)
    reach = np.full(len(queries), np.inf)
    bound = np.full((len(queries), len(pages)), np.inf)
    centre = np.zeros((len(queries), len(pages)))
    bound[:, 0], centre[:, 0] = 0.0, distance(every, product(every, np.zeros(1, dtype=np.int64)))[:, 0]

    def keep(asked: np.ndarray, rows: np.ndarray) -> None:
        new = product(asked, rows)
        if new.dtype == np.float64:
            new = new.astype(np.int64)
        usable = ids[rows][None, :] != own[asked, None]
        hits = usable & (~filled[asked, -1:] | (new >= scores[asked, -1:]))
        some = np.flatnonzero(hits.any(axis=1))
        if not len(some):
            return
        asked = asked[some]
        all_scores = np.hstack([scores[asked], new[some]])
        all_ids = np.hstack([found[asked], np.broadcast_to(ids[rows], (len(asked), len(rows)))])
        there = np.hstack([filled[asked], hits[some]])
        order = np.lexsort((all_ids, -all_scores, ~there), axis=-1)[:, :k]
        scores[asked] = np.take_along_axis(all_scores, order, axis=1)
        found[asked] = np.take_along_axis(all_ids, order, axis=1)
        filled[asked] = np.take_along_axis(there, order, axis=1)
        full = filled[asked, -1]
        worst = distance(asked, scores[asked, -1:])[:, 0] + margin[asked]
        reach[asked] = np.where(full, worst, np.inf)

    def open_page(n: int, asked: np.ndarray) -> None:
        page = pages[n]
        # A row or page whose stored distance to the centre rules it out for all is not looked at.
        apart = np.abs(centre[asked, n][:, None] - page.to_parent[None, :])
        far = apart - (0.0 if page.radius is None else page.radius[None, :])
        near = far <= (reach[asked] + margin[asked])[:, None]
        wanted = np.flatnonzero(near.any(axis=0))
        if not len(wanted):
            return
        if page.radius is None:
            keep(asked, page.members[wanted])
            return
        below = distance(asked, product(asked, page.members[wanted]))
        children = np.array([number[id(page.children[entry])] for entry in wanted])
        low = np.maximum(0.0, below - page.radius[wanted][None, :] - margin[asked, None])
        bound[np.ix_(asked, children)] = np.where(near[:, wanted], low, np.inf)
        centre[np.ix_(asked, children)] = below

    wave = 1
    while True:
        bound[bound > reach[:, None]] = np.inf
        live = np.isfinite(bound)
        if not live.any():
            break
        if wave < len(pages):
            first = np.argpartition(bound, wave - 1, axis=1)[:, :wave]
            chosen = np.zeros_like(live)
            np.put_along_axis(chosen, first, True, axis=1)
            live &= chosen
        bound[live] = np.inf
        for n in np.flatnonzero(live.any(axis=0)).tolist():
            open_page(n, np.flatnonzero(live[:, n]))
        wave *= 2
    at, rank = np.nonzero(filled)
    best = scores[at, rank]
    if best.dtype == object:
        if any(abs(int(score)) >= 1 << 63 for score in best):
            raise OverflowError("an inner product does not fit 64 bits")
        best = best.astype(np.int64)
    return at, best, found[at, rank]


def lifted(values: np.ndarray) -> np.ndarray:
    """Rows as points at whose distance to a query their inner product can be read."""
    norms = np.einsum("ij,ij->i", values.astype(np.float64), values.astype(np.float64))
    most = norms.max() if len(norms) else 0.0
    return np.hstack([values.astype(np.float64), np.sqrt(most - norms)[:, None]])


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    factor: int = 1024) -> DataFrame:
    """(id, v): components scaled to whole numbers; rows NULL, without id or with unusable components are left out."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * factor))
    usable = F.forall(F.col(vector_col), lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(usable)
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v")))


def _searcher(k: int, page_entries: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            values = np.stack([np.asarray(v, dtype=np.int64) for v in rows["v"]])
            asked = np.stack([np.asarray(v, dtype=np.int64) for v in queries["v"]])
            ids, own = rows["id"].to_numpy(), queries["id"].to_numpy()
            root = build(lifted(values), page_entries=page_entries)
            for start in range(0, len(asked), TOGETHER):
                some = slice(start, start + TOGETHER)
                at, scores, best = search(root, values, ids, asked[some], own[some], k)
                found.append(pd.DataFrame({"query_id": own[some][at], "vec_id": best, "score": scores}))
        if not found:
            return pd.DataFrame({name: np.zeros(0, dtype=np.int64) for name in ("query_id", "vec_id", "score")})
        return pd.concat(found)
    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS, page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """The k highest inner products of each query among all rows: (query_id, rank, vec_id, score).

    ``rows`` and ``queries`` are (id, v) as ``integer_vectors`` gives them. Ties go to the smaller id; a
    query's own id is no candidate; vectors of another length than the query's are none either. A
    repeated query counts once, a repeated row as often as it is there; an id that queries with
    several vectors gets the best of all of them. A result that does not fit 64 bits is an error.
    Rows are dealt by hash into shards and queries into blocks of about ``shard_rows`` and ``query_rows``,
    so no task holds more than one of each, whichever vectors are common.
    """
    queries = queries.dropDuplicates(["id", "v"])
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    deal = [F.size("v").alias("dim"), F.col("id"), F.col("v")]
    left = rows.select(*deal, F.pmod(F.xxhash64("id", "v"), F.lit(shards)).alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = queries.select(*deal, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                           F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"))
    key = ["dim", "shard", "block"]
    partial = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _searcher(k, page_entries), "query_id long, vec_id long, score long")
    # The limit on the rank is applied before the shuffle, too.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
