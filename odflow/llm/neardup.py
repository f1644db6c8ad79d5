"""Near-duplicate groups by MinHash and a multi-index Hamming join.

A text's set is its distinct word shingles, hashed to 64 bits; texts with equal sets form a class. A
class has a signature of ``values`` b-bit minima, and the distance of two signatures is the number
of values in which they differ. Signatures are cut into chunks; by the pigeonhole principle two of them
within distance ``2 * chunks - 1`` agree in some chunk up to one error, so every class is filed under
each chunk with each one value left out, and all pairs within the distance meet.

Nothing is emitted per pair. Within a file the pairs under the distance are joined to a forest, and forests make up loose
groups. Links are confirmed on the full sets: each text of a loose group with one representative first, and those that
are not linked to it with all others, in blocks of bounded size of which again only a forest leaves the task.

Two classes at the similarity of 0.85 that is asked for miss the guaranteed distance with a probability
under 2e-7, and even then mostly meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import packed
from odflow.runtime import broadcast_if_small, checkpointed

SHINGLE_WORDS = 5
# Sets of all texts of a block, in shingles; a task that confirms links holds two blocks.
BLOCK_SHINGLES = 300_000
# Texts of a block at most, about.
BLOCK_TEXTS = 256
# Members of one file that are compared with each other; a larger file is one loose group.
FILE_MEMBERS = 256
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Signatures:
    """``chunks`` chunks of ``chunk_values`` values of 16 bits."""

    chunks: int = 10
    chunk_values: int = 4

    @property
    def values(self) -> int:
        return self.chunks * self.chunk_values

    @property
    def distance(self) -> int:
        """The distance up to which all pairs are found: one error a chunk cannot hold more."""
        return 2 * self.chunks - 1

    def constants(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(20_240_101)
        draw = rng.integers(1, 1 << 62, size=(2, self.values), dtype=np.uint64)
        return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text.

    A-Z are lower-cased and words end at ASCII white space. Fewer words than a shingle has make one
    shingle; no word, or no text, makes an empty set.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    if len(parts) <= words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts))], dtype=np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum([len(part) + 1 for part in parts]).tolist()
    starts = [0, *ends]
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(line[a: b - 1]) for a, b in zip(starts, ends[words - 1:], strict=False)),
                                 dtype=np.uint64))


def signature(shingles: np.ndarray, shape: Signatures, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """16 bits of the minimum of each hash function over the set."""
    least = np.full(shape.values, _TOP)
    for at in range(0, len(shingles), 2048):
        mixed = shingles[None, at: at + 2048] * odd[:, None]
        mixed += add[:, None]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x94D049BB133111EB)
        np.minimum(least, mixed.min(axis=1), out=least)
    return ((least >> np.uint64(7)) & np.uint64(0xFFFF)).astype(np.uint16)


def _describe(shape: Signatures, words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd, add = shape.constants()
        for batch in batches:
            nodes, sizes, signs = [], [], []
            for text in batch.pop("text"):
                shingles = shingle_set(text, words)
                sizes.append(len(shingles))
                if len(shingles):
                    # Signed, as Spark's longs are.
                    nodes.append(str(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)))
                    signs.append(signature(shingles, shape, odd, add).tobytes())
                else:
                    nodes.append(None)
                    signs.append(None)
            yield batch.assign(node=nodes, n_shingles=sizes, sign=signs)
    return run


# Stands for a missing id in keys.
NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """Two longs that name a row, up to repeated rows: its id and a hash of its text."""
    return docs.withColumns({"key_id": F.coalesce("doc_id", F.lit(NO_ID)), "key_text": F.xxhash64("text")})


def describe(docs: DataFrame, shape: Signatures = Signatures(), words: int = SHINGLE_WORDS) -> DataFrame:
    """(key_id, key_text, node, n_shingles, sign): the class of each text and its signature, NULL for empty sets."""
    narrow = _keyed(docs.select("doc_id", "text")).select("key_id", "key_text", "text")
    # Classes travel as text: a missing one would turn the others into floats.
    found = narrow.mapInPandas(_describe(shape, words), "key_id long, key_text long, node string, n_shingles long, sign binary")
    return found.withColumn("node", F.col("node").cast("long"))


def _file_keys(shape: Signatures):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            signs = np.frombuffer(b"".join(batch["sign"]), dtype=np.uint16).reshape(len(batch), -1).astype(np.uint64)
            nodes = batch["node"].to_numpy()
            for chunk in range(shape.chunks):
                own = signs[:, chunk * shape.chunk_values: (chunk + 1) * shape.chunk_values]
                for left_out in range(shape.chunk_values):
                    key = np.full(len(batch), chunk * shape.chunk_values + left_out + 1, dtype=np.uint64)
                    for k in range(shape.chunk_values):
                        if k != left_out:
                            key = (key ^ own[:, k]) * np.uint64(0x9E3779B97F4A7C15)
                            key ^= key >> np.uint64(32)
                    yield pd.DataFrame({"file": key.view(np.int64), "node": nodes})
    return run


def _shared_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by file, those whose file holds more than one class."""
    last = None  # the last row so far, and whether it was given out
    for batch in batches:
        files, nodes = batch["file"].to_numpy(), batch["node"].to_numpy()
        if not len(files):
            continue
        same = np.append(files[1:] == files[:-1], False)
        after = np.insert(same[:-1], 0, False)
        keep = same | after
        if last is not None and last[0] == files[0]:
            keep[0] = True
            if not last[2]:
                yield pd.DataFrame({"file": [last[0]], "node": [last[1]]})
        last = (files[-1], nodes[-1], bool(keep[-1]))
        yield pd.DataFrame({"file": files[keep], "node": nodes[keep]})


class _Forest:
    """Union-find over node ids; ``join`` says whether two were apart."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (above := self.up.get(x, x)) != x:
            path.append(x)
            x = above
        for y in path:
            self.up[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _loose_links(shape: Signatures):
    """Of rows (file, node, sign) sorted by file, a forest of the pairs within the distance."""
    def compare(files: np.ndarray, nodes: np.ndarray, signs: np.ndarray, forest: _Forest) -> list[tuple[int, int]]:
        out = []
        step = 1
        while step < len(files):
            same = np.flatnonzero(files[step:] == files[:-step])
            if not len(same):
                break
            if step < FILE_MEMBERS:
                near = same[(signs[same] != signs[same + step]).sum(axis=1) <= shape.distance]
                out += [(a, b) for a, b in zip(nodes[near].tolist(), nodes[near + step].tolist(), strict=True)
                        if forest.join(a, b)]
                step += 1
                continue
            break
        if step >= FILE_MEMBERS:
            # Files with more members: each is linked to the one before, whatever their distance.
            starts = np.flatnonzero(np.append(True, files[1:] != files[:-1]))
            for a, b in zip(starts, np.append(starts[1:], len(files)), strict=True):
                if b - a > FILE_MEMBERS:
                    out += [(x, y) for x, y in zip(nodes[a: b - 1].tolist(), nodes[a + 1: b].tolist(), strict=True)
                            if forest.join(x, y)]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, rest = _Forest(), None
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            files = batch["file"].to_numpy()
            # A file that may go on in the next batch waits; of a large one its last members stand for it.
            cut = int(np.searchsorted(files == files[-1], True))
            ready = batch if len(batch) - cut > 4 * FILE_MEMBERS else batch.iloc[:cut]
            rest = batch.iloc[max(cut, len(batch) - FILE_MEMBERS - 1):] if ready is batch else batch.iloc[cut:]
            yield from links(ready, forest)
        if rest is not None:
            yield from links(rest, forest)

    def links(batch: pd.DataFrame, forest: _Forest) -> Iterator[pd.DataFrame]:
        if len(batch) > 1:
            signs = np.frombuffer(b"".join(batch["sign"]), dtype=np.uint16).reshape(len(batch), -1)
            found = compare(batch["file"].to_numpy(), batch["node"].to_numpy(), signs, forest)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])
    return run


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): (node, root), the root being the smallest node.

    Alternates two star steps (neighbours move to the smallest one, larger ones first, then smaller ones),
    which takes a logarithmic number of rounds; each round's edges are checkpointed.
    """
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .distinct())
    for _ in range(max_rounds):
        # Large star: larger neighbours of u are linked to the least node around u.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = least.select(F.col("u").alias("k"), F.least("u", "least").alias("least"))
        large = (both.join(least, F.col("u") == F.col("k")).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct())
        # Small star: u and its smaller neighbours are linked to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k"))
        small = (small.filter("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .unionByName(least.select(F.col("k").alias("u"), F.col("least").alias("v"))).distinct())
        small = checkpointed(small)
        mixed = small.unionByName(edges)
        changed = mixed.groupBy("u", "v").count().filter("count = 1").limit(1).count()
        edges = small
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _links_within(nodes: list[int], sets: list[np.ndarray], left: int, percent: int) -> list[tuple[int, int]]:
    """A forest of the links between sets; below ``left`` is the first block, whose own pairs are another task's.

    With ``left`` 0 all pairs count. Intersections of many sets come from a product of indicators:
    shingles that many sets have as a dense matrix, the others by their lists of sets.
    """
    forest, out = _Forest(), []

    def link(i: int, j: int) -> None:
        if forest.join(nodes[i], nodes[j]):
            out.append((nodes[i], nodes[j]))

    n = len(sets)
    if n <= 24:
        for j in range(max(1, left), n):
            for i in range(min(j, left or j)):
                if forest.root(nodes[i]) != forest.root(nodes[j]) and similar(sets[i], sets[j], percent):
                    link(i, j)
        return out
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, shingle, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = often > max(2, n // 16)
    dense = np.zeros((n, int(common.sum())), dtype=np.float32)
    column = np.cumsum(common) - 1
    is_common = common[shingle]
    dense[owner[is_common], column[shingle[is_common]]] = 1.0
    # Rare shingles that two sets or more have, in lists sorted by shingle.
    rare = ~is_common & (often[shingle] > 1)
    order = np.argsort(shingle[rare], kind="stable")
    listed, members = shingle[rare][order], owner[rare][order]
    starts = np.searchsorted(listed, np.arange(len(often)))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    lists_of = [shingle[begin[i]: begin[i + 1]] for i in range(n)]
    for first in range(left, n, 256):
        block = range(first, min(n, first + 256))
        shared = dense[first: first + 256] @ dense.T
        for j in block:
            row = shared[j - first]
            mine = lists_of[j][~common[lists_of[j]] & (often[lists_of[j]] > 1)]
            if len(mine):
                hits = np.concatenate([members[starts[s]: starts[s] + often[s]] for s in mine])
                row = row + np.bincount(hits, minlength=n)
            until = left or j
            linked = np.flatnonzero(100 * row[:until] >= percent * (sizes[:until] + sizes[j] - row[:until]))
            for i in linked.tolist():
                link(i, j)
    return out


def _star(percent: int, words: int):
    """Of the members of a part, with the group's representative among them, the links to the representative."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        centre = group[group["is_centre"]]
        others = group[~group["is_centre"]]
        own = shingle_set(centre["text"].iloc[0], words)
        linked = [node for node, text in zip(others["node"].tolist(), others["text"], strict=True)
                  if similar(own, shingle_set(text, words), percent)]
        found = pd.DataFrame({"a": [int(centre["node"].iloc[0])] * len(linked), "b": linked})
        return found.astype("int64")
    return run


def _confirm(percent: int, words: int):
    """Links of the open texts of a block to each other and to the texts of another block."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["is_open", "node"]).drop_duplicates("node", keep="last")
        left = int((~group["is_open"]).sum())
        sets = [shingle_set(text, words) for text in group["text"]]
        found = _links_within(group["node"].tolist(), sets, left, percent)
        if left:
            # From the first open text on each is compared with the closed ones; the open ones are compared here.
            found += _links_within(group["node"].tolist()[left:], sets[left:], 0, percent)
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return run


def _numbers(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


@dataclass(frozen=True)
class NearDuplicates:
    """``documents``: (key_id, key_text, node, n_shingles); ``groups``: (node, root) of classes with links."""

    documents: DataFrame
    groups: DataFrame


def find(docs: DataFrame, percent: int = 85, shape: Signatures = Signatures(), words: int = SHINGLE_WORDS,
         block_shingles: int = BLOCK_SHINGLES) -> NearDuplicates:
    """Classes of equal shingle sets, and the groups they form by links of ``percent`` similarity.

    ``docs`` holds doc_id and text; other columns are not read. A link is confirmed on the full sets.
    """
    described = checkpointed(describe(docs, shape, words))
    # One text stands for its class.
    classes = checkpointed(described.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("sign").alias("sign"), F.first("n_shingles").alias("n_shingles"),
        F.min(F.struct("key_id", "key_text")).alias("text_of")))
    files = classes.select("node", "sign").mapInPandas(_file_keys(shape), "file long, node long")
    shared = (files.repartition("file").sortWithinPartitions("file")
              .mapInPandas(_shared_files, "file long, node long"))
    signed = (shared.join(classes.select("node", "sign"), "node").repartition("file")
              .sortWithinPartitions("file", "node"))
    loose = components(signed.mapInPandas(_loose_links(shape), "a long, b long"))
    members = loose.join(classes.select("node", "n_shingles", "text_of"), "node")
    wanted = checkpointed(members.select("node", "root", "n_shingles", "text_of.*"))
    return NearDuplicates(described.drop("sign"), components(_confirmed(docs, wanted, percent, words, block_shingles)))


def _blocks(members: DataFrame, block_shingles: int, name: str) -> DataFrame:
    """How many blocks the texts of each group make, by their number and by their shingles."""
    size = F.greatest(F.ceil(F.sum("n_shingles") / block_shingles), F.ceil(F.count("*") / BLOCK_TEXTS))
    return members.groupBy("root").agg(size.alias(name))


def _confirmed(docs: DataFrame, wanted: DataFrame, percent: int, words: int, block_shingles: int) -> DataFrame:
    """Links of the wanted classes (node, root, n_shingles, key_id, key_text) that hold on the full sets, as forests.

    First every member of a loose group is compared with one representative, in parts of bounded size that are each
    sent a copy of it. Members linked to it are one group and need no comparison with each other. The
    rest, open texts, are compared with all texts of their loose group, block by block.
    """
    blocks = checkpointed(_blocks(wanted, block_shingles, "blocks").join(
        wanted.groupBy("root").agg(F.min("node").alias("centre")), "root"))
    # Blocks are dealt before texts are met, so no text is ever shuffled by its group alone.
    placed = checkpointed(wanted.join(broadcast_if_small(blocks), "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    texts = _keyed(docs.select("doc_id", "text")).drop("doc_id").join(placed.select("node", "key_id", "key_text"), ["key_id", "key_text"])
    # Repeated rows are one text.
    texts = checkpointed(texts.groupBy("node").agg(F.first("text").alias("text")))
    member = placed.select("node", "root", "block", "blocks", (F.col("node") == F.col("centre")).alias("is_centre")).join(texts, "node")
    row = ["root", "node", "text"]
    parts = (member.filter("NOT is_centre").select(*row, "block", "is_centre")
             .unionByName(member.filter("is_centre").select(*row, _numbers(F.col("blocks")).alias("block"), "is_centre")))
    stars = checkpointed(parts.groupBy("root", "block").applyInPandas(_star(percent, words), "a long, b long"))
    open_ = checkpointed(placed.filter("node <> centre").join(stars.select(F.col("b").alias("node")), "node", "left_anti")
                         .select("node", "root", "n_shingles"))
    # Only groups with open texts go on; each pair of blocks meets once.
    open_blocks = checkpointed(_blocks(open_, block_shingles, "open_blocks"))
    waiting = (placed.join(broadcast_if_small(open_blocks), "root")
               .join(open_.select("node", F.lit(True).alias("is_open")), "node", "left")
               .select("node", "root", "block", "blocks", "open_blocks", F.coalesce("is_open", F.lit(False)).alias("is_open"))
               .withColumn("open_block", F.pmod(F.xxhash64("node"), F.col("open_blocks"))))
    waiting = checkpointed(waiting).join(texts, "node")
    asking = waiting.filter("is_open").select(*row, "open_block", _numbers(F.col("blocks")).alias("block"), "is_open")
    asked = waiting.select(*row, _numbers(F.col("open_blocks")).alias("open_block"), "block", F.lit(False).alias("is_open"))
    found = asking.unionByName(asked).groupBy("root", "open_block", "block").applyInPandas(_confirm(percent, words), "a long, b long")
    return stars.unionByName(found)


def near_duplicates(docs: DataFrame, percent: int = 85, shape: Signatures = Signatures(), words: int = SHINGLE_WORDS,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Two texts are linked if 100 * common >= percent * united shingles; ``component_id`` is the smallest
    doc_id that links reach. Without words or text a row is linked with nothing. A row without an
    id is in the group of its text, which it never names; it is kept only if nothing in its group has an id.
    """
    found = find(docs, percent, shape, words, block_shingles)
    doc_id = F.when(F.col("key_id") != NO_ID, F.col("key_id"))
    ids = found.documents.filter("node IS NOT NULL").groupBy("node").agg(F.min(doc_id).alias("least"))
    grouped = ids.join(found.groups, "node", "left").withColumn("group", F.coalesce("root", "node"))
    least = grouped.groupBy("group").agg(F.min("least").alias("component"))
    named = grouped.join(least, "group").select("node", "component")
    rows = found.documents.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), doc_id).otherwise(F.col("component"))
    return rows.select(doc_id.alias("doc_id"), "n_shingles", component.alias("component_id"),
                       doc_id.eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = 85, shape: Signatures = Signatures(),
                words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id, one without an id only if none has one.

    Rows without words stay; of rows with the same id and text one stays.
    """
    found = find(docs, percent, shape, words)
    order = F.struct((F.col("key_id") == NO_ID).alias("no_id"), "key_id", "key_text")
    per_class = found.documents.filter("node IS NOT NULL").groupBy("node").agg(F.min(order).alias("first"))
    grouped = per_class.join(found.groups, "node", "left")
    stay = grouped.groupBy(F.coalesce("root", "node").alias("group")).agg(F.min("first").alias("first"))
    stay = stay.select("first.key_id", "first.key_text").unionByName(
        found.documents.filter("node IS NULL").select("key_id", "key_text").distinct())
    copies = Window.partitionBy("key_id", "key_text").orderBy("key_id")
    rows = docs.select(packed(docs), F.coalesce("doc_id", F.lit(NO_ID)).alias("key_id"), F.xxhash64("text").alias("key_text"))
    return (rows.join(stay, ["key_id", "key_text"], "left_semi").withColumn("copy", F.row_number().over(copies))
            .filter("copy = 1").select("row.*"))
