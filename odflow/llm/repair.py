"""Conversation structure repair: the cheapest edits that make a conversation well-formed.

A conversation should be an optional system row and then one or more exchanges of a user and an assistant
row, or nothing. Its edit lattice has a node for each (rows used, state of that pattern); edits lead from node to node:

    K  keep a row                                           0   (1 if truncated)
    R  keep its text under the other role, user/assistant   2   (3 if truncated)
    D  delete it (blank and duplicate rows must go)         3
    I  insert an empty user or assistant row                2

Two searches, forward from the start and backward from the ends, settle nodes in order of cost until no cheaper
meeting is left; all crossings of that cost are finished and the least audit, the letters in order, is taken.
An audit determines the repaired conversation, since a state allows R and I one role only.

Rows are dealt by range of (conversation, turn, role, text), so a hot conversation spreads over tasks. Each
piece of bounded size is searched from all states it can be entered in to all it can be left in, and the pieces of a
conversation are put together from their costs and audits. Only the digest of a repaired conversation, which
is defined in order, is one stream, of which a task keeps one row.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import shared_folder

# States of the pattern: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# From a state, the role that an inserted or rerolled row gets, and the state after a row of each initial.
FORCED = ("user", "user", "assistant", "user")
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
KEPT, TRUNCATED, LOST = 0, 1, 2
GOOD_PAIRS = ("su", "ua", "au")
# Rows to a partition and, as a power of two, to a piece of a conversation.
ROWS_PER_TASK = 200_000
PIECE_BITS = 12

_WORD = r"[^\x20\x09-\x0D]"

Step = tuple[str, int]
Found = tuple[int, str]


def _onward(steps: tuple[Step, ...], at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """The edits that leave a node: (cost, at, state, letter)."""
    forced = AFTER[state][FORCED[state][0]]
    yield INSERT_COST, at, forced, "I"
    if at < len(steps):
        initial, fault = steps[at]
        yield DELETE_COST, at + 1, state, "D"
        if fault != LOST:
            if initial in AFTER[state]:
                yield fault * TRUNCATED_COST, at + 1, AFTER[state][initial], "K"
            yield REROLE_COST + fault * TRUNCATED_COST, at + 1, forced, "R"


def _back(steps: tuple[Step, ...], at: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """The edits that lead to a node, with the nodes they come from."""
    for before in range(4):
        if AFTER[before][FORCED[before][0]] == state:
            yield INSERT_COST, at, before, "I"
    if at:
        initial, fault = steps[at - 1]
        yield DELETE_COST, at - 1, state, "D"
        if fault != LOST:
            for before in range(4):
                if AFTER[before].get(initial) == state:
                    yield fault * TRUNCATED_COST, at - 1, before, "K"
                if AFTER[before][FORCED[before][0]] == state:
                    yield REROLE_COST + fault * TRUNCATED_COST, at - 1, before, "R"


@lru_cache(maxsize=1 << 16)
def cheapest(steps: tuple[Step, ...], start: int, ends: tuple[int, ...]) -> Found | None:
    """The least cost and, of that cost, the least audit from ``start`` before the first step to one of ``ends`` after the last.

    A step is (initial of the role, KEPT, TRUNCATED or LOST). None if no edits lead there. Nodes of equal cost are settled
    in the order of the rows (from the end, backward), and an edit of no cost uses a row, so a node's least audit
    is known when it is settled. Two audits of one node and cost use the same rows, so neither is the
    start of the other, and the least audit of a path is made of least audits.
    """
    ahead: dict[tuple[int, int], Found] = {}
    behind: dict[tuple[int, int], Found] = {}
    front = [(0, 0, "", start)]
    rear = [(0, -len(steps), "", end) for end in ends]
    heapq.heapify(rear)
    best = None
    while front and rear and (best is None or front[0][0] + rear[0][0] <= best):
        if front[0][0] <= rear[0][0]:
            cost, at, audit, state = heapq.heappop(front)
            node, mine, other = (at, state), ahead, behind
        else:
            cost, at, audit, state = heapq.heappop(rear)
            node, mine, other = (-at, state), behind, ahead
        if node in mine:
            continue
        mine[node] = cost, audit
        if node in other and (best is None or cost + other[node][0] < best):
            best = cost + other[node][0]
        if mine is ahead:
            for price, onto, into, letter in _onward(steps, *node):
                if (onto, into) not in ahead:
                    heapq.heappush(front, (cost + price, onto, audit + letter, into))
                if (onto, into) in behind and (best is None or cost + price + behind[onto, into][0] < best):
                    best = cost + price + behind[onto, into][0]
        else:
            for price, onto, into, letter in _back(steps, *node):
                if (onto, into) not in behind:
                    heapq.heappush(rear, (cost + price, -onto, letter + audit, into))
                if (onto, into) in ahead and (best is None or cost + price + ahead[onto, into][0] < best):
                    best = cost + price + ahead[onto, into][0]
    if best is None:
        return None
    # A cheapest path either has a node that both have settled, or steps from one's last node to the other's.
    audits = [audit + behind[node][1] for node, (cost, audit) in ahead.items()
              if node in behind and cost + behind[node][0] == best]
    for node, (cost, audit) in ahead.items():
        audits += [audit + letter + behind[onto, into][1] for price, onto, into, letter in _onward(steps, *node)
                   if (onto, into) in behind and cost + price + behind[onto, into][0] == best]
    return best, min(audits)


# Putting the pieces of a conversation together.

class _Trail:
    """Edits up to a border between pieces: their cost, and the audit of the last piece behind an earlier trail."""

    __slots__ = ("cost", "audit", "earlier")

    def __init__(self, cost: int, audit: str, earlier: _Trail | None):
        self.cost, self.audit, self.earlier = cost, audit, earlier

    def before(self, other: _Trail) -> bool:
        """Cheaper, or as cheap with the lesser audit. Trails to one border have as many parts; they are read back to where they part."""
        if self.cost != other.cost:
            return self.cost < other.cost
        mine, yours, here, there = [], [], self, other
        while here is not there:
            mine.append(here.audit)
            yours.append(there.audit)
            here, there = here.earlier, there.earlier
        return "".join(reversed(mine)) < "".join(reversed(yours))

    def whole(self) -> str:
        parts, here = [], self
        while here is not None:
            parts.append(here.audit)
            here = here.earlier
        return "".join(reversed(parts))


def _solve_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by place to the cheapest edits of each conversation in each piece.

    Only the first and the last conversation of a piece can go on beyond it; they are searched between all states.
    """
    columns = ["conv", "piece", "entered", "left", "cost", "audit", "blank", "duplicate", "truncated", "first", "last", "illegal"]

    def solved(piece: int, groups: list[tuple[str, list, list]]) -> pd.DataFrame:
        rows = []
        for k, (conv, steps, faults) in enumerate(groups):
            key = tuple(steps)
            initials = [initial for initial, _ in steps]
            illegal = sum(a + b not in GOOD_PAIRS for a, b in zip(initials, initials[1:]))
            facts = [sum(f == fault for f in faults) for fault in (1, 2, 3)] + [initials[0], initials[-1], illegal]
            inner = 0 < k < len(groups) - 1
            for entered in (START,) if inner else range(4):
                for left in (ENDS,) if inner else ((START,), (SYSTEM,), (USER,), (ASSISTANT,)):
                    found = cheapest(key, entered, left)
                    if found is not None:
                        rows.append((conv, piece, entered, left[-1], *found, *facts))
        return pd.DataFrame(rows, columns=columns)

    piece, groups = None, []
    for batch in batches:
        for at, conv, initial, fault in zip(batch["piece"], batch["conv"], batch["initial"], batch["fault"], strict=True):
            if at != piece and groups:
                yield solved(piece, groups)
                groups = []
            piece = at
            if not groups or groups[-1][0] != conv:
                groups.append((conv, [], []))
            groups[-1][1].append((initial, LOST if fault in (1, 2) else TRUNCATED if fault == 3 else KEPT))
            groups[-1][2].append(fault)
    if groups:
        yield solved(piece, groups)


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of a conversation in order to its edits and counts."""
    columns = ["conv", "cost", "audit", "blank", "duplicate", "truncated", "illegal"]
    conv, piece, trails, onward, totals, last = None, None, {}, {}, [], None

    def closed() -> tuple:
        best = None
        for state in ENDS:
            if state in onward and (best is None or onward[state].before(best)):
                best = onward[state]
        return conv, best.cost, best.whole(), *totals

    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.conv != conv:
                if conv is not None:
                    out.append(closed())
                conv, piece, onward, totals, last = row.conv, None, {START: _Trail(0, "", None)}, [0, 0, 0, 0], None
            if row.piece != piece:
                piece, trails, onward = row.piece, onward, {}
                totals[0] += row.blank
                totals[1] += row.duplicate
                totals[2] += row.truncated
                totals[3] += row.illegal + (last is not None and last + row.first not in GOOD_PAIRS)
                last = row.last
            if row.entered in trails:
                trail = _Trail(trails[row.entered].cost + row.cost, row.audit, trails[row.entered])
                if row.left not in onward or trail.before(onward[row.left]):
                    onward[row.left] = trail
        if out:
            yield pd.DataFrame(out, columns=columns)
    if conv is not None:
        yield pd.DataFrame([closed()], columns=columns)


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A conversation's edits and then its rows, as one stream, to the repaired conversation."""
    columns = ["conv", "place", "role", "text"]
    conv, audit, at, state, number = None, "", 0, START, 0

    def emit(out: list, role: str, text: str) -> None:
        nonlocal state, number
        state = AFTER[state][role[:1]]
        out.append((conv, number, role, text))
        number += 1

    def insert(out: list) -> None:
        nonlocal at
        while audit[at: at + 1] == "I":
            at += 1
            emit(out, FORCED[state], "")

    for batch in batches:
        out: list = []
        for key, is_row, role, text in zip(batch["conv"], batch["is_row"], batch["role"], batch["text"], strict=True):
            if not is_row:
                # Inserts that end the last conversation were made after its last row.
                conv, audit, at, state, number = key, text, 0, START, 0
                insert(out)
                continue
            letter = audit[at]
            at += 1
            if letter == "K":
                emit(out, role, text)
            elif letter == "R":
                emit(out, FORCED[state], text)
            insert(out)
        yield pd.DataFrame(out, columns=columns).astype({"place": "int64"})


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired rows in order to one digest a conversation."""
    conv, digest = None, None
    for batch in batches:
        out = []
        for key, role, text in zip(batch["conv"], batch["role"], batch["text"], strict=True):
            if key != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if out:
            yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
    if digest is not None:
        yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "repaired_sha256"])


# The job.

def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text) of all rows: NULL roles and texts are one space, ``conv`` names the conversation.

    A NULL conv_id is a conversation of its own.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(" "))
    return conversations.select(conv.alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as a bad export leaves them, by the checksum of conversation and turn modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets its role to user.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.filter(kind != 0).select("conv", "conv_id", "turn", role.alias("role"), text.alias("text"),
                                          F.explode(copies).alias("copy")).drop("copy"))


def _facts() -> list[Column]:
    """What the lattice and the counts need to know of a row; texts are not moved for them."""
    seen = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return [F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(_WORD)).alias("is_blank"),
            F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("has_end"),
            F.sha2(seen.cast("binary"), 256).alias("seen")]


def _fault() -> Column:
    """1 blank, 2 duplicate, 3 truncated, 0 none; the first that holds."""
    return F.when(F.col("is_blank"), 1).when(F.col("is_first").isNull(), 2).when(~F.col("has_end"), 3).otherwise(0)


def repair(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK, piece_bits: int = PIECE_BITS) -> tuple[DataFrame, DataFrame]:
    """The edits of every conversation of ``rows`` (conv, turn, role, text), and the repaired rows.

    Edits: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit); repaired: (conv, place, role, text).
    Rows of a conversation go by turn, NULL first, rows of one turn by role and text. A repeated row is a duplicate;
    an empty role has no initial that fits anywhere. An empty table gives no edits and no rows.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, "repair-rows")
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    tied = rows.select("conv", "turn", "role", "text").withColumn("tie", F.monotonically_increasing_id())
    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // rows_per_task))
    # The high bits of a place are the partition, the low ones count its rows: written once, so that a retry finds the same places.
    (tied.repartitionByRange(parts, *order, "tie").sortWithinPartitions(*order, "tie")
     .select("conv", "turn", "role", "text", *_facts(), F.monotonically_increasing_id().alias("place"))
     .write.parquet(path))
    placed = spark.read.parquet(path).withColumn("piece", F.shiftright("place", piece_bits))
    # A text's first row is found piece by piece, so a repeated row is as many keys as it has pieces.
    by_piece = placed.groupBy("conv", "seen", "piece").agg(F.min("place").alias("place"))
    firsts = by_piece.groupBy("conv", "seen").agg(F.min("place").alias("place"))
    # Places are unique, so no key of this join is hot.
    marked = (placed.select("conv", "piece", "place", "initial", "is_blank", "has_end")
              .join(firsts.select("place", F.lit(True).alias("is_first")), "place", "left"))
    judged = marked.select("conv", "piece", "place", "initial", _fault().alias("fault"))
    pieces = (judged.repartition("piece").sortWithinPartitions("place")
              .mapInPandas(_solve_pieces, "conv string, piece long, entered int, left int, cost long, audit string, "
                                          "blank long, duplicate long, truncated long, first string, last string, illegal long"))
    edits = (pieces.repartition("conv").sortWithinPartitions("conv", "piece")
             .mapInPandas(_put_together, "conv string, cost long, audit string, blank long, duplicate long, "
                                         "truncated long, illegal long"))
    turns = placed.groupBy("conv", "turn").agg(F.lit(1))
    spans = turns.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    edits_path = shared_folder(spark, "repair-edits")
    edits.join(spans, "conv").write.parquet(edits_path)
    edits = spark.read.parquet(edits_path)
    stream = (edits.select("conv", F.lit(False).alias("is_row"), F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"),
                           F.col("audit").alias("text"))
              .unionByName(placed.select("conv", F.lit(True).alias("is_row"), "place", "role", "text")))
    repaired = (stream.repartition("conv").sortWithinPartitions("conv", "place")
                .mapInPandas(_repaired, "conv string, place long, role string, text string"))
    return edits, repaired


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(rows: DataFrame, edits: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``: conv_id, the counts, cost, audit and repaired_sha256; zeros where no row is left."""
    # The repaired rows come by conversation and in order already.
    hashed = repaired.mapInPandas(_digests, "conv string, repaired_sha256 string")
    ids = rows.groupBy("conv", "conv_id").agg(F.lit(1)).select("conv", "conv_id")
    empty = hashlib.sha256().hexdigest()
    return (ids.join(edits, "conv", "left").join(hashed, "conv", "left")
            .select("conv_id", *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in COUNTS],
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")))
