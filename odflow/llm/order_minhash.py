"""Document fingerprints by Order MinHash, with column functions only.

The units are words, runs of characters other than space and tab to carriage return, cut after
``WORD_CHARS`` characters; a k-mer is ``k`` words in a row. Equal k-mers of a text are numbered as
they occur, so each (k-mer, occurrence) is there once. Its hash deals it to one of ``slots`` bins; a bin
is one order of the k-mers, as in one-permutation hashing, and selects its ``PICKED`` smallest ones. These
go back into text order, and their tuple is hashed. Two texts agree in a slot only if they
have the same minimal k-mers in the same order, so moving a passage costs likeness as replacing it does,
which makes the share of agreeing slots follow the edit distance and not the set of k-mers alone.

One text is one row throughout: no k-mer leaves its row, and a text costs a few sorts of long arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD_CHARS = 48
WORDS_PER_KMER = 3
SLOTS = 64
# K-mers selected in a slot; two are the fewest that have an order.
PICKED = 2
# Rows to a block of neighbours, and blocks at most: their bounds are literals of the plan.
BLOCK_ROWS = 1000
FANOUT = 128
# Low bits of a packed long that hold a position: texts of up to 268 million words.
_PLACE_BITS = 28
_PLACE = (1 << _PLACE_BITS) - 1


def _packed(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long"))


def _hash_part(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(~_PLACE))


def _place_part(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACE))


def _kmers(words: str, k: int) -> Column:
    """The k-mers of a text as packed (hash, place); a text of fewer words is one k-mer."""
    starts = F.slice(F.col(words), F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))
    full = F.transform(starts, lambda first, at: _packed(
        F.xxhash64(first, *[F.get(F.col(words), at + step) for step in range(1, k)]), at))
    short = F.array(_packed(F.xxhash64(F.array_join(words, " ")), F.lit(0)))
    return F.when(F.size(words) >= k, full).when(F.size(words) > 0, short).otherwise(F.lit([]).cast("array<long>"))


def _repeats(kmers: str, wanted: bool) -> Column:
    """Of sorted k-mers those that equal the one before (``wanted``), or those that do not."""
    def chosen(kmer: Column, at: Column) -> Column:
        same = (at > 0) & (_hash_part(kmer) == _hash_part(F.get(F.col(kmers), at - 1)))
        return same if wanted else ~same

    return F.filter(F.col(kmers), chosen)


def _occurrence(kmer: Column, number: Column) -> Column:
    return _packed(F.xxhash64(_hash_part(kmer), number), _place_part(kmer))


def _numbered(firsts: str, later: str, starts: str) -> Column:
    """(k-mer, occurrence) as packed (hash, place); ``starts`` says where in ``later`` runs of equal k-mers start."""
    def run(start: Column, number: Column) -> Column:
        after = F.coalesce(F.get(F.col(starts), number + 1), F.size(later))
        return F.transform(F.slice(F.col(later), start + 1, after - start), lambda kmer, nth: _occurrence(kmer, nth + 1))

    return F.concat(F.transform(F.col(firsts), lambda kmer: _occurrence(kmer, F.lit(0))),
                    F.flatten(F.transform(F.col(starts), run)))


def _tuples(picked: str, shift: int) -> Column:
    """One slot per bin, (bin, 32-bit hash of its k-mers in text order) as one long, by rising bin."""
    def slot(kmer: Column, at: Column) -> Column:
        own = F.shiftrightunsigned(kmer, shift)
        before, after = F.get(F.col(picked), at - 1), F.get(F.col(picked), at + 1)
        first, second = _hash_part(kmer), _hash_part(after)
        pair = F.when(_place_part(kmer) <= _place_part(after), F.xxhash64(first, second)).otherwise(F.xxhash64(second, first))
        hashed = F.when(F.shiftrightunsigned(after, shift) == own, pair).otherwise(F.xxhash64(first))
        return F.when((at == 0) | (F.shiftrightunsigned(before, shift) != own),
                      F.shiftleft(own, 32).bitwiseOR(F.shiftrightunsigned(hashed, 32)))

    return F.sort_array(F.array_compact(F.transform(F.col(picked), slot)))


def with_slots(df: DataFrame, text: str, out: str, k: int = WORDS_PER_KMER, slots: int = SLOTS) -> DataFrame:
    """Add ``out``: the slots of the fingerprint of ``text``, longs of (bin, hash), for bins that have a k-mer.

    ``slots`` is a power of two. A text that is NULL or has no word has no slots; a text with fewer than
    k words has one. Equal texts have equal slots, and so have texts that differ in white space only.
    """
    if slots < 2 or slots & (slots - 1):
        raise ValueError("the number of slots is a power of two, at least 2")
    shift = 64 - (slots.bit_length() - 1)
    work = [f"_{out}_{name}" for name in ("words", "kmers", "firsts", "later", "starts", "numbered", "picked")]
    words, kmers, firsts, later, starts, numbered, picked = work
    # Each step is a column of its own, so that none is computed twice.
    df = df.withColumn(words, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{WORD_CHARS}}}"), 0))
    df = df.withColumn(kmers, F.sort_array(_kmers(words, k)))
    df = df.withColumns({firsts: _repeats(kmers, False), later: _repeats(kmers, True)})
    df = df.withColumn(starts, F.array_compact(F.transform(F.col(later), lambda kmer, at: F.when(
        (at == 0) | (_hash_part(kmer) != _hash_part(F.get(F.col(later), at - 1))), at))))
    df = df.withColumn(numbered, F.sort_array(_numbered(firsts, later, starts)))
    df = df.withColumn(picked, F.filter(F.col(numbered), lambda kmer, at: (at < PICKED) | (
        F.shiftrightunsigned(kmer, shift) != F.shiftrightunsigned(F.get(F.col(numbered), at - PICKED), shift))))
    return df.withColumn(out, _tuples(picked, shift)).drop(*work)


def as_text(slots: str) -> Column:
    """The fingerprint as a string: ten hexadecimal digits a slot, bin and hash; empty for a text without words."""
    return F.array_join(F.transform(F.col(slots), lambda slot: F.lower(F.lpad(F.hex(slot), 10, "0"))), "")


def likeness(left: str, right: str) -> Column:
    """The share of slots that agree, of those that either text has; texts without words are alike."""
    def bins(slots: str) -> Column:
        return F.transform(F.col(slots), lambda slot: F.shiftright(slot, 32))

    either = F.size(F.array_union(bins(left), bins(right)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / either)


def with_next(docs: DataFrame, order: str, carried: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``next_<name>`` of the row after in order of ``order``, a long, for each of ``carried``; the first follows the last.

    Rows without an order come first; rows of equal order go by the first of ``carried``. Rows are dealt into blocks of ids
    by the quantiles of ``order``, so that each is shuffled once; the first row of a block also goes, as a
    copy, to the block before. Quantiles only size the blocks, so an approximation of them does. Rows
    of one id share a block.
    """
    docs = docs.withColumn("_at", F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63))))
    wanted = min(FANOUT * FANOUT, max(1, -(-docs.count() // block_rows)))
    bounds = []
    if wanted > 1:
        at = [k / wanted for k in range(1, wanted)]
        bounds = sorted(set(docs.select(F.percentile_approx("_at", at, 10 * wanted)).first()[0] or []))
    docs = docs.withColumn("_block", _block("_at", bounds))
    # A row per block; a block without rows has no first one.
    least = {row["_block"]: row["least"] for row in docs.groupBy("_block").agg(F.min("_at").alias("least")).collect()}
    if not least:
        return docs.select("*", *[F.col(name).alias(f"next_{name}") for name in carried]).drop("_at", "_block")
    present = sorted(least)
    before = dict(zip(present, [present[-1], *present[:-1]], strict=True))
    blocks = range(len(bounds) + 1)
    back = F.element_at(F.lit([before.get(block, -1) for block in blocks]), F.col("_block") + 1)
    first = F.element_at(F.lit([least.get(block, 0) for block in blocks]), F.col("_block") + 1)
    # Behind the rows of the block before comes a copy of the first row; the copies of the very first one end the last block.
    own, copy = F.struct(F.lit(0).alias("copy"), "_block"), F.struct(F.lit(1).alias("copy"), back.alias("_block"))
    rows = docs.withColumn("_to", F.explode(F.when(F.col("_at") == first, F.array(own, copy)).otherwise(F.array(own))))
    ordered = Window.partitionBy("_to._block").orderBy("_to.copy", "_at", carried[0])
    nexts = [F.lead(name).over(ordered).alias(f"next_{name}") for name in carried]
    return rows.select("*", *nexts).filter("_to.copy = 0").drop("_at", "_block", "_to")


def _block(at: str, bounds: list[int]) -> Column:
    """How many bounds ``at`` has reached, found in two levels."""
    if not bounds:
        return F.lit(0)
    parts = [bounds[k: k + FANOUT] for k in range(0, len(bounds), FANOUT)]
    tops = F.lit([part[0] for part in parts])
    part = F.size(F.filter(tops, lambda bound: bound <= F.col(at)))
    within = F.filter(F.element_at(F.lit(parts), part), lambda bound: bound <= F.col(at))
    return F.when(part == 0, 0).otherwise((part - 1) * FANOUT + F.size(within))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS_PER_KMER,
                 slots: int = SLOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    (doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next). The edited text has
    its last half, floor(n_chars / 2) characters, replaced by the first as many (or all) of the next document
    by rising id; the last is followed by the first, a single document by itself. NULL texts are
    empty. Rows without an id come first, rows of equal id go by text; a repeated row is a document like
    others. Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    own = with_slots(texts, "text", "slots", k, slots)
    paired = with_next(own, "doc_id", ["text", "slots"], block_rows)
    paired = paired.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    paired = with_slots(paired.withColumn("edited_text", edited), "edited_text", "edited_slots", k, slots)
    return paired.select("doc_id", "n_chars", "edited_text", as_text("slots").alias("fingerprint"),
                         as_text("edited_slots").alias("edited_fingerprint"),
                         likeness("slots", "edited_slots").alias("near_edited"),
                         likeness("slots", "next_slots").alias("near_next"))
