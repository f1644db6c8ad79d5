"""Order MinHash against a plain version with the same hash, and its sense of order."""

import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from odflow.llm import order_minhash as om

MASK = (1 << 64) - 1


def hash_string(text, seed):
    return xxhash.xxh64_intdigest(text.encode(), seed=seed)


def hash_long(value, seed):
    return xxhash.xxh64_intdigest(struct.pack("<Q", value & MASK), seed=seed)


def hash_int(value, seed):
    # Four bytes hash like a tail of four bytes.
    return xxhash.xxh64_intdigest(struct.pack("<I", value), seed=seed)


def plain_slots(text, k=3, slots=64):
    words = re.findall(r"[^\x20\x09-\x0D]{1,48}", text or "")
    keep = MASK ^ ((1 << 28) - 1)
    if len(words) >= k:
        grams = []
        for at in range(len(words) - k + 1):
            seed = 42
            for word in words[at: at + k]:
                seed = hash_string(word, seed)
            grams.append(seed & keep)
    else:
        grams = [hash_string(" ".join(words), 42) & keep] if words else []
    seen, bins = {}, {}
    for at, gram in enumerate(grams):
        number = seen.get(gram, 0)
        seen[gram] = number + 1
        mixed = hash_int(number, hash_long(gram, 42)) & keep
        bins.setdefault(mixed >> (65 - slots.bit_length()), []).append((mixed if mixed < 1 << 63 else mixed - (1 << 64), at))
    out = {}
    for place, members in bins.items():
        least = sorted(members)[:2]
        seed = 42
        for mixed, _ in sorted(least, key=lambda m: m[1]):
            seed = hash_long(mixed, seed)
        out[place] = seed >> 32
    return out


def as_text(slots):
    return "".join(f"{place << 32 | value:010x}" for place, value in sorted(slots.items()))


def alike(a, b):
    either = a.keys() | b.keys()
    return sum(a.get(p) == b.get(p) for p in either) / len(either) if either else 1.0


SCHEMA = "doc_id long, text string, slots int, n_chars string, next_text string, _at int, _block string"


def run(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "clash", "x", 2, "y") for r in rows], SCHEMA)
    return om.fingerprints(table.repartition(3), **options).collect()


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for (i, text), (_, after) in zip(rows, [*rows[1:], *rows[:1]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new = plain_slots(text), plain_slots(edited)
        out.append((i, len(text), edited, as_text(own), as_text(new), alike(own, new), alike(own, plain_slots(after))))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("block_rows", [1000, 1, 7])
def test_all_kinds_of_texts(spark, sf_dir, block_rows):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()][:120]
    rows += [(None, "no id at all here"), (None, None), (1000, ""), (1001, None), (1002, "one"), (1003, "one two"), (1004, " \t\n"),
             (1005, "a b c " * 500), (1005, "a b c " * 500), (1005, "twice 𝔸 é"), (-5, "𝔸𝔹 ö " * 9), (1 << 40, "z" * 5000)]
    got = [(r.doc_id, r.n_chars, r.edited_text, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
           for r in run(spark, rows, block_rows=block_rows)]
    assert order(got) == order(expected(rows))


def test_one_document_and_none(spark):
    got, = run(spark, [(4, "it is its own next document")])
    assert got.near_next == 1.0 and got.edited_text == "it is its own " + "it is its own"
    assert run(spark, []) == []


def test_a_very_long_text(spark):
    rows = [(1, "lorem ipsum dolor " * 60_000 + "end"), (2, "x y z")]
    got = [(r.doc_id, r.n_chars, r.edited_text, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in run(spark, rows)]
    assert order(got) == order(expected(rows))


def test_order_matters_and_edits_cost_likeness(spark):
    words = [f"w{k * 7919 % 1009}" for k in range(1000)]
    swapped = words[500:] + words[:500]
    one = [*words[:300], "new", *words[301:]]
    half = words[:500] + [f"v{k}" for k in range(500)]
    rows = [(k, " ".join(text)) for k, text in enumerate([words, swapped, one, half])]
    table = om.with_slots(spark.createDataFrame(rows, "doc_id long, text string"), "text", "s")
    pairs = table.alias("a").join(table.alias("b").filter("doc_id = 0").select(F.col("s").alias("t")))
    near = {r.doc_id: r.near for r in pairs.select("doc_id", om.likeness("s", "t").alias("near")).collect()}
    # The k-mers of the swapped text are nearly all the same; half of their pairs have changed order.
    assert near[0] == 1.0 and near[2] > 0.9 and 0.2 < near[1] < 0.8 and near[3] < 0.3


def test_columns_only(spark, sf_dir):
    plan = om.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
