"""Near duplicates against all pairs of full sets."""

import random

import numpy as np
import pytest
from plain_neardup import plain_groups

from odflow.llm import neardup

SCHEMA = "doc_id long, text string, node string, key_id string, row string"


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def cases():
    rng = random.Random(5)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 300))]
        for _ in range(rng.randrange(1, 6)):
            rows.append(edited(rng, base, rng.choice([0, 0, 1, 2, 3, 5])))
    hot = [f"h{rng.randrange(300)}" for _ in range(120)]
    rows += [edited(rng, hot, rng.randrange(0, 9)) for _ in range(150)]
    rows += ["same text of six words here"] * 40 + ["one two", "ONE  two", "one", "", None, " \n", "", "word " * 30_000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block_shingles", [300_000, 2_000])
def test_groups_equal_all_pairs(spark, block_shingles):
    rows = cases()
    docs = spark.createDataFrame([(d, t, "n", "k", "r") for d, t in rows], SCHEMA).repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in neardup.near_duplicates(docs, 85, block_shingles=block_shingles).collect()}
    assert len(got) == len(rows)
    for doc_id, n, component in plain_groups(rows, 85):
        assert got[doc_id] == (n, component, doc_id == component)


def test_large_files_of_a_class(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FILE_MEMBERS", 8)
    rows = cases()
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()}
    assert all(got[doc_id] == component for doc_id, _, component in plain_groups(rows, 85))


def test_deduplicate_keeps_one_row_of_each_group(spark):
    rows = cases()
    rows += [(3, rows[3][1]), (None, "a row without an id at all"), (None, rows[5][1])]
    docs = spark.createDataFrame([(d, t, "n", None, "r") for d, t in rows], SCHEMA)
    kept = neardup.deduplicate(docs, 80)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    wanted = {d for d, n, component in plain_groups(rows, 80) if d is not None and d == component}
    assert sorted(d for d in ids if d is not None) == sorted(wanted) and ids.count(None) == 1


def test_empty_table_and_lone_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(docs).collect() == [] and neardup.deduplicate(docs).collect() == []
    alone = spark.createDataFrame([(None, "x y z")], "doc_id long, text string")
    row = neardup.near_duplicates(alone).collect()[0]
    assert row["component_id"] is None and row["kept"] and row["n_shingles"] == 1


def test_signatures_within_the_distance_share_a_file():
    shape = neardup.Signatures()
    rng = np.random.default_rng(3)
    import pandas as pd
    for _ in range(50):
        a = rng.integers(0, 1 << 16, shape.values, dtype=np.uint16)
        b = a.copy()
        where = rng.choice(shape.values, shape.distance, replace=False)
        b[where] ^= 1
        batch = pd.DataFrame({"node": [1, 2], "sign": [a.tobytes(), b.tobytes()]})
        files = pd.concat(list(neardup._file_keys(shape)(iter([batch]))))
        assert files.groupby("file")["node"].nunique().max() == 2
