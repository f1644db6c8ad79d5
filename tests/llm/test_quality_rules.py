"""Quality rules against a plain count, and their queries against SQL."""

import re

import duckdb
import pytest

from odflow.llm import quality_rules
from odflow.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, kept string, row string, _words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
GOOD = "This is a sentence that says something. " * 3


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    repeated = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))


TEXTS = [None, "", "\n\n", "one", "one two", "a b c", "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z", "#*$%&|<> tab\there\x0bv\x0cf",
         "é😀 ß " * 30, "w " * 3000, "a b c d " * 40, "nbsp joins words", GOOD]


def test_counts_equal_a_plain_version(spark):
    rows = [(k, text, "k", "r", "w") for k, text in enumerate(TEXTS)] + [(1, "", None, None, None), (None, GOOD, None, None, None)]
    got = quality_rules.measure(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, chars, symbols, dup, repeated = plain(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and not (r["base_failed"] and r["kept"])
    assert quality_rules.measure(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lines_are_judged_one_by_one(spark):
    text = " ".join(f"word{k}" for k in range(60)) + ".\nHome | About\nAll rights reserved.\nBUY!! NOW!! HERE!!\nno mark here\n\n###### a."
    docs = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, n_chars long")
    row = quality_rules.measure(docs).first()
    assert row["n_failed_lines"] == 5 and row["kept"] and row["clean_text"] == text.split("\n")[0] + "\n"
    cleaned = quality_rules.clean(docs).first()
    assert cleaned["text"] == row["clean_text"] and cleaned["n_chars"] == len(row["clean_text"])


def test_a_document_that_loses_too_much_is_rejected(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)) + ".", "\n".join(f"menu{k} | item{k} | page{k}" for k in range(60))
    docs = spark.createDataFrame([(1, good), (2, good + "\n" + bad)], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality_rules.measure(docs).collect()} == {1: True, 2: False}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    got = QUERIES[name](spark, sf_dir)
    wanted = db.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    order = sorted(got.columns)

    def rows(found):
        return sorted(repr(row) for row in found)

    assert rows(tuple(r[c] for c in order) for r in got.collect()) == rows(wanted.select(", ".join(order)).fetchall())


def test_no_python_in_the_native_plans(spark, sf_dir, capsys):
    for name in ("op1_secret_scan", "op4_quality_rules"):
        QUERIES[name](spark, sf_dir).explain("formatted")
        plan = capsys.readouterr().out
        assert plan and not re.search("Python|Pandas|Arrow", plan), name
