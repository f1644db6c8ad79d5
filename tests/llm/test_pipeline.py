"""The corpus pipeline: each stage against a plain version of itself on that stage's own input."""

import re

import pytest
from plain_neardup import plain_groups

import corpus_pipeline
from odflow.llm import langid, mixing, secrets, sentencepiece
from odflow.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage over the small documents and some odd rows."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    odd = [(9001, None, "en", "src0", 0), (9002, "", None, None, 0), (9003, "12345 67", "en", "src1", 8), (None, "un document sans nom", "fr", None, None),
           (9004, "the token=abcdefgh12 and the password: 'longenough'", "en", "src1", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long"))
    found = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
        out = spark.read.parquet(path)
        found.append((docs.collect(), out.collect(), out.columns))
        docs = out
    return found


def key(row):
    return tuple((v is None, v) for v in row)


def test_columns_and_order_of_the_stages(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secret_scan", "mixing", "sentencepiece"]
    assert all(columns == COLUMNS for _, _, columns in stages[:-1])


def test_known_languages(stages):
    given, got, _ = stages[0]
    wanted = [r for r in given if r["text"] is not None and re.search(r"[^\W\d_]", r["text"])]
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, wanted), key=key)


def test_one_document_of_each_group(stages):
    given, got, _ = stages[1]
    groups = plain_groups([(r["doc_id"], r["text"]) for r in given], 80)
    wanted = {d for d, _, component in groups if d == component}
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(d for d in wanted if d is not None)


def test_no_secret_is_left(stages):
    given, got, _ = stages[2]
    before = {r["doc_id"]: r for r in given}
    assert len(before) == len(got)
    for row in got:
        text, changed = before[row["doc_id"]]["text"], 0
        for rule in secrets.RULES:
            for match in re.finditer(rule.pattern, row["text"], re.ASCII):
                assert len(match.group(rule.group)) < rule.min_chars
            changed += any(len(m.group(rule.group)) >= rule.min_chars for m in re.finditer(rule.pattern, text, re.ASCII))
        assert (row["text"] != text) == bool(changed)


def test_mixing_keeps_all(stages):
    given, got, _ = stages[3]
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, given), key=key)


def test_tokens_decode(stages):
    given, got, columns = stages[4]
    model = sentencepiece.PieceModel.from_file(sentencepiece.MODEL_PATH)
    assert columns == [*COLUMNS, "position", "ids", "n_tokens", "round_trip"] and len(got) == len(given)
    for row in got:
        assert row["round_trip"] and sentencepiece.decode_ids(row["ids"], model) == row["text"]


def test_the_mixture_is_the_order_at_the_end(spark, stages):
    """Sources come at the places of the schedule of what the mixing stage was given."""
    given, got = stages[3][0], stages[4][1]
    keys = spark.createDataFrame([(k, r["source"]) for k, r in enumerate(given)], "key int, source string")
    wanted = [r["source"] for r in mixing.schedule(keys, ["key"]).orderBy("position").collect()]
    assert [r["source"] for r in sorted(got, key=lambda r: r["position"])] == wanted
    assert sorted(r["position"] for r in got) == list(range(len(got)))


EMPTY = "doc_id long, text string, lang string, source string, n_chars long, position string, ids int, row string"


def test_stages_on_an_empty_table_and_clashing_names(spark):
    rows = [(k, f"the words of a text number {k} and some more", "en", "s", 3, "clash", 4, "x") for k in (1, 2, 2, 3)] + [
        (9, "long " * 100_000, "en", None, 3, None, 4, "x"), (None, None, None, None, None, None, None, None)]
    for given in ([], rows):
        docs = spark.createDataFrame(given, EMPTY)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            columns = out.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
            if name != "sentencepiece":
                assert columns == EMPTY.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
        # Rows without a letter go, and repeated ones become one.
        assert docs.count() == (4 if given else 0)


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*COLUMNS, "position", "ids", "n_tokens", "round_trip"] and out.count() > 100
    assert langid.UNKNOWN == "und"
