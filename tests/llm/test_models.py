"""Language identification and the quality model: held-out accuracy, plain versions, odd rows."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odflow.llm import common, langid, quality_model
from odflow.llm.queries import QUERIES

ODD = [None, "", " \n", "123 --", "a", "ß", "the " * 100_000]
SCHEMA = "doc_id long, text string, lang string, score string, row string, found string"


def test_hashed_ngrams_of_a_long_text_equal_those_of_its_whole(monkeypatch):
    text = "abcäöü😀" * 50
    whole = np.concatenate(list(common.hashed_ngrams(text, (1, 2, 3), 12)))
    monkeypatch.setattr(common, "PIECE_CHARS", 17)
    pieces = np.concatenate(list(common.hashed_ngrams(text, (1, 2, 3), 12)))
    assert len(whole) == 3 * len(text) - 3 and sorted(whole) == sorted(pieces)


def test_language_scores_equal_a_plain_version(spark):
    rows = [(k, text, lang) for k, (text, lang) in enumerate([("the cat", "en"), ("the dog", "en"), ("le chat", "fr"), (None, "fr")])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["en", "fr"]

    def grams(text):
        return [g for part in common.hashed_ngrams(text.lower(), langid.ORDERS, langid.BITS) for g in part]

    seen = {"en": grams("the cat") + grams("the dog"), "fr": grams("le chat")}
    for text in ("The hat", "le rat", "x"):
        total = {}
        for lang, share in (("en", 2 / 3), ("fr", 1 / 3)):
            size = len(seen[lang]) + langid.SMOOTHING * (1 << langid.BITS)
            total[lang] = math.log(share) + sum(math.log((seen[lang].count(g) + langid.SMOOTHING) / size) for g in grams(text))
        best = max(sorted(total), key=total.get)
        lang, score = langid.score_text(text, model)
        assert lang == best
        assert score == pytest.approx(1 / sum(math.exp(t - total[best]) for t in total.values()), rel=1e-3)


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame([(k, text, None, "s", "r", "f") for k, text in enumerate(ODD)] + [(None, "le", "fr", None, None, None)] * 2,
                                 SCHEMA)
    model = langid.train(spark.createDataFrame([("the a ß", "en"), ("le la", "fr")], "text string, lang string"))
    found = langid.identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "row", "found", "lang_pred", "score"]
    got = found.orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert [r["lang_pred"] for r in got[:4]] == ["und"] * 4 and all(r["score"] == 0 for r in got[:4])
    assert all(r["lang_pred"] in ("en", "fr") and 0 <= r["score"] <= 1 for r in got[4:]) and len(got) == len(ODD) + 2
    assert langid.known(docs, model, 0.0).count() == len(ODD) - 4 + 2
    assert langid.known(docs, model, 0.0).columns == docs.columns
    empty = langid.train(docs.limit(0))
    assert empty.langs == [] and {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op3_language_id"](spark, sf).join(common.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99


def test_fit_separates_and_its_descent_is_optimal():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 20) + 40 * (k % 2)).astype(np.int32) for k in range(200)]
    good = np.array([k % 2 for k in range(200)])
    model = quality_model.fit(rows, good)
    assert np.mean([(quality_model.margin(r, model) > 0) == g for r, g in zip(rows, good, strict=True)]) > 0.97


def test_quality_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(k, text, "x") for k, text in enumerate(ODD)], "doc_id long, text string, score string")
    for labels, expected in (([], 0.5), ([(1, 1), (4, 1), (2, None), (None, 1), (5, 7)], 0.75)):
        model = quality_model.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
        got = quality_model.score(docs, model).collect()
        assert len(got) == len(ODD) and all(r["score"] == pytest.approx(expected) for r in got)
    assert quality_model.score(docs.limit(0), model).collect() == []


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = common.table(spark, sf, "labels").select("doc_id", "quality")
    found = QUERIES["op9_quality_model"](spark, sf).collect()
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in quality]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert np.mean([r["predicted"] == quality[r["doc_id"]] for r in held]) > 0.93
