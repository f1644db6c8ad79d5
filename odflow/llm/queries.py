"""The operators as queries over the whole of their tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from odflow.llm import (chat, langid, mixing, mtree, neardup, oracles, order_minhash, quality_model, quality_rules, repair,
                        secrets, sentencepiece, warc, whitening)
from odflow.llm.common import id_remainder, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, oracle: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query
    return add


@_register("op1_secret_scan", oracles.SECRETS)
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in secrets.RULES if rule.base]
    based = F.filter("secrets", lambda s: s["rank"] < len(base))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select("doc_id", *map(count, base), F.sha2(secrets.span_list(based).cast("binary"), 256).alias("base_sha256"),
                          secrets.span_list(F.col("secrets")).alias("spans"))


@_register("op2_chat_format", oracles.CHATS)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_chats(chat.as_log(rows)))


@_register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(id_remainder(F.col("doc_id"), 3) != 1))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    found = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@_register("op4_quality_rules", oracles.QUALITY)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rules.measure(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "n_failed_lines", "base_failed", "kept")


@_register("op5_near_dedup", oracles.NEAR_DUPLICATES)
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


@_register("op6_warc", oracles.WARC)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_bundles(table(spark, sf_dir, "pages"), path)
    return warc.read_index(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_register("op7_mix_sources")
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "documents").select("doc_id", "source").withColumn("key", F.xxhash64("doc_id"))
    return mixing.schedule(keys, ["key", "doc_id"]).select("doc_id", "source", "rank", "block", "slot", "position")


@_register("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece.PieceModel.from_file(sentencepiece.MODEL_PATH)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode(docs, model).select("doc_id", "n_tokens", "ids", "round_trip")


@_register("op9_quality_model")
def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) != 0)
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = quality_model.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_register("op10_top_k", oracles.TOP_K)
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mtree.integer_vectors(table(spark, sf_dir, "embeddings"))
    return mtree.top_k(rows, rows.filter("id % 100 = 0"), k=10)


@_register("op11_repair", oracles.REPAIR)
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.rows_of(table(spark, sf_dir, "conversations"))
    return repair.digests(rows, *repair.repair(repair.damaged(rows)))


@_register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@_register("op13_order_minhash")
def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


_register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
