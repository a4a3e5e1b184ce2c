"""The operators bound to the test tables, one query each, with checking SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import (audit, bpe, credentials, fingerprints, importance, jaccard, mixing, rules, sharding, sitequality,
                          tokenbin, toxicity, warc)
from wardlens.llm.common import held_out
from wardlens.llm.oracles import ORACLES  # noqa: F401  read beside QUERIES
from wardlens.session import scratch_path

WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_table(spark, sf_dir, "documents")).taken()


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, lexicon)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "hits"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.merged_index(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitequality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    tokenbin.write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_BPE))
    return tokenbin.read_documents(spark, folder)


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs, _table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, "text", public_tokenizers.path(WORD_BPE), "ids", "decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("same"))
    placed = sharding.assign(rows, "same", "size", 24).drop("same")
    numbered = sharding.number_rows(placed, "shard", ["doc_id", "size", "text_crc32"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                           F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(audit.combinations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def op13_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_ngram_jaccard, op3_toxicity, op4_warc, op5_fingerprints, op6_site_quality, op7_token_files,
    op8_decision_list, op9_bpe, op10_sharding, op11_importance, op12_filter_audit, op13_credentials)}
