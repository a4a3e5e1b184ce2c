"""The corpus pipeline: quality rules, toxicity, near duplicates, mixing, token ids.

All stages take the columns of documents and drop others, so clashing names do
no harm; an empty table gives an empty one; very long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import bpe, jaccard, mixing, rules, toxicity
from wardlens.llm.queries import WORD_BPE
from wardlens.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep.

    Null and empty texts fail the base rules and go; repeated rows are judged alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules.judge(docs, labels).where("kept").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned on those at hand, does not call toxic.

    Null and empty texts have no hits and stay; repeated rows are judged alike.
    """
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, lexicon).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least id.

    Null and empty texts are copies of each other; of repeated rows one stays.
    """
    return jaccard.representatives(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: a row per document and pass, its text the words taken.

    Texts without words are not taken; a null source is a source; repeated rows are documents of their own.
    """
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    taken = mixing.Mix(keyed, order=["doc_id", "lang", "text_key"]).texts()
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row, and what they decode to; none for null and empty texts."""
    coded = bpe.encode(docs.select("doc_id", "text"), "text", public_tokenizers.path(WORD_BPE), "ids", "decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality rules", quality_rules), ("toxicity", drop_toxic), ("n-gram jaccard join", drop_near_copies),
          ("mixing sources", mix_sources), ("bpe", token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
