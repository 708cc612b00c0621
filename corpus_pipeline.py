"""Cleaning a text corpus, stage by stage.

Each stage takes the documents that its predecessor kept and returns those that it keeps,
with the columns of ``documents``; the last one returns their tokens and the round trip.  Between stages the
documents are written as Parquet under the shared checkpoint folder and read again, so a
lost executor costs the running stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchwork.llm import decontamination, exact_dedup, jaccard_join, sentencepiece, toxicity as toxic
from batchwork.llm.common import load, text_or_empty, write_scratch
from batchwork.session import ensure_checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the PU classifier calls toxic (score >= 0.5)."""
    model = toxic.fit(docs, load(spark, sf_dir, "labels"))
    return toxic.score(docs, model, score_col="__toxic").where(F.col("__toxic") < 0.5).drop("__toxic")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text, the one with the smallest doc_id stays (null ids rank last)."""
    return exact_dedup.keep_first(docs, null_ids_stay=False)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that Jaccard links (five words, 0.8) hold together, the one with the smallest doc_id stays (null ids rank last)."""
    return jaccard_join.keep_one(docs, null_ids_stay=False)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a ten-word window of a benchmark item occurs."""
    return decontamination.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, and whether the text decoded from them is the text again (null as empty)."""
    encoded = sentencepiece.encode(docs.select("doc_id", "lang", "source", text_or_empty("text").alias("text")), decoded_col="decoded")
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.length("decoded").cast("long").alias("decoded_chars"), (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("benchmark decontamination", decontaminate), ("SentencePiece encoding and decoding", tokens)]

# a learned classifier and a tokenizer stand outside SQL: tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
