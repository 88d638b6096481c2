"""The corpus pipeline: stages over `documents`, each written as Parquet and reread as the next one's input.

Every stage but the last returns the columns of its input. Rows with a null id pass through every stage; rows that share
an id stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import language_id, minhash, packing, suffix_array, toxicity
from siftline.llm.common import materialize, table

#: Least likeness to the nearest language profile. Prose of a learned language has 0.4 and more; random letters, hex and
#: other languages in the same script share single letters and have less than 0.25.
MIN_LANGUAGE_SCORE = 0.3
TOXIC = 0.5
#: Bytes of a repeated passage, about 50 of the shortest common words.
PASSAGE_BYTES = 200
SEQUENCE_TOKENS = 2048


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts like no language that the corpus is labelled with."""
    profiles = language_id.learn(docs)
    found = language_id.predict(docs, profiles)
    return found.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score reaches TOXIC; learned from the labels of the documents at hand."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").hint("merge")
    model = toxicity.learn(docs.select("doc_id", "text").join(labels, "doc_id").withColumnRenamed("doc_id", "id"))
    return toxicity.score(docs, model).where(F.col("toxic_score") < TOXIC).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 on five-word shingles, the smallest id of each component stays."""
    linked = minhash.link(docs, width=5, percent=80)
    gone = materialize(linked.where("not kept and doc_id is not null").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def keep_first_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document, or an earlier place in the same one, has; documents themselves stay."""
    cut = suffix_array.remove_repeats(docs, length=PASSAGE_BYTES, keep="first")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most SEQUENCE_TOKENS: a row per piece with its sequence and offset."""
    parts = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=SEQUENCE_TOKENS)
    return packing.pack(parts, capacity=SEQUENCE_TOKENS)


STAGES = [
    ("language_id", keep_known_language),
    ("toxicity", keep_civil),
    ("minhash", keep_one_of_near_copies),
    ("suffix_array", keep_first_passages),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
