"""The contract queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import byte_bpe, centroids, embedding_dedup, fingerprint, language_id, line_dedup, minhash, oracles, packing, quality_rules, ranked_search, suffix_array, toxicity, warc
from siftline.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeats(table(spark, sf_dir, "documents"), length=400, keep="none", digests=True)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edited(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn(docs.where(language_id.remainder("doc_id", 4) != 2))
    found = language_id.predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", F.coalesce(language_id.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"), digests=True)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    return packing.pack(parts, capacity=2048)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"), min_payload=0)
    return warc.read_all(spark, archive)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(language_id.remainder("doc_id", 5) != 0).select("doc_id", "toxic")
    # one kind of join at every size: labels grow with the documents, so they are never broadcast
    model = toxicity.learn(docs.join(labels.hint("merge"), "doc_id").withColumnRenamed("doc_id", "id"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    held_out = F.coalesce(language_id.remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_byte_bpe, op2_suffix_dedup, op3_minhash, op4_embedding_dedup, op5_fingerprint, op6_language_id, op7_line_dedup, op8_best_fit_packing, op9_warc, op10_toxicity,
              op11_centroid_clustering, op12_ranked_search, op13_quality_rules)
}
ORACLE_SQL: dict[str, str] = {"op3_minhash": oracles.MINHASH, "op4_embedding_dedup": oracles.EMBEDDINGS, "op7_line_dedup": oracles.LINES, "op9_warc": oracles.WARC,
                              "op11_centroid_clustering": oracles.CENTROIDS, "op12_ranked_search": oracles.SEARCH}
