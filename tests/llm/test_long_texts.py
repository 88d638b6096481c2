"""Very long texts, and rows whose every column is null, through each text operator."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siftline.llm import byte_bpe, fingerprint, language_id, line_dedup, minhash, packing, suffix_array, toxicity


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    text = " ".join(rng.choice(words) for _ in range(200_000))
    rows = [(1, text, "en"), (2, text[: len(text) // 2] + "\n" + text[len(text) // 2 :], "en"), (None, None, None), (3, "x" * 200_000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").cache()


def test_encoding(spark, long_docs):
    rows = byte_bpe.round_trip_digests(long_docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    want = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in long_docs.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in rows} == want


def test_deduplication(spark, long_docs):
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffix_array.remove_repeats(long_docs, 400).collect()}
    # windows over the newline are new; all others are in the other text too
    assert cut[1] == (cut[1][0], cut[1][0]) and cut[2] == (cut[1][0] + 1, cut[1][0]) and cut[3] == (200_000, 200_000) and cut[None] == (0, 0)
    near = {r["doc_id"]: r["component_id"] for r in minhash.link(long_docs).collect()}
    assert near == {1: 1, 2: 1, 3: 3, None: None}
    lines = {r["doc_id"]: r["n_units"] for r in line_dedup.remove_repeated_lines(long_docs).collect()}
    assert lines == {1: 1, 2: 2, 3: 1, None: 0}


def test_models_and_packing(spark, long_docs):
    found = language_id.predict(long_docs, language_id.learn(long_docs)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == {1: "en", 2: "en", 3: "en", None: "und"}
    scored = toxicity.score(long_docs, toxicity.learn(long_docs.select(F.col("doc_id").alias("id"), "text", F.lit(0).alias("toxic"))))
    assert scored.where("toxic_score between 0 and 1").count() == 4
    packed = packing.pack(packing.pieces(long_docs, public_tokenizers.path("word_bpe_49k.json")), 2048)
    assert packed.where("length > 2048 or offset + length > 2048").count() == 0
    assert packed.where("doc_id is null").count() == 1


def test_fingerprints(spark, long_docs):
    got = {r["doc_id"]: r["n_chars"] for r in fingerprint.compare_with_edited(long_docs).collect()}
    assert got == {r["doc_id"]: len(r["text"] or "") for r in long_docs.collect()}
