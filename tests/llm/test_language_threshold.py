"""The pipeline's language stage rejects junk and languages that were not learned, and keeps prose."""

import os
import random

import corpus_pipeline
from siftline.llm import language_id
from siftline.llm.common import table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
POLISH = "W Szczebrzeszynie chrząszcz brzmi w trzcinie i Szczebrzeszyn z tego słynie, że chrząszcz w nim brzmi, a ludzie mówią o tym przez całe życie. "


def test_junk_and_unlearned_languages_are_rejected(spark):
    rng = random.Random(3)
    letters = lambda n, of: " ".join("".join(rng.choice(of) for _ in range(rng.randrange(2, 10))) for _ in range(n))
    junk = [letters(n, "abcdefghijklmnopqrstuvwxyz") for n in (20, 100, 1000)] + [letters(n, "0123456789abcdef") for n in (20, 400)] + [POLISH, POLISH * 5]
    docs = table(spark, SF, "documents")
    extra = spark.createDataFrame([(10**6 + i, t, None, "s", 0) for i, t in enumerate(junk)], docs.schema)
    scores = [language_id.learn(docs).predict(t)[1] for t in junk]
    kept = corpus_pipeline.keep_known_language(spark, docs.unionByName(extra), SF)
    assert kept.where("doc_id >= 1000000").count() == 0, scores
    assert kept.count() >= 0.99 * docs.where("length(text) > 20").count()
