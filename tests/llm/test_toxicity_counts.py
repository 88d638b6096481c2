"""Toxicity models equal a plain computation, and cover every word, context and labelled row."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.llm import toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    """1200 common words; a stem with many endings in toxic rows only, its letters in other places in ordinary ones; a
    word of its own in each row."""
    rows = []
    for i in range(120):
        toxic = int(i % 3 == 0)
        filler = [f"w{(i * 7 + j) % 1200}" for j in range(300)]
        rows.append((i, " ".join([*filler, *(["vile" + "abcdefghij"[i % 10]] * 2 if toxic else ["evil", "live"]), *(["insult"] if i in (0, 3, 6, 9, 12) else []), f"only{i}"]), toxic))
    return spark.createDataFrame(rows, "id long, text string, toxic int").repartition(2)


class Plain:
    """Kneser-Ney from the definition, by dictionaries of words and strings."""

    def __init__(self, rows, order=toxicity.ORDER, d=toxicity.D):
        self.order, self.d, self.n, self.words = order, d, [Counter(), Counter()], [Counter(), Counter()]
        for text, toxic in rows:
            for word in set(text.lower().split()):
                self.words[toxic][word] += 1
                self.n[toxic].update(self.strings(word))
        self.before = [None] * order
        strings = set(self.n[0]) | set(self.n[1])
        for width in range(order - 1, 0, -1):
            self.before[width] = Counter(s[1:] for s in strings)
            strings = set(self.before[width])

    def strings(self, word):
        s = "\x02" * (self.order - 1) + word + "\x03"
        return [s[i : i + self.order] for i in range(len(word) + 1)]

    def shared(self, s):
        if not s:
            return 1 / (len(self.before[1]) + 1)
        beside = {k: v for k, v in self.before[len(s)].items() if k[:-1] == s[:-1]}
        total = sum(beside.values())
        return (max(beside.get(s, 0) - self.d, 0) + self.d * len(beside) * self.shared(s[1:])) / total if total else self.shared(s[1:])

    def p(self, c, s):
        beside = {k: v for k, v in self.n[c].items() if k[:-1] == s[:-1]}
        total = sum(beside.values())
        return (max(beside.get(s, 0) - self.d, 0) + self.d * len(beside) * self.shared(s[1:])) / total if total else self.shared(s[1:])

    @staticmethod
    def sure(ratio, n, expected):
        if min(expected) == 0:
            return 0.0
        error = math.sqrt(sum(1 / max(x, e) for x, e in zip(n, expected, strict=True)))
        return math.copysign(max(abs(ratio) - toxicity.SURE * error, 0.0), ratio)

    def ratio(self, s):
        n, totals = [m[s] for m in self.n], [sum(v for k, v in m.items() if k[:-1] == s[:-1]) for m in self.n]
        if not sum(n):
            return 0.0
        return self.sure(math.log(self.p(1, s) / self.p(0, s)), n, [t * sum(n) / sum(totals) for t in totals])

    def word_ratio(self, w):
        n, totals = [m[w] for m in self.words], [sum(m.values()) for m in self.words]
        if not sum(n):
            return 0.0
        shared = sum(n) / sum(totals)
        p = [(max(m[w] - self.d, 0) + self.d * len(m) * shared) / t for m, t in zip(self.words, totals, strict=True)]
        return self.sure(math.log(p[1] / p[0]), n, [t * shared for t in totals])


def ratio(model, string):
    return float(model.sent.find(toxicity.codes_of([string]))[0])


@pytest.mark.parametrize("sent", [toxicity.SENT, 30, 0])
def test_model_and_evidence_equal_the_definition(spark, monkeypatch, sent):
    monkeypatch.setattr(toxicity, "SENT", sent)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    rows = [(i, " ".join([*(rng.choice(words) for _ in range(rng.randrange(1, 12))), *([words[i % 4]] if i % 2 else [])]), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, toxic int")
    counts = toxicity._count(df.withColumn("held", F.lit(0)))
    plain, model = Plain([r[1:] for r in rows]), toxicity._split(toxicity.Model(), toxicity._ratios(counts, F.col("n0"), F.col("n1")))
    every = set(plain.n[0]) | set(plain.n[1])
    got = counts.collect()
    assert {r["gram"]: (r["n0"], r["n1"]) for r in got if r["gram"]} == {s: (plain.n[0][s], plain.n[1][s]) for s in every}
    named = dict(zip(toxicity.codes_of([toxicity.WORD + w for w in words]).view(np.int64).tolist(), words, strict=True))
    assert {named[r["code"]]: (r["n0"], r["n1"]) for r in got if not r["gram"]} == {w: (plain.words[0][w], plain.words[1][w]) for w in set(plain.words[0]) | set(plain.words[1])}
    assert any(plain.word_ratio(w) for w in words) and any(plain.ratio(s) for s in every)
    if sent > len(every) + len(words):
        assert all(abs(ratio(model, s) - plain.ratio(s)) < 1e-5 for s in every)
    asked = ["cab a", "zzz", "abca new", words[0] + " " + words[1] * 2, *words, "?!", f"{words[1]} {words[1]} {words[2]} {words[3]}"]
    found = toxicity._evidence(spark.createDataFrame([*enumerate(asked), (len(asked), words[1])], "id long, text string"), model, "text", ["id"]).collect()
    assert len(found) == len(asked) + 1
    for r in found:
        own = set([*asked, words[1]][r["id"]].replace("?!", "").split())
        if not own:
            assert r["_siftline_w"] is None and r["_siftline_x"] is None
            continue
        assert abs(r["_siftline_w"] - sum(map(plain.word_ratio, own)) / math.sqrt(len(own))) < 1e-5
        assert abs(r["_siftline_x"] - sum(plain.ratio(s) for w in own for s in plain.strings(w)) / math.sqrt(len(own))) < 1e-5


def test_joined_ratios_score_like_sent_ones(labelled, monkeypatch):
    def scores():
        got = toxicity.score(labelled.unionByName(labelled.limit(1)), toxicity.learn(labelled)).select("id", "toxic_score").collect()
        return sorted((r[0], round(r[1], 6)) for r in got)

    whole = scores()
    for sent in (40, 0):
        monkeypatch.setattr(toxicity, "SENT", sent)
        assert len(whole) == 121 and scores() == whole


def test_rare_expressions_keep_their_counts(labelled):
    model = toxicity.learn(labelled)
    # an ending that no labelled row has still shows its stem
    reader = toxicity.Reader(model.sent, True)
    reader.read(["insult only1 vilezz livezz"])
    total = {w: sum(both) for w, both in reader.total.items()}
    assert 0.5 < total["insult"] and abs(total["only1"]) < total["insult"]
    assert total["vilezz"] > 2 > total["livezz"]


def test_every_labelled_row_is_counted(labelled):
    model = toxicity.learn(labelled)
    assert not np.isnan([ratio(model, f"{f'only{i}'[-4:]}\x03") for i in range(120)]).any()


def test_odd_tables(spark, labelled):
    model = toxicity.learn(labelled.unionByName(labelled.limit(5)).withColumn("code", F.lit(1)))
    odd = spark.createDataFrame([(1, "vileb " * 50_000, 0.5), (1, "vileb", 0.5), (None, None, None), (2, "", 1.0), (2, "?!", 1.0), (3, "é" * 100_000, 0.0)], "id long, text string, toxic_score double")
    got = toxicity.score(odd, model)
    assert got.columns == ["id", "text", "toxic_score"]
    scores = [r["toxic_score"] for r in got.collect()]
    assert all(0 <= x <= 1 for x in scores) and abs(scores[0] - scores[1]) < 1e-9 and scores[2] == scores[3] == scores[4] == model.base
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_ties_in_text_have_one_score(labelled):
    model = toxicity.learn(labelled)
    same = labelled.limit(1).select("text").crossJoin(labelled.select("id").limit(9))
    assert same.count() == 9 and toxicity.score(same, model).select("toxic_score").distinct().count() == 1
