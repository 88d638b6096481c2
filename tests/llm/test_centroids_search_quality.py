"""Centroid clustering, ranked search and quality rules against their definitions in plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.llm import centroids, quality_rules, ranked_search

VECTORS = "vec_id long, embedding array<float>, cluster string"


def vectors(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(4, dims))
    return [(middles[i % 4] * 0.4 + rng.normal(size=dims) * 0.1).astype(np.float32).tolist() for i in range(n)]


def lloyd(rows, k, rounds, dims, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) * scale < 2**27 for x in v)]
    place = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", np.array(r[1], np.int32).tobytes())
    cents = [v for _, v in sorted(kept, key=place)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(cents)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    by = Counter()
    for _, j, d in found:
        by[j] += d
    return [(i, j, d, by[j], sum(by.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, j, d in found]


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def test_clusters_equal_plain_rounds(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*enumerate(vectors(300, 8)), (300, None), (301, [0.5] * 7), (302, [nan] * 8), (303, [inf] * 8), (304, [None] + [0.1] * 7), (305, []), (306, [3e38] * 8), (307, [2e6] * 8)]
    rows += [(i, [0.25] * 8) for i in range(400, 500)] + [(5, rows[5][1]), (None, rows[6][1]), (None, [-0.0] * 8), (None, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], VECTORS).repartition(5)
    for k, rounds in ((1, 2), (7, 0), (7, 4), (1000, 2)):
        got = centroids.cluster(df, k=k, rounds=rounds, dims=8, scale=64, seed=1)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert by_text(got.collect()) == by_text(lloyd(rows, k, rounds, 8, 64, 1))


def test_no_vectors_no_clusters(spark):
    df = spark.createDataFrame([(1, None, "")], VECTORS)
    assert centroids.cluster(df, dims=8).collect() == []
    assert centroids.cluster(df.limit(0)).dtypes == centroids.cluster(spark.createDataFrame([(1, [0.5] * 8, "")], VECTORS), dims=8).dtypes


def test_bounds_hold_and_spare_scans():
    rng = np.random.default_rng(1)
    x = np.floor(np.array(vectors(4000, 16)) * 64).astype(np.int64)
    old = x[rng.choice(4000, 6, replace=False)]
    near, upper, lower = centroids.scan(x, old)
    scanned = 0
    for _ in range(6):
        new = np.array([x[near == j].sum(0) // max((near == j).sum(), 1) if (near == j).any() else old[j] for j in range(6)])
        near, upper, lower, n = centroids.reassign(x, new, centroids.moved(old, new), near, upper, lower)
        d = ((x[:, None, :] - new[None]) ** 2).sum(2)
        assert (near == d.argmin(1)).all()
        assert (upper >= np.sqrt(d.min(1))).all()
        assert (lower <= np.sqrt(np.sort(d, 1)[:, 1])).all()
        old, scanned = new, scanned + n
    assert 0 < scanned < 6 * 4000 / 2


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-(1 << 27), 1 << 27, (20, 64)), rng.integers(-(1 << 27), 1 << 27, (5, 64))
    assert centroids.squared(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in c] for v in x]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ranked(docs, items, k):
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, length = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        for i, c in terms:
            m = 25 + 75 * c.total() * n_docs // length
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, n in asked.items() if c[t])
            if s > 0:
                scores.append((s, i))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        out += [(item, r, i, s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def corpus(n, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "Éa", "straße", "日本"]
    share = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, int(rng.integers(0, 40)), p=share / share.sum())) for _ in range(n)]


@pytest.mark.parametrize("few", [0, 1, 16])
def test_search_equals_full_scoring(spark, few):
    texts = corpus(400)
    docs = [*enumerate(texts), (7, texts[7]), (7, texts[8]), (None, texts[9]), (900, None), (901, ""), (902, " .,;-@[` {~\x7f"), (903, "THE the tHe ÉA é"), (904, "rare " * 5000 + "w1 " * 60_000)]
    items = [(i, t) for i, t in enumerate(corpus(30, 6))] + [(50, None), (51, ""), (52, "nowhere to be found"), (53, "the the of"), (53, "w1"), (None, "Rare.W1"), (54, "W1_w2\x00w3")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, rank int").repartition(3)
    q = spark.createDataFrame([(i, t, 2.0) for i, t in items], "item_id long, text string, score double")
    got = by_text(ranked_search.search(d, q, k=10).collect())
    assert got == by_text(ranked(docs, items, 10))
    blocks = list(ranked_search.query_blocks(iter(items), items=4, most=30))
    assert [i for ids, _ in blocks for i in ids] == [i for i, _ in items] and len(blocks) > 5
    (_, asked), = ranked_search.query_blocks(iter(items))
    rows = [ranked_search.terms_of((t or "").encode()) for _, t in docs]
    counts = [sorted((asked.terms[t], n) for t, n in Counter(r).items() if t in asked.terms) for r in rows]
    starts = np.concatenate(([0], np.cumsum([len(c) for c in counts])))
    flat = np.array([x for c in counts for x in c], np.int64)
    block = ranked_search.Block(starts, flat[:, 0], 10_000 // (1 + flat[:, 1]), len(asked.terms))
    for c in asked.counts:
        gains = {t: 7 * n for t, n in c.items()}
        whole = block.completed(np.arange(len(docs)), np.array([gains.get(t, 0) for t in range(len(asked.terms))], np.int64))
        found, scores, _ = block.best(gains, 10, 1, few)
        assert (scores == whole[found]).all()
        assert sorted(scores[scores > 0].tolist())[-10:] == sorted(whole[whole > 0].tolist())[-10:]


def test_search_stops_early_where_bounds_allow():
    n = 5000
    rare, common = [(0, 900)] * 10 + [(0, 3)] * (n - 10), [(1, 5)] * n
    terms = np.array([x for pair in zip(rare, common, strict=True) for x in pair])
    block = ranked_search.Block(np.arange(0, 2 * n + 1, 2), terms[:, 0], terms[:, 1], 2)
    found, scores, unread = block.best({0: 1, 1: 1}, 10, 1, 1)
    assert sorted(found.tolist()) == list(range(10)) and set(scores.tolist()) == {905} and unread >= n - 10
    assert block.best({0: 1, 1: 1}, 10, 906)[2] == 2 * n or len(block.best({0: 1, 1: 1}, 10, 906)[0]) == 0


def test_search_in_several_blocks_of_queries(spark, monkeypatch):
    docs, items = list(enumerate(corpus(60))), list(enumerate(corpus(9, 8)))
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    monkeypatch.setattr(ranked_search.query_blocks, "__defaults__", (4, 40))
    assert by_text(ranked_search.search(d, q, k=3).collect()) == by_text(ranked(docs, items, 3))
    assert ranked_search.search(d.limit(0), q).count() == ranked_search.search(d, q.limit(0)).count() == 0
    named = ranked_search.search(d.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text"), q, k=1)
    assert named.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "string"), ("score", "bigint")] and named.count() > 0


def kneser_ney(rows, order):
    """ln p(letter | language, letters before it), by the definition."""
    b, e = "\x02", "\x03"
    counts = [Counter() for _ in range(order + 1)]
    for lang, text in rows:
        for w in (text or "").encode().split():
            s = b * (order - 1) + w.decode() + e
            counts[order].update((lang, s[i : i + order]) for i in range(len(s) - order + 1))
    for n in range(order - 1, 0, -1):
        for (lang, g), k in counts[n + 1].items():
            counts[n][lang, g[1:]] += k if g[1] == b else 1
    kinds = len({g for _, g in counts[1]})
    off = [None]
    for n in range(1, order + 1):
        d = quality_rules.discounts(Counter(min(k, 5) for k in counts[n].values()))
        off.append(lambda k, d=d: d[min(k, 3) - 1])
    total, rest = Counter(), Counter()
    for n in range(1, order + 1):
        for (lang, g), k in counts[n].items():
            total[lang, n, g[:-1]] += k
            rest[lang, n, g[:-1]] += off[n](k)

    def p(lang, n, g):
        if n == 0:
            return 1 / (kinds + 1)
        low = p(lang, n - 1, g[1:])
        t = total[lang, n, g[:-1]]
        k = counts[n][lang, g]
        return low if not t else (k - off[n](k) if k else 0) / t + rest[lang, n, g[:-1]] / t * low

    def text_log(lang, text):
        s = 0.0
        for w in (text or "").encode().split():
            x = b * (order - 1) + w.decode() + e
            s += sum(math.log(p(lang, order, x[i : i + order])) for i in range(len(x) - order + 1))
        return s

    return text_log


QUALITY = "doc_id long, lang string, text string, kept string"


def quality_rows():
    rows = [(i, "en" if i % 3 else "fr", t, "") for i, t in enumerate(corpus(60))]
    return rows + [(100, None, "a lone word of no language at all 日本 \U0001f926 x", ""), (101, "en", None, ""), (102, "en", "", ""), (103, None, " \n\t", ""), (104, "en", rows[4][2], ""), (4, "en", rows[4][2], ""), (None, "fr", rows[3][2], "")]


@pytest.mark.parametrize("held", [1 << 22, 200])
def test_perplexities_equal_the_definition(spark, held):
    rows = quality_rows()
    want = kneser_ney([(lang, t) for _, lang, t, _ in rows], quality_rules.ORDER)
    got = quality_rules.judge(spark.createDataFrame(rows, QUALITY).repartition(3), held=held).collect()
    assert len(got) == len(rows)
    texts = {i: (lang, t) for i, lang, t, _ in rows}
    for r in got:
        lang, text = texts[r["doc_id"]]
        assert r["lang"] == lang
        words = (text or "").encode().split()
        if not words:
            assert r["word_perplexity"] is None and r["base_failed"] and not r["kept"]
            continue
        log_p = want(lang, text)
        assert r["word_perplexity"] == pytest.approx(math.exp(-log_p / len(words)), rel=1e-4)
        assert r["letter_perplexity"] == pytest.approx(math.exp(-log_p / (r["word_chars"] + r["n_words"])), rel=1e-4)
        assert r["kept"] == (not r["base_failed"])  # too few documents for bands


def test_base_counts_equal_the_definition():
    rng = np.random.default_rng(4)
    pieces = ["a", "b", "c\n", "\n", " ", "é#", "*$%&|<>", "\v", "\x85", " ", "日", "\t"]
    long = "x y z v w " * 3 + " ".join(map(str, range(9000))) + " x y z v w"
    for text in ["", "a", "a b c d e", "a b c d e f", "a\na\n \n \na", long, *[" ".join(rng.choice(pieces, int(n))) for n in rng.integers(1, 90, 200)]]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        again = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)
        assert quality_rules.base_counts(text.encode(), text.encode().split()) == want


def test_bands_reject_what_is_unlike_its_language(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("aeioustrnl"), int(rng.integers(2, 9)))) for _ in range(300)]
    rows = [(i, "en", " ".join(rng.choice(words, int(rng.integers(30, 200)))), "") for i in range(400)]
    strange = [(1000, "en", " ".join("".join(rng.choice(list("bcdfghjkmpqvwxyz0123456789"), 7)) for _ in range(80)), ""), (1001, "en", " ".join(f"{w}%%%" for w in rng.choice(words, 90)), "")]
    short = [(2000, "xx", " ".join(rng.choice(words, 50)), "")]
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows + strange + short, QUALITY)).collect()}
    assert not got[1000]["kept"] and not got[1001]["kept"] and got[2000]["kept"]
    clean = [r["kept"] for i, r in got.items() if i < 1000 and not r["base_failed"]]
    assert sum(clean) >= 0.99 * len(clean)


def test_quality_without_rows_or_languages(spark):
    df = spark.createDataFrame(quality_rows(), QUALITY)
    assert quality_rules.judge(df.limit(0)).collect() == []
    assert quality_rules.judge(df.drop("lang"), lang=None).where("lang is null").count() == df.count()
