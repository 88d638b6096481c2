"""Corpus operators against brute force on small tables, with nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siftline.llm import byte_bpe, common, embedding_dedup, fingerprint, language_id, line_dedup, minhash, packing, suffix_array, toxicity, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string"
ODD = ["", " ", "  ", "a  b", " a", "a ", "\n a", "a \n", "q b\n c", "q b\n", "it's  we'll 'S", "x" * 3000 + " " + "é" * 300, "a \x85 b  c", "a\x1c b \x1cc", "　x y", "🤦🏼‍♂️ ok", "<|endoftext|> a", "İΣΑΣ J̌ é́"]


def documents(spark, texts, schema=DOCS):
    return spark.createDataFrame(list(enumerate(texts)), schema)


def union_find(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def rank_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(VOCABULARY), special_tokens={})


def test_bpe_equals_the_rank_encoder(spark):
    own = rank_encoding()
    df = documents(spark, [*ODD, None, ODD[3]]).withColumn("ids", F.lit("clash"))
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN).collect()}
    assert got == {i: own.encode_ordinary(t or "") for i, t in enumerate([*ODD, None, ODD[3]])}
    back = byte_bpe.decode(byte_bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate([*ODD, None, ODD[3]])}
    assert byte_bpe.encode(df.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bpe_is_exact_around_every_code_point():
    own = rank_encoding()
    c = byte_bpe.Codec(byte_bpe.serialize_model(byte_bpe.read_ranks(VOCABULARY)), public_tokenizers.PATTERN)
    texts = [f"a{chr(i)}1 {chr(i)}b {chr(i)} c" for i in range(0x110000) if not 0xD800 <= i < 0xE000 and (i < 0x3100 or i % 97 == 0)]
    for at in range(0, len(texts), 5000):
        part = texts[at : at + 5000]
        assert c.encode_all(part) == [" ".join(map(str, own.encode_ordinary(t))) for t in part]


def test_bpe_digests(spark):
    row = byte_bpe.round_trip_digests(documents(spark, ["a b", None]), VOCABULARY, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    ids = " ".join(map(str, rank_encoding().encode_ordinary("a b")))
    assert tuple(row[0])[1:] == (2, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(b"a b").hexdigest())
    assert tuple(row[1])[1:] == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())


def brute_repeats(texts, length, keep="none"):
    seen = defaultdict(list)
    data = [(t or "").encode() for t in texts]
    for d, t in enumerate(data):
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]].append((d, i))
    out = []
    for d, t in enumerate(data):
        gone = set()
        for i in range(len(t) - length + 1):
            places = seen[t[i : i + length]]
            if len(places) > 1 and (keep == "none" or places[0] != (d, i)):
                gone.update(range(i, i + length))
        out.append(gone)
    return data, out


def repeated_texts(seed, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(3)]
        if rng.random() < 0.6:
            p = rng.choice(passages)
            parts.insert(1, p[rng.randrange(10) : len(p) - rng.randrange(10)])
        texts.append(" ".join(parts))
    return [*texts, texts[0], texts[0], None, "", "ab" * 200, passages[0] + passages[0]]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("length", [30, 100])
def test_repeats_equal_brute_force(spark, keep, length):
    texts = repeated_texts(length)
    data, gone = brute_repeats(texts, length, keep)
    got = suffix_array.remove_repeats(documents(spark, texts).withColumn("found", F.lit(1)), length, keep).collect()
    assert len(got) == len(texts)
    for r in got:
        d = r["doc_id"]
        assert (r["n_bytes"], r["n_removed"]) == (len(data[d]), len(gone[d])), d
        covered = {i for k in range(0, len(r["spans"]), 2) for i in range(r["spans"][k], r["spans"][k + 1])}
        assert covered == gone[d]
        kept = bytes(b for i, b in enumerate(data[d]) if i not in gone[d])
        assert r["text"] == (texts[d] if not gone[d] else kept.decode("utf-8", "ignore"))


def test_repeats_of_large_groups_are_counted(spark, monkeypatch):
    monkeypatch.setattr(suffix_array, "GROUP", 3)
    texts = repeated_texts(5)
    for keep in ("none", "first"):
        _, gone = brute_repeats(texts, 60, keep)
        got = suffix_array.remove_repeats(documents(spark, texts), 60, keep).collect()
        assert {r["doc_id"]: r["n_removed"] for r in got} == {i: len(g) for i, g in enumerate(gone)}


def test_repeats_across_buffers(monkeypatch):
    monkeypatch.setattr(suffix_array, "BUFFER", 700)
    text = bytes(random.Random(2).choice(b"ab") for _ in range(3000))
    starts = [s + w for _, s, n, _, _, _ in suffix_array.segments([text, text[:50]], 100) for w in range(n)]
    assert sorted(starts) == list(range(len(text) - 99))


def test_suffix_sort_orders_suffixes():
    data = bytes(random.Random(4).choice(b"ab") for _ in range(4000))
    s = suffix_array.SuffixSort(data, 64)
    at = np.array(random.Random(5).sample(range(3900), 500))
    sizes = np.array([1, 2, 130, 367])
    order, begin = s.sort(at, sizes), 0
    for n in sizes:
        group = at[order[begin : begin + n]]
        assert [data[i : i + 64] for i in group] == sorted(data[i : i + 64] for i in at[begin : begin + n])
        begin += n


def test_empty_and_null_ids_in_repeats(spark):
    assert suffix_array.remove_repeats(documents(spark, ["x"]).limit(0)).count() == 0
    df = spark.createDataFrame([(None, "z" * 50 + "tail"), (1, "z" * 50), (1, "z" * 50)], DOCS)
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffix_array.remove_repeats(df, 50).collect())
    assert got == [(50, 50), (50, 50), (54, 50)]


def brute_lines(texts, min_words):
    """Units, removed units, (start, past the end) of runs and kept text, from the rule: pieces up to sentence marks or
    newlines; runs of pieces that an earlier one repeats, of min_words words and more, go."""
    seen, want = set(), {}
    for d, t in enumerate(texts):
        pieces, at, t = [], 0, t or ""
        while at < len(t):
            end = at
            while end < len(t) and t[end] not in "\n.!?":
                end += 1
            while end < len(t) and t[end] in ".!?":
                end += 1
            end = max(end, at + 1)
            plain = " ".join("".join(c if c.isalnum() else " " for c in t[at:end].lower()).split())
            if plain:
                pieces.append((at, end, plain, plain in seen))
                seen.add(plain)
            at = end
        cut, run = [], []
        for piece in [*pieces, (0, 0, "", False)]:
            if piece[3]:
                run.append(piece)
                continue
            if sum(len(p[2].split()) for p in run) >= min_words:
                cut.append((run[0][0], run[-1][1], len(run)))
            run = []
        kept = "".join(c for i, c in enumerate(t) if not any(x <= i < y for x, y, _ in cut))
        want[d] = (len(pieces), sum(n for *_, n in cut), [v for x, y, _ in cut for v in (x, y)], kept)
    return want


@pytest.mark.parametrize("min_words", [1, 5, 12])
def test_repeated_lines_equal_brute_force(spark, min_words):
    rng = random.Random(9)
    pool = [" ".join(rng.choice(["Ab", "cd,", "ef!", "gh", "ïj", "3.5", "?!", "k."]) for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 9))) for _ in range(40)] + [None, "", "\n\n", "a,b,c,d,e", "A B C D E", "a b c d\n" * 3, "...", "ab. cd\n", texts_tail := "x y z. " * 5, texts_tail]
    df = documents(spark, texts).withColumn("removed", F.lit(1)).withColumn("digest", F.lit(2))
    got = line_dedup.remove_repeated_lines(df, min_words)
    assert got.columns == ["doc_id", "text", "digest", "n_units", "n_removed", "removed"]
    want = brute_lines(texts, min_words)
    assert {r["doc_id"]: (r["n_units"], r["n_removed"], list(r["removed"]), r["text"] or "") for r in got.collect()} == want
    assert line_dedup.remove_repeated_lines(df.limit(0)).count() == 0


def test_common_lines_are_met_everywhere(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 8)
    texts = [f"same line here\nown {i}\nin pairs {i // 2}" for i in range(60)]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.remove_repeated_lines(documents(spark, texts), 1).collect()}
    assert got == {i: int(i > 0) + i % 2 for i in range(60)}


def test_lines_of_repeated_rows(spark):
    twice = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")], DOCS)
    got = line_dedup.remove_repeated_lines(twice, 5)
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got.collect()) == [("1", 1), ("1", 1), ("2", 1), ("None", 0)]


def brute_near(texts, width, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set())
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, union_find(len(texts), links)


def near_texts(seed, groups=6, copies=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(20, 160))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 25)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t))
    shared = " ".join(rng.choice(words) for _ in range(40))
    texts += [shared + " " + " ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    rng.shuffle(texts)
    return [*texts, "one", "ONE", "one two", None, "", " \n"]


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80), (2, 50)])
def test_near_copies_equal_brute_force(spark, width, percent):
    texts = near_texts(percent)
    sets, component = brute_near(texts, width, percent)
    got = minhash.link(documents(spark, texts).withColumn("n", F.lit("clash")), width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(s), c, i == c) for i, (s, c) in enumerate(zip(sets, component, strict=True))}


def test_hub_bounds_add_up():
    for percent in range(1, 101):
        settled, near = minhash.settled_and_near(percent)
        assert (100 - settled) + (100 - percent) == 100 - near and 0 < near <= settled


def test_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 2)
    texts = near_texts(11, groups=3, copies=25)
    _, component = brute_near(texts, 3, 85)
    got = minhash.link(documents(spark, texts), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(component))


def test_near_copies_of_nothing(spark):
    assert minhash.link(documents(spark, ["x"]).limit(0)).count() == 0
    got = minhash.link(spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "a b c"), (5, None)], DOCS), 3, 85).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [("3", "3", True), ("3", "3", True), ("5", "5", True), ("None", "3", False)]


def test_null_ids_link_their_neighbours(spark):
    words = [f"w{i}" for i in range(120)]
    text = lambda n: " ".join([*words[n:], *[f"x{i}" for i in range(n)]])  # noqa: E731  at 85 %: 0 and 8 are near, 8 and 16, but not 0 and 16
    for middle in (None, 3):
        rows = [(1, text(0)), (middle, text(8)), (2, text(16)), (None, "all alone in here"), (None, "all alone in here")]
        got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.link(spark.createDataFrame(rows, DOCS), 3, 85).collect()]
        assert sorted(map(str, got)) == sorted(map(str, [(1, 1, True), (middle, 1, False), (2, 1, False), (None, None, False), (None, None, False)]))


def test_null_ids_link_their_vectors(spark):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    for middle in (None, 3):
        rows = [(1, at(0)), (middle, at(15)), (2, at(30)), (None, at(120)), (4, at(200)), (2, at(270))]  # rows of one id are one node
        got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
        assert sorted(map(str, got)) == sorted(map(str, [(1, 1, 1), (middle, 2, 1), (2, 1, 1), (None, 0, None), (4, 0, 4), (2, 0, 1)]))


def test_lent_ids_are_free(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    clash = keys.where("key <> 'c'").select(F.xxhash64("key", F.lit(0)).alias("id"))
    got = common.fresh_ids(keys, clash).collect()
    assert sorted(r["key"] for r in got) == ["a", "b", "c"] and len({r["id"] for r in got} | {r["id"] for r in clash.collect()}) == 5


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component_id"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def vectors(seed=3, n=120, d=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(10, d))
    x = np.concatenate([base[rng.integers(0, 10, n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.2, 0.6], size=(n, 1)), rng.normal(size=(20, d))]).astype(np.float32)
    x[5] = x[6] = x[7]
    return x


@pytest.mark.parametrize("tile", [16, 4096])
def test_embedding_links_equal_brute_force(spark, tile):
    x = vectors()
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    component = union_find(len(x), list(zip(*np.nonzero(near), strict=True)))
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    n = len(rows)
    odd = [(n, None, 1), (n + 1, [0.0] * 24, 1), (n + 2, [float("nan")] * 24, 1), (n + 3, [None] * 24, 1), (n + 4, [1.0], 1), (n + 5, [float("inf")] * 24, 1), (n + 6, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, key int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link(df, tile_rows=tile).collect()}
    want = {i: (int(near[i].sum()), component[i], component[i] == i) for i in range(n)} | {i: (0, i, True) for i in range(n, n + 7)}
    assert got == want
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_quantisation_bound_holds():
    u = embedding_dedup.unit(np.random.default_rng(1).normal(size=(200, 64)))
    q, s, norm, error = embedding_dedup.quantise(u)
    approximate = (q.astype(float) * s[:, None]) @ (q.astype(float) * s[:, None]).T
    bound = norm[:, None] * error + error[:, None] * (norm + error)
    assert (np.abs(u @ u.T - approximate) <= bound).all()


def edited(texts):
    t = [x or "" for x in texts][::-1]  # descending ids
    out = {}
    for i, x in enumerate(t):
        half = len(x) // 2
        out[len(t) - 1 - i] = x[: len(x) - half] + t[(i + 1) % len(t)][:half]
    return out


def test_fingerprints(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(60)]
    texts += [texts[3], texts[3].upper(), None, "", "!?", "ß🤦x", texts[4].replace("w1 ", "w2 ")]
    df = documents(spark, texts).withColumn("prints", F.lit(1))
    got = {r["doc_id"]: r for r in fingerprint.compare_with_edited(df).collect()}
    want = edited(texts)
    assert {i: r["edited_sha256"] for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert {i: r["n_chars"] for i, r in got.items()} == {i: len(t or "") for i, t in enumerate(texts)}
    assert got[3]["fingerprint"] == got[60]["fingerprint"] == got[61]["fingerprint"] != got[4]["fingerprint"]
    assert got[62]["fingerprint"] == got[63]["fingerprint"] == got[64]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got.values())
    assert np.mean([got[i]["near_edited"] for i in range(60)]) > np.mean([got[i]["near_next"] for i in range(59)]) + 0.02
    one = fingerprint.compare_with_edited(documents(spark, ["abcd"])).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def spark_hash(data: bytes, seed=42) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(data, seed % (1 << 64))
    return h - (1 << 64) if h >> 63 else h


def brute_fingerprints(texts, low=fingerprint.LOW, high=fingerprint.HIGH):
    import regex

    bags = [{spark_hash(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w} for t in texts]
    df = Counter(t for bag in bags for t in bag)
    lexicon = {t for t, n in df.items() if low * len(texts) <= n <= high * len(texts)}

    def prints(text):
        bag = {spark_hash(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}
        kept = sorted(bag & lexicon or bag)

        def digest(some):
            h = 42
            for t in some:
                h = spark_hash(int(t).to_bytes(8, "little", signed=True), h)
            return f"{h % (1 << 64):016x}" if some else "-"

        return [*(digest([t for t in kept if (t % (1 << 64)) >> s & ((1 << b) - 1) == v]) for s, b, v in fingerprint.SUBSETS), digest(kept)]

    return prints


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words[: rng.choice([20, 400])]) for _ in range(rng.randrange(1, 150))) for _ in range(80)] + [None, "", "ÀÉ b", "?"]
    prints, ends = brute_fingerprints(texts), edited(texts)
    alike = lambda a, b: (lambda either: sum(x == y for x, y in either) / len(either) if either else 1.0)([p for p in zip(a, b, strict=True) if p != ("-", "-")])
    for r in fingerprint.compare_with_edited(documents(spark, texts)).collect():
        i = r["doc_id"]
        own, other, following = (prints(t) for t in (texts[i] or "", ends[i], texts[(i - 1) % len(texts)] or ""))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (".".join(own), ".".join(other))
        assert abs(r["near_edited"] - alike(own, other)) < 1e-12 and abs(r["near_next"] - alike(own, following)) < 1e-12


@pytest.mark.parametrize("most", [4, 64])
def test_next_rows_of_shared_and_null_ids(spark, monkeypatch, most):
    monkeypatch.setattr(fingerprint, "MOST_RANGES", most)
    monkeypatch.setattr(fingerprint, "GROUP", 3)
    rng = random.Random(most)
    rows = [(rng.choice([None, 7, 7, rng.randrange(-50, 50)]), f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, DOCS).withColumn("tie", F.xxhash64("text"))
    got = fingerprint.with_next(df, "doc_id", ["text"], F.col("tie")).collect()
    inside = lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["tie"])
    order = [r["text"] for r in sorted(got, key=inside)]
    assert {r["text"]: r["next_text"] for r in got} == {a: b for a, b in zip(order, order[1:] + order[:1], strict=True)} and len(got) == 300


def test_fingerprint_of_an_empty_table(spark):
    assert fingerprint.compare_with_edited(documents(spark, ["x"]).limit(0)).count() == 0


def test_fingerprint_plan_is_native(spark):
    plan = fingerprint.compare_with_edited(documents(spark, ["a b", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_language_profiles(spark):
    rows = [(i, "the cat and the dog " * 5 if i % 2 else "le chat et le chien " * 5, "en" if i % 2 else "fr") for i in range(20)] + [(20, None, "en"), (21, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.learn(df)
    ask = spark.createDataFrame([(1, "The DOG and cat", "x"), (2, "et le chien", "x"), (3, None, "x"), (4, "123 !?", "x"), (5, "", "x")], "doc_id long, text string, lang_x string")
    got = {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in language_id.predict(ask, profiles).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "fr", 3: "und", 4: "und", 5: "und"}
    assert all(0 <= v[1] <= 1 for v in got.values())
    empty = language_id.learn(df.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(ask, empty).collect()} == {"und"}


def test_language_distance_by_hand():
    p = language_id.Profiles.of({"a": [10, 20, 30], "b": [30, 20]}, top=3)
    mine = np.array([30, 10], np.uint64)
    theirs = np.where(p.codes[np.searchsorted(p.codes, mine)] == mine, p.ranks[:, np.searchsorted(p.codes, mine)], -1)
    assert theirs.tolist() == [[2, 0], [0, -1]]
    counted = language_id.ngrams("Ab, ab")
    assert Counter(counted.tolist())[ord("a")] == 2 and len(counted) == 4 + 6 + 5


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = language_id.learn(docs.where(language_id.remainder("doc_id", 4) != 2))
    found = language_id.predict(docs.where(language_id.remainder("doc_id", 4) == 2), profiles)
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def greedy_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_plan_equals_the_greedy_loop(seed):
    rng = random.Random(seed)
    lengths = [min(100, max(1, int(rng.expovariate(1 / 25)))) for _ in range(rng.randrange(1, 400))]
    plan = packing.best_fit_plan(Counter(lengths), 100)
    used = defaultdict(list)
    for length, rank, n, first, per, offset in plan.tolist():
        for i in range(n):
            used[first + i // per].append((offset + i % per * length, length))
    assert sum(p[2] for p in plan.tolist()) == len(lengths)
    rooms = []
    for placed in used.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        rooms.append(100 - at)
    assert sorted(rooms) == greedy_best_fit(lengths, 100)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    assert t.encode("<|endoftext|> a", add_special_tokens=False).ids == [49407, 320]
    texts = [*ODD, "b<|startoftext|>c <|ENDOFTEXT|>", None, "word " * 900, "Wörter, und. mehr; 12%%% " * 40]
    ids = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for x in texts]
    df = documents(spark, texts).withColumn("length", F.lit(9))
    got = packing.pack(packing.pieces(df, path, capacity=64), 64).collect()
    by = defaultdict(list)
    for r in got:
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {d: sum(r["length"] for r in got if r["doc_id"] == d) for d in range(len(texts))} == {d: len(x) for d, x in enumerate(ids)}
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    lengths = [min(64, len(x) - s) for x in ids for s in range(0, len(x), 64)]
    assert len(by) == len(greedy_best_fit(lengths, 64))
    assert packing.pack(packing.pieces(df.limit(0), path), 2048).count() == 0


def test_other_tokenizers_are_read_whole():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        definition = open(public_tokenizers.path(name), encoding="utf-8").read()
        codec = packing.WordCodec(definition)
        assert codec.by_chunks == name.startswith("word")
        for text in ODD:
            assert codec.encode(text) == np.array(codec.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_archive_round_trip_and_lookup(spark):
    rows = [(4, "http://www.a.com/x?q=1#f", "same"), (2, "https://a.com:443/x?q=1", "same"), (9, "http://b.org", None), (7, "http://b.org", ""), (5, "http://[bad", "ünï\r\n\r\n"), (6, None, "same"), (None, "http://c.net/ä b", "same"), (2, "http://a.com/2", "same")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit("clash"))
    archive = warc.write_archive(df)
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_all(spark, archive).collect())
    assert got == sorted([("4", 4, "revisit", 2), ("2", 4, "response", None), ("9", 0, "revisit", 7), ("7", 0, "response", None), ("5", len("ünï\r\n\r\n".encode()), "response", None), ("6", 4, "revisit", 2), ("None", 4, "response", None), ("2", 4, "response", None)])
    found = archive.lookup("http://A.com/x?q=1")
    assert sorted(r.page_id for r in found) == [2, 4] and {r.payload for r in found if r.record_type == "response"} == {b"same"}
    assert archive.lookup("http://nowhere.example") == []
    assert warc.read_all(spark, warc.write_archive(df.limit(0))).count() == 0


def test_index_blocks_are_bisected(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, f"http://h{i % 13}.com/p{i % 5}", f"page {i}") for i in range(150)]
    lines = [f"{warc.url_key(u)} f {i} 1" for i, u, _ in rows]
    assert warc.url_key("http://h1.com/p1") == "com,h1)/p1" and len(set(lines)) == 150
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    for url in {u for _, u, _ in rows}:
        assert sorted(r.page_id for r in archive.lookup(url)) == [i for i, u, _ in rows if u == url]


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.read_all(spark, warc.write_archive(df, min_payload=3)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_toxicity_learns_expressions(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(900):
        toxic = i % 5 == 0
        text = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["vile", "rotten"]))
        rows.append((i, " ".join(text), int(toxic)))
    df = spark.createDataFrame(rows, "id long, text string, toxic int")
    model = toxicity.learn(df.where("id < 700"))
    got = toxicity.score(df.where("id >= 700").unionByName(spark.createDataFrame([(1000, None, 0), (1001, "", 0)], df.schema)), model).collect()
    wrong = [r for r in got if r["id"] < 1000 and (r["toxic_score"] >= 0.5) != bool(r["toxic"])]
    assert len(wrong) <= 4
    assert all(r["toxic_score"] == model.base < 0.5 for r in got if r["id"] >= 1000)
    assert {r["toxic_score"] for r in toxicity.score(df.limit(3), toxicity.learn(df.limit(0))).collect()} == {0.0}
    assert {r["toxic_score"] for r in toxicity.score(df.limit(3), toxicity.learn(df.where("toxic = 0"))).collect()} == {0.0}
