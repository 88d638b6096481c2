"""Random tables against brute force."""

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from siftline.llm import embedding_dedup, minhash, packing, suffix_array


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=90).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=6), st.integers(2, 20))
def test_segments_tile_all_windows(texts, length):
    seen = Counter()
    for number, start, n, anchor, _, content in suffix_array.segments(texts, length):
        assert content == texts[number][start : start + n + length - 1] and 0 <= anchor < n + length
        seen.update((number, start + w) for w in range(n))
    assert seen == Counter((i, s) for i, t in enumerate(texts) for s in range(len(t) - length + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=12, max_size=60).map(lambda b: bytes(x % 2 + 97 for x in b)), min_size=1, max_size=8))
def test_equal_windows_of_one_group(contents):
    length = 10
    n = np.array([len(c) - length + 1 for c in contents])
    s, w, first = suffix_array.equal_windows(contents, n, n - 1, np.zeros(len(contents), int), length)
    by: dict = {}
    for i, c in enumerate(contents):
        for k in range(len(c) - length + 1):
            by.setdefault((int(n[i]) - 1 - k, c[k : k + length]), []).append((i, k))
    want = {(i, k): (i, k) == places[0] for places in by.values() if len(places) > 1 for i, k in places}
    assert dict(zip(zip(s.tolist(), w.tolist(), strict=True), first.tolist(), strict=True)) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f g".split()), max_size=40), st.integers(1, 6))
def test_shingles_are_distinct_runs(words, width):
    got = minhash.shingles(" ".join(words).upper(), width)
    runs = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
    assert len(got) == len(runs) and (np.diff(got) > 0).all()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 60), max_size=20))
def test_packing_places_every_piece_once(histogram):
    plan = packing.best_fit_plan(histogram, 50)
    ranks: dict = {}
    room: Counter = Counter()
    for length, rank, n, first, per, offset in plan.tolist():
        ranks.setdefault(length, []).extend(range(rank, rank + n))
        for i in range(n):
            room[first + i // per] += length
            assert offset + i % per * length + length <= 50
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert all(v <= 50 for v in room.values())


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 40), st.integers(2, 30))
def test_close_pairs_equal_double_precision(seed, n, d):
    rng = np.random.default_rng(seed)
    u = embedding_dedup.unit(rng.normal(size=(3, d))[rng.integers(0, 3, n)] + rng.normal(size=(n, d)) * 0.3)
    got = {(int(i), int(j)) for a, b in embedding_dedup.close_pairs(u, u, 0.9, True, chunk=7) for i, j in zip(a, b, strict=True)}
    exact = np.einsum("id,jd->ij", u, u)
    assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if exact[i, j] >= 0.9}


def test_forest_labels_are_smallest_members():
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    label = embedding_dedup.local_forest(200, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    parent = list(range(200))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    assert label.tolist() == parent
