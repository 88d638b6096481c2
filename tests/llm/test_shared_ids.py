"""Rows of one id with different contents are one node of the components, in both near-duplicate operators."""

import numpy as np
import pytest

from siftline.llm import embedding_dedup, minhash


def by_text(rows):
    return sorted(map(str, rows))


def brute(rows, near):
    """(id, component) of each row: rows are linked by near contents and by equal ids; components are named by ids."""
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (a, x) in enumerate(rows):
        for j, (b, y) in enumerate(rows[:i]):
            if (a is not None and a == b) or near(x, y):
                label[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            ids[find(i)] = min(a, ids.get(find(i), a))
    return by_text([(a, ids.get(find(i)), a is not None and a == ids.get(find(i))) for i, (a, _) in enumerate(rows)])


def shingled(text):
    w = (text or "").split()
    return {tuple(w[i : i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()


def alike(x, y):
    a, b = shingled(x), shingled(y)
    return bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b)


def test_documents(spark):
    words = [f"w{i}" for i in range(120)]
    text = lambda name, n=0: " ".join([*[f"{name}{w}" for w in words[n:]], *[f"x{i}" for i in range(n)]])
    a, b = text("a"), text("b")
    cases = [
        [(1, a), (1, b), (2, text("a", 5)), (3, text("b", 5))],
        [(5, a), (4, b), (4, a), (9, text("b", 6)), (7, "no relation to any"), (7, None), (7, text("b", 3))],
        [(1, a), (1, a), (2, a), (2, b), (None, b), (None, text("b", 4)), (3, text("c")), (3, ""), (8, None), (8, ""), (6, text("c", 2))],
        [(i % 6, text("abcd"[i % 4], i % 3)) for i in range(18)],
    ]
    for rows in cases:
        got = minhash.link(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
        assert by_text([(r["doc_id"], r["component_id"], r["kept"]) for r in got.collect()]) == brute(rows, alike)


@pytest.mark.parametrize("more", [0, 40])
def test_vectors(spark, more):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    near = lambda x, y: x is not None and y is not None and any(x) and any(y) and float(np.dot(x, y)) >= 0.95
    rows = [(1, at(0)), (2, at(0)), (2, at(90)), (3, at(95)), (9, at(180)), (9, None), (8, at(185)), (None, at(270)), (4, [0.0, 0.0]), (4, at(275)), (6, None), (6, [0.0, 0.0])]
    rows += [(100 + i // 2, at(200 + 2 * i)) for i in range(more)]
    got = embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert by_text([(r["vec_id"], r["component_id"], r["kept"]) for r in got.collect()]) == brute(rows, near)
