"""Addends of the spelling model are looked up in a few steps, whatever the range of a shard's hashes."""

import numpy as np
import pytest

from siftline.llm import quality_rules


@pytest.mark.parametrize("low,high,n", [(0, 1 << 64, 5000), (3 << 60, (3 << 60) + (1 << 58), 5000), (77, 78, 1), (5, 2000, 900), (0, 1 << 64, 0)])
def test_addends_are_found_without_bisection(monkeypatch, low, high, n):
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(low, high, n, dtype=np.uint64, endpoint=False))
    adds = rng.normal(size=len(hashes)).astype(np.float32)
    reader = quality_rules.Reader(hashes, adds)
    wanted = np.concatenate((hashes, rng.integers(0, 1 << 64, 3000, dtype=np.uint64, endpoint=False), np.array([0, 1, (1 << 64) - 1], np.uint64)))
    known = dict(zip(hashes.tolist(), adds.tolist(), strict=True))
    monkeypatch.setattr(np, "searchsorted", None)
    assert reader.add(wanted).tolist() == [known.get(w, 0.0) for w in wanted.tolist()]


def test_words_are_decoded_each():
    words = [b"a", "é中".encode(), b"\xe4\xb8", b"\xc3", b"\xa9x", b"\x00\x02q\x03", "  ".encode(), b"\xff"]
    each = [w.decode("utf-8", "replace").translate(dict.fromkeys((0, 2, 3), "�")) for w in words]
    assert quality_rules.plain(words) == each
    assert quality_rules.plain([]) == []
