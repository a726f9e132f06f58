"""The bound that bitmaps give, and what workers keep."""

import numpy as np
import pytest

from tidegrid.llm import jaccard, textops


@pytest.mark.parametrize("n, m", [(1, 1), (5, 40), (300, 320), (511, 513), (3000, 900), (20_000, 19_000)])
def test_bits_never_differ_more_than_elements(n, m):
    rng = np.random.default_rng(n)
    a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    for shared in (0, min(n, m) // 2, min(n, m)):
        b = np.unique(np.concatenate([a[:shared], rng.integers(0, 1 << 63, m - shared, dtype=np.uint64)]))
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        longs = min(len(x), len(y))
        differ = int(np.bitwise_count(jaccard.folded(x, longs) ^ jaccard.folded(y, longs)).sum())
        common = len(np.intersect1d(a, b))
        assert differ <= len(a) + len(b) - 2 * common
        for percent in (50, 80, 90):
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert jaccard.may_link(np.array([len(a) + len(b)]), np.array([differ]), percent)[0]


def test_unlike_long_sets_are_ruled_out():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)) for _ in "ab")
    differ = np.bitwise_count(jaccard.bitmap(a) ^ jaccard.bitmap(b)).sum(dtype=np.int64)
    assert not jaccard.may_link(np.array([len(a) + len(b)]), np.array([differ]), 80)[0]


def test_a_worker_keeps_one_kind_of_cache():
    first = textops.kept("x", list)
    assert textops.kept("x", list) is first
    assert textops.kept("y", dict) == {} and textops.kept("x", list) is not first
