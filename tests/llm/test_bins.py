"""The search for a packing against every packing."""

from collections import defaultdict
from functools import cache

import numpy as np

from cratewise.llm import packing


def fewest(lengths, capacity):
    """The least number of bins, by trying all subsets."""
    n = len(lengths)
    weight = [sum(lengths[i] for i in range(n) if m >> i & 1) for m in range(1 << n)]

    @cache
    def need(mask):
        if not mask:
            return 0
        top = mask & -mask
        rest, part, best = mask ^ top, mask ^ top, n
        while True:
            if weight[part | top] <= capacity:
                best = min(best, 1 + need(rest ^ part))
            if not part:
                return best
            part = (part - 1) & rest

    return need((1 << n) - 1)


def size_of(counts, capacity):
    used, found = defaultdict(int), packing.pack(counts, capacity)
    for filling, times in found:
        assert 0 < sum(filling) <= capacity and times > 0
        for k in filling:
            used[k] += times
    assert dict(used) == counts
    return sum(times for _, times in found)


def test_search_finds_the_fewest_bins():
    rng = np.random.default_rng(0)
    for _ in range(200):
        capacity = int(rng.integers(12, 60))
        lengths = rng.integers(2, capacity * 2 // 3, 11).tolist()
        counts = {k: lengths.count(k) for k in set(lengths)}
        assert size_of(counts, capacity) == fewest(tuple(lengths), capacity)


def test_choices_are_revisited():
    # The fullest filling around the largest piece, taken as often as it goes, is not part of the best packing.
    rng, lost = np.random.default_rng(1), 0
    for _ in range(60):
        # Bins that are full to the last place: three pieces each.
        counts = defaultdict(int)
        for _ in range(12):
            a, b = sorted(rng.choice(np.arange(8, 92), 2, replace=False).tolist())
            for k in (a, b - a, 100 - b):
                counts[k] += 1
        lost += size_of(dict(counts), 100) - 12
    assert lost == 0


def test_thousands_of_short_pieces():
    assert size_of({1: 5000}, 2048) == 3
    assert size_of({1: 4095, 2047: 1, 1500: 2}, 2048) == -(-(4095 + 2047 + 3000) // 2048)
