"""Suffix arrays by linear grouping.

Suffixes are first put into groups that share their longest Lyndon prefix, then
the order inside the groups is read off in one pass:

1. Groups start out as the suffixes of one first symbol and are taken in
   descending order. Every suffix of the group at hand points to the nearest
   position before it whose suffix is in a lower group. Those positions have a
   longer Lyndon prefix than was known: the prefix at hand is appended as often
   as it points there. So they leave their group for a new one right above it,
   the more pointers the higher.
2. In ascending order of suffixes, beginning with the end of the text, the
   suffix just before one, and those that follow along the pointers from there,
   take the next free place of their groups, until one has its place already.

No renaming and no recursion: every position is grouped and placed by counting.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of a row of non-negative integers in ascending order.

    A suffix that is a prefix of another is the smaller one.
    """
    size = len(symbols)
    if size == 0:
        return np.zeros(0, np.int64)
    values, first = np.unique(symbols, return_inverse=True)
    member = first.tolist()  # position -> group
    groups = [set() for _ in values]
    by_symbol = np.argsort(first, kind="stable")
    ends = np.cumsum(np.bincount(first)).tolist()
    for number, (low, high) in enumerate(zip([0, *ends], ends, strict=False)):
        groups[number] = set(by_symbol[low:high].tolist())
    above = [*range(1, len(values)), -1]  # group -> next higher group
    below = [-1, *range(len(values) - 1)]
    done = [False] * len(values)
    previous = [-1] * size
    at = len(values) - 1
    while at >= 0:
        done[at] = True  # the group at hand and all above it
        pointers: dict[int, int] = {}
        for i in sorted(groups[at]):
            j = i - 1
            while j >= 0 and done[member[j]]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        if pointers:
            moves: dict[tuple[int, int], list[int]] = {}
            for j, times in pointers.items():
                moves.setdefault((-times, member[j]), []).append(j)
            # Most pointers first: what comes later slips in below, right above the old group.
            for (_, old), found in sorted(moves.items()):
                rest = groups[old]
                if len(rest) == len(found):
                    # All leave together: the group itself moves up, past nothing.
                    continue
                rest.difference_update(found)
                new = len(groups)
                groups.append(set(found))
                done.append(False)
                over = above[old]
                above.append(over)
                below.append(old)
                above[old] = new
                if over >= 0:
                    below[over] = new
                for j in found:
                    member[j] = new
        at = below[at]
    # Free places of the groups in ascending order; group 0 is never anything's successor.
    free = [0] * len(groups)
    lowest, place = 0, 0
    while lowest >= 0:
        free[lowest] = place
        place += len(groups[lowest])
        lowest = above[lowest]
    order = [-1] * size
    placed = [False] * size
    for rank in range(-1, size):
        s = (size if rank < 0 else order[rank]) - 1
        while s >= 0 and not placed[s]:
            group = member[s]
            order[free[group]] = s
            free[group] += 1
            placed[s] = True
            s = previous[s]
    return np.array(order, np.int64)


def equal_runs(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in ``order``, the number of its run of suffixes with one and the same start of ``length`` symbols.

    Suffixes shorter than that must be left out of ``order``.
    """
    if not len(order):
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(symbols, length)
    differ = np.ones(len(order), bool)
    step = 1 << 18
    for low in range(1, len(order), step):
        high = min(len(order), low + step)
        differ[low:high] = (views[order[low:high]] != views[order[low - 1 : high - 1]]).any(axis=1)
    return np.cumsum(differ) - 1
