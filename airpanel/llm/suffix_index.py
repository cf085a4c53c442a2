"""Long common prefixes of suffixes by breadth-first backward extension on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least, by doubling; the symbol 0 ends a string."""
    n, length = len(symbols), 7
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(length, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(length):  # 7 symbols of 9 bits
        key = (key << np.uint64(9)) | padded[j:n + j]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        if length >= depth:
            return order
        after = np.zeros(n, np.uint64)
        if length < n:
            after[:-length] = rank[length:] + np.uint64(1)
        key = rank * np.uint64(n + 1) + after
        length *= 2


def prefix_groups(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): suffixes in sorted order, and a number per place that changes where the common prefix
    with the suffix before is shorter than ``least``.

    ``symbols`` are small integers in which 0 ends each string. The transform maps the place of a suffix to that
    of the suffix one symbol shorter. Extending the intervals of all strings of one length to the left by every
    symbol puts a bound between two suffixes that begin alike just where a bound of that length lies between the
    two shorter ones. So common prefixes come out breadth-first, by increasing value, and the search stops at
    ``least``. Places it has not reached hold prefixes that long.
    """
    n = len(symbols)
    order = suffix_order(symbols, least + 1)
    transform = symbols[order - 1]  # the first suffix is preceded by the last symbol
    shorter = np.argsort(transform, kind="stable").astype(np.int32)
    start = transform[shorter]
    bound = np.ones(n, bool)
    bound[1:] = start[1:] != start[:-1]  # prefixes of no common symbol
    place = np.flatnonzero(~bound)
    before, after = shorter[place - 1], shorter[place]
    for _ in range(1, least):
        bounds = np.cumsum(bound, dtype=np.int32)
        apart = bounds[after] != bounds[before]
        if not apart.any():
            break
        bound[place[apart]] = True
        together = ~apart
        place, before, after = place[together], before[together], after[together]
    return order, np.cumsum(bound)
