"""Suffix arrays of number streams, by prefix doubling in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(stream: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. Every 0 is an end of its own, smaller than any number and unlike any other 0,
    so sorting takes as many rounds as the longest stretch repeated between ends asks for."""
    n = len(stream)
    ends = stream == 0
    rank = np.where(ends, np.cumsum(ends), stream + ends.sum()).astype(np.int64)
    width = 1
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(0, n - width)] = rank[width:] + 1
        key = rank * (max(int(rank.max(initial=0)), n) + 2) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))[:n]
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        width *= 2


def repeated_windows(stream: np.ndarray, order: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, group) of all windows of `size` numbers without an end: equal ones, neighbours in the suffix array,
    have the same group number; groups are numbered in that order."""
    padded = np.concatenate([stream, np.zeros(size, stream.dtype)])
    whole = np.ones(len(order), dtype=bool)
    like_before = np.ones(max(0, len(order) - 1), dtype=bool)
    for d in range(size):
        value = padded[order + d]
        whole &= value != 0
        like_before &= value[1:] == value[:-1]
    new = np.concatenate([[True], ~like_before])[: len(order)]
    return order[whole], np.cumsum(new)[whole]
