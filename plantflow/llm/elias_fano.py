"""Elias-Fano sequences and a two-level trie of n-grams over them, in memory-mapped files, searched for many keys at once."""

from __future__ import annotations

import os

import numpy as np

_ONE, _64 = np.uint64(1), np.uint64(64)
#: Place of the k-th set bit of a byte.
_SELECT = np.array([[*(j for j in range(8) if b >> j & 1), *[0] * 8][:8] for b in range(256)], dtype=np.int64)


class Files:
    """Arrays as files of a folder, opened by memory mapping."""

    def __init__(self, folder: str):
        self.folder = folder

    def keep(self, name: str, array: np.ndarray) -> np.ndarray:
        path = os.path.join(self.folder, name + ".npy")
        np.save(path, array)
        return np.load(path, mmap_mode="r")


class EliasFano:
    """A sequence that never falls, of numbers below `universe` (2**64 at most): the low bits of each one after the other,
    the high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int, files: Files, name: str):
        n = self.n = len(values)
        self.bits = min(63, max(0, (universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        self.most = (universe - 1) >> self.bits if universe else 0
        self.mask = np.uint64((1 << self.bits) - 1)
        low = np.zeros(n * self.bits // 64 + 2, dtype=np.uint64)
        if self.bits and n:
            at = np.arange(n, dtype=np.uint64) * np.uint64(self.bits)
            word, shift, own = (at // _64).astype(np.int64), at % _64, values & self.mask
            np.bitwise_or.at(low, word, own << shift)
            over = shift + np.uint64(self.bits) > _64
            np.bitwise_or.at(low, word[over] + 1, own[over] >> (_64 - shift[over]))
        places = (values >> np.uint64(self.bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((n + self.most + 1) // 64 + 1, dtype=np.uint64)
        np.bitwise_or.at(high, places // 64, _ONE << (places % 64).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        self.low, self.high, self.ones = (files.keep(f"{name}-{k}", x) for k, x in (("low", low), ("high", high), ("ones", ones)))

    def _select(self, k: np.ndarray, of_ones: bool) -> np.ndarray:
        """Places of the k-th ones, or zeros, of the high bits."""
        words = len(self.high)
        before = self.ones if of_ones else np.arange(words + 1) * 64 - self.ones
        word = np.searchsorted(before[:words], k, side="right") - 1
        rest, own = k - before[word], self.high[word] if of_ones else ~self.high[word]
        place = word * 64
        for width in (32, 16, 8):
            many = np.bitwise_count(own & np.uint64((1 << width) - 1)).astype(np.int64)
            up = rest >= many
            rest = rest - many * up
            own = own >> (up * np.uint64(width))
            place += up * width
        return place + _SELECT[(own & np.uint64(255)).astype(np.int64), np.minimum(rest, 7)]

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at // _64).astype(np.int64), at % _64
        first = self.low[word] >> shift
        second = np.where(shift > 0, self.low[word + 1] << ((_64 - shift) % _64), np.uint64(0))
        return (first | second) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Places of the first numbers that are not below x; n where there is none. x is below the universe."""
        x = x.astype(np.uint64)
        high, own = (x >> np.uint64(self.bits)).astype(np.int64), x & self.mask
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - high + 1, 0)
        end = self._select(high, False) - high
        active = np.flatnonzero(first < end)
        while len(active):  # the numbers that share the high bits, few as a rule
            middle = (first[active] + end[active]) // 2
            less = self._low(middle) < own[active]
            first[active[less]] = middle[less] + 1
            end[active[~less]] = middle[~less]
            active = active[first[active] < end[active]]
        return first

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, whether x is there); places are 0 where it is not. x may be anything."""
        below = x.astype(np.uint64) >> np.uint64(self.bits) <= np.uint64(self.most)
        place = self.successor(np.where(below, x, 0)) if self.n else np.zeros(len(x), dtype=np.int64)
        there = below & (place < self.n)
        place = np.where(there, place, 0)
        if self.n:
            there &= self.access(place) == x.astype(np.uint64)
        return np.where(there, place, 0), there


#: Log10 probabilities are kept in these units, two bytes each.
UNIT = 1 / 4096


def quantised(log10: np.ndarray) -> np.ndarray:
    """Codes of log10 probabilities (0 or below)."""
    return np.clip(np.rint(-log10 / UNIT), 0, 65535).astype(np.uint16)


class Trie:
    """Contexts and their successors, both 64-bit numbers. A context points to a range of successors; these are ranks in
    the successors' vocabulary, each range counted on from the end of the one before it, so that all of them rise."""

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, log10_p: np.ndarray, log10_rest, files: Files):
        """The n-grams by context, then successor, with log10 probabilities; log10_rest(distinct contexts) is what is left
        for other successors."""
        n = len(contexts)
        starts = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if n else np.zeros(0, np.int64)
        ends = np.append(starts[1:], n) if n else starts
        known = np.unique(successors)
        ranks = np.searchsorted(known, successors).astype(np.int64)
        last = ranks[ends - 1] + 1 if n else starts
        base = np.concatenate([[0], np.cumsum(last)])
        self.contexts = EliasFano(contexts[starts], 1 << 64, files, "contexts")
        self.pointers = EliasFano(np.append(starts, n), n + 1, files, "pointers")
        self.vocabulary = EliasFano(known, 1 << 64, files, "vocabulary")
        self.successors = EliasFano(ranks + np.repeat(base[:-1], ends - starts), int(base[-1]) + 1, files, "successors")
        self.p = files.keep("p", quantised(log10_p))
        self.rest = files.keep("rest", quantised(log10_rest(contexts[starts])))

    def log10_codes(self, contexts: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, found): of the n-gram where it is found, else of what its context leaves, 0 for an unknown context."""
        code, found = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), bool)
        if not self.contexts.n or not len(contexts):
            return code, found
        # a context is looked up once for all that stand next to each other, a successor once
        starts = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]]))
        place, known = self.contexts.find(contexts[starts])
        start, end = (self.pointers.access(place + k).astype(np.int64) for k in (0, 1))
        base = np.where(start > 0, self.successors.access(np.maximum(start - 1, 0)).astype(np.int64) + 1, 0)
        last = self.successors.access(end - 1).astype(np.int64)
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(contexts))))
        code = np.where(known, self.rest[place], 0).astype(np.int64)[of]
        words, number = np.unique(successors, return_inverse=True)
        rank, there = self.vocabulary.find(words)
        target = rank[number] + base[of]
        own = np.flatnonzero(known[of] & there[number] & (target <= last[of]))
        at, same = self.successors.find(target[own])
        found[own[same]] = True
        code[own[same]] = self.p[at[same]]
        return code, found
