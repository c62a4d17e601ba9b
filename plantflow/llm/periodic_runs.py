"""Periodic runs of words, by Lyndon roots from Baier's grouping.

A run is a stretch of words with smallest period q and at least max(min_length, 2 * q) words that neither neighbour
extends. The first phase of Baier's suffix sorter puts suffixes into groups, from the greatest group down: the words
before a group's suffixes move to new groups that are longer by that group's words. When it ends, the length of a
suffix's group is the length of its longest Lyndon prefix. Every run has a Lyndon root that is such a prefix, under the
order of words or under its reverse; each root of either order is extended by the longest common extension to the left
and right, and is a run if it then holds two periods.

A run shares ceil(min_length / 2) words with its own shift by q, so only stretches of words in windows of that size that
the text holds twice are grouped; a run never leaves such a stretch.

A null or empty text has no words and no runs. A null id is a document like any other. Rows are handled one by one, so
repeated rows get equal results; an empty table gives no rows; a column of the input with the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plantflow.llm import common

MIN_LENGTH = 12
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
RESULTS = ("n_words", "runs", "collapsed")


def lyndon_lengths(codes: list[int], n_codes: int) -> list[int]:
    """Length of the longest Lyndon prefix of each suffix; codes are numbers below n_codes."""
    n = len(codes)
    members: list[list[int]] = [[] for _ in range(n_codes)]
    for at, code in enumerate(codes):
        members[code].append(at)
    live = [len(m) for m in members]  # suffixes still in the group
    length = [1] * n_codes
    below, above = list(range(-1, n_codes - 1)), [*range(1, n_codes), -1]
    group, previous, done = list(codes), list(range(-1, n - 1)), bytearray(n)
    now = n_codes - 1
    while now >= 0:
        own = [at for at in members[now] if group[at] == now]
        for at in own:
            done[at] = 1
        size, times = length[now], {}
        for at in own:  # the nearest place before it that is in a smaller group, and how often it is that
            place = previous[at]
            while place >= 0 and done[place]:
                place = previous[place]
            previous[at] = place
            if place >= 0:
                times[place] = times.get(place, 0) + 1
        if len(times) == 1:
            ((place, k),) = times.items()
            moved = {group[place]: {k: [place]}}
        else:
            moved = {}
            for place, k in times.items():
                moved.setdefault(group[place], {}).setdefault(k, []).append(place)
        for old, by_times in moved.items():
            if len(by_times) == 1:
                ((k, places),) = by_times.items()
                if len(places) == live[old]:  # the whole group moves: it keeps its place
                    length[old] += k * size
                    continue
            last, top = old, above[old]
            for k in sorted(by_times):
                places, new = by_times[k], len(members)
                members.append(sorted(places))
                live.append(len(places))
                live[old] -= len(places)
                length.append(length[old] + k * size)
                below.append(last)
                above.append(top)
                above[last] = new
                for place in places:
                    group[place] = new
                last = new
            if top >= 0:
                below[top] = last
        now = below[now]
    return [length[g] for g in group]


def _of_stretch(codes: np.ndarray, min_length: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch of words."""
    own = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    n_codes, n = int(own.max()) + 1, len(own)
    found: set[tuple[int, int, int]] = set()
    words, places = own.tolist(), np.arange(n)
    for order in (own, n_codes - 1 - own):
        periods = np.array(lyndon_lengths(order.tolist(), n_codes))
        ends = places + periods
        right = own[np.minimum(ends, n - 1)] == own
        right[ends >= n] = False
        left = np.zeros(n, dtype=bool)
        left[1:] = own[:-1] == own[ends[1:] - 1]
        known: dict[int, tuple[int, int]] = {}
        for at in np.flatnonzero(left | right).tolist():
            period = int(periods[at])
            start, end = known.get(period, (0, 0))
            if start <= at and at + period < end:
                continue  # another root of a run already extended
            start, end = at, at + period
            while start and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while end < n and words[end] == words[end - period]:
                end += 1
            if end - start >= 2 * period:
                known[period] = (start, end)
                if end - start >= min_length:
                    found.add((start, end - start, period))
    return found


def _stretches(codes: np.ndarray, bounds: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """Maximal stretches of windows that occur again within their text; bounds are the places where texts begin and end."""
    n = len(codes)
    if n < 2 * window:
        return
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = np.zeros(n - window + 1, dtype=np.uint64)
    for k in range(window):
        key = (key ^ codes[k : k + len(key)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    inside = np.flatnonzero(text[: len(key)] == text[window - 1 :])
    key = (key[inside] ^ (text[inside].astype(np.uint64) << np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = inside[again]
    if len(starts):
        # windows of one text that touch are one stretch
        new = np.flatnonzero((np.diff(starts) > window) | (text[starts[1:]] != text[starts[:-1]])) + 1
        for a, b in pairwise([0, *new.tolist(), len(starts)]):
            yield int(starts[a]), int(starts[b - 1]) + window


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start, then period."""
    bounds = np.cumsum([0, *map(len, texts)])
    flat = pa.array([w for words in texts for w in words], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end in _stretches(codes, bounds, -(-min_length // 2)):
        text = int(np.searchsorted(bounds, start, side="right")) - 1
        shift = start - int(bounds[text])
        found[text] += [(a + shift, length, period) for a, length, period in _of_stretch(codes[start:end], min_length)]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run holds after its first period, joined by one space."""
    if runs:
        stays = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            stays[start + period : start + length] = False
        words = [words[k] for k in np.flatnonzero(stays).tolist()]
    return b" ".join(words).decode()


def find(docs: DataFrame, keep: list[str] | None = None, text_col="text", min_length: int = MIN_LENGTH) -> DataFrame:
    """keep (default: all columns), n_words, runs (start, length and period in words, by start, then period), collapsed."""
    if min_length < 2:
        raise ValueError("a run has two words at least")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]

    def start():
        kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

        def compute(texts: list) -> list:
            words = [(t or "").encode().split() for t in texts]  # at ASCII white space, which is what splits bytes
            runs = runs_of(words, min_length)
            shown = [[dict(zip(RUN.names, r, strict=True)) for r in own] for own in runs]
            return [
                pa.array([len(w) for w in words], pa.int64()),
                pa.array(shown, kind),
                pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.string()),
            ]

        return compute

    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, True)), T.StructField("collapsed", T.StringType())]
    return common.with_computed(docs, keep, text_col, added, start)
