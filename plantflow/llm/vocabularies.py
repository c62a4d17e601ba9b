"""Tokenizer files, opened once per Python worker, and encoding by cached pieces.

Byte-level BPE never merges across the boundary between a character that is not white space and the space after it:
every alternative of the pattern ends there. So a text is the sequence of its pieces, each encoded alone by the library,
and frequent pieces need the library once per worker. `pieces` cuts only at such places.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from plantflow.llm import common

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces kept by a worker, in two generations, and the longest piece kept: what bounds its memory.
MAX_CACHED = 800_000
MAX_CACHED_CHARS = 48
#: The same for pieces kept by number, which take less.
MAX_NUMBERED = 1_200_000
#: Pieces handed to the library at once, by their characters.
BATCH_CHARS = 65_536

#: Characters that some definition calls white space, other than ASCII space and line breaks.
ODD_WHITE = "\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿"
#: A space or line break after white space: there is no cut before it.
_RUN = re.compile(f"[{ODD_WHITE} \n\t\r][ \n]")
_CUT = re.compile(f"(?<=[^{ODD_WHITE} \n\t\r])(?=[ \n\t\r])")
_WHITE = frozenset(c for c in map(chr, range(0x10000)) if re.match(f"[{ODD_WHITE} \n\t\r]", c))


def byte_characters() -> dict[int, str]:
    """Byte to the printable character that stands for it in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def from_json(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def from_ranks(path: str, pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    """A rank file as a tokenizer of the library: any two neighbours that join to a ranked string may merge, lowest
    rank first, and a pre-token that is ranked itself is one token."""
    ranks = read_ranks(path)
    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token, rank in ranks.items():
        cuts = [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        merges += [(rank, ranks[a], ranks[b], text[a], text[b]) for a, b in cuts]
    merges.sort()
    vocab = {text[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=[m[3:] for m in merges], ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def token_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of every id; special tokens are their own text."""
    back = {c: b for b, c in byte_characters().items()}
    special = set(tokenizer.get_added_tokens_decoder())
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        table[i] = token.encode() if i in special else bytes(back[c] for c in token)
    return table


def pieces(text: str) -> tuple[list[str], list[str]]:
    """(whole, spaced): the text is the whole pieces, then the spaced ones, each after one space unless it begins with a
    line break."""
    if _RUN.search(text) is None:
        first, *rest = text.replace("\n", " \n").split(" ")
        return ([first] if first else []), rest
    cuts = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in pairwise(cuts)], []


def batched(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of a bounded number of characters; a longer text is a run of its own."""
    ends = np.cumsum([*map(len, texts)])
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + BATCH_CHARS, side="right")))
        yield texts[start:end]
        start = end


_ABSENT = object()


class PieceCache:
    """Values of pieces, looked up, or made by `learn` where not known yet.

    learn(texts, joined) gets pieces with what stands before them, and whether they may be read as one text, one after
    the other. Pieces are kept in two generations: when the younger is full it becomes the older, whose pieces move back
    as they are met again. So memory is bounded whatever the corpus holds, and frequent pieces stay; long ones are never
    kept.
    """

    def __init__(self, learn: Callable[[list[str], bool], list], most: int | None = None):
        self.learn, self.most = learn, most or MAX_CACHED
        self.whole: list[dict[str, object]] = [{}, {}]
        self.spaced: list[dict[str, object]] = [{}, {}]

    def pieces(self, text: str) -> tuple[list[str], list[str]]:
        return pieces(text)

    def _learn(self, new: list[str], prefix: str) -> dict:
        fresh: dict[str, object] = {}
        for own in batched(new):
            chained = [x for x in own if prefix and x and x[-1] not in _WHITE]
            apart = own if not chained else [x for x in own if not x or x[-1] in _WHITE]
            for texts, joined in ((chained, True), (apart, False)):
                if texts:
                    whole = [x if x.startswith("\n") else prefix + x for x in texts]
                    fresh.update(zip(texts, self.learn(whole, joined), strict=True))
        return fresh

    def _known(self, kept: list[dict], parts: list[str], prefix: str) -> dict:
        """Values of all parts, of which those that may be kept are in the younger generation afterwards."""
        younger, older = kept
        met = {x: younger.get(x, _ABSENT) for x in set(parts)}
        missing = [x for x, value in met.items() if value is _ABSENT]
        moved = {x: older[x] for x in missing if x in older}
        fresh = moved | self._learn([x for x in missing if x not in moved], prefix)
        if len(younger) + len(fresh) > self.most // 2:
            kept[:] = [{}, younger]
        kept[0].update((x, value) for x, value in fresh.items() if len(x) <= MAX_CACHED_CHARS)
        return met | fresh

    def _of(self, kept: list[dict], parts: list[str], prefix: str) -> list:
        try:
            known = kept[0]
            return [known[x] for x in parts]
        except KeyError:
            known = self._known(kept, parts, prefix)
            return [known[x] for x in parts]

    def of(self, text: str) -> list:
        """The values of the text's pieces, in order."""
        whole, spaced = self.pieces(text)
        return self._of(self.whole, whole, "") + self._of(self.spaced, spaced, " ")

    def of_texts(self, texts: list[str]) -> list[list]:
        """The same for many texts, whose new pieces are learned together."""
        cut = [self.pieces(t) for t in texts]
        for kept, prefix, parts in ((self.whole, "", [x for w, _ in cut for x in w]), (self.spaced, " ", [x for _, s in cut for x in s])):
            known = kept[0]
            if not all(map(known.__contains__, parts)):
                self._known(kept, parts, prefix)
        return [self._of(self.whole, w, "") + self._of(self.spaced, s, " ") for w, s in cut]


class IdCache(PieceCache):
    """Ids of pieces by the library, as bytes of a little-endian type that holds the vocabulary."""

    def __init__(self, tokenizer: Tokenizer):
        table = token_bytes(tokenizer)
        self.tokenizer = tokenizer
        self.dtype = np.dtype("<u2" if len(table) <= 1 << 16 else "<u4")
        self.lengths = np.array([len(b) for b in table], dtype=np.int64)
        super().__init__(self._encode)

    def _encode(self, texts: list[str], joined: bool) -> list[bytes]:
        """Of a joined text, the lengths of its tokens tell where each piece ends."""
        if not joined:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]
        ids, counts = self._joined(texts)
        packed, size = ids.tobytes(), self.dtype.itemsize
        return [packed[a:b] for a, b in pairwise([0, *(np.cumsum(counts) * size).tolist()])]

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts read as one, and how many of them each text has."""
        (all_of_it,) = self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)
        ids = np.array(all_of_it.ids, dtype=self.dtype)
        ends = np.cumsum(pc.binary_length(pa.array(texts, pa.string())).to_numpy())
        return ids, np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1, prepend=0)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.of(text)), dtype=self.dtype)


@lru_cache(maxsize=4)
def ids_of_worker(open_: Callable[[str], Tokenizer], path: str) -> IdCache:
    """One cache for all tasks of a Python worker."""
    return IdCache(open_(path))


class _Numbers(dict):
    """Numbers of pieces; a new piece gets the next one, and is noted."""

    def __init__(self, numbered: list[int]):
        super().__init__()
        self.numbered, self.new = numbered, []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = self.numbered[0]
        self.numbered[0] += 1
        self.new.append((piece, number))
        return number


    def of_distinct(self, pieces: list[str]) -> np.ndarray:
        """The numbers of pieces that differ from each other."""
        found = [*map(self.get, pieces)]
        new = [piece for piece, number in zip(pieces, found, strict=True) if number is None]
        own = range(self.numbered[0], self.numbered[0] + len(new))
        self.numbered[0] += len(new)
        self.update(zip(new, own, strict=True))
        self.new += zip(new, own, strict=True)
        numbers = np.array([-1 if n is None else n for n in found], dtype=np.int64)
        numbers[numbers < 0] = own
        return numbers


class NumberedPieces:
    """Texts as numbers of their pieces. younger and older have whole and spaced pieces (_Numbers) and what belongs to a
    number; pieces(text) cuts texts with runs of white space, most bounds what is kept."""

    def _odd(self, texts: pa.Array) -> np.ndarray:
        return pc.match_substring_regex(texts, _RUN.pattern).to_numpy(zero_copy_only=False)

    def _split(self, texts: pa.Array) -> np.ndarray:
        """Numbers of the pieces of texts without a run, and 0 after each text. Arrow cuts, so that only distinct pieces
        of all texts become Python strings."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        flat, counts = parts.flatten(), pc.list_value_length(parts).to_numpy()
        place = np.arange(len(flat)) + np.repeat(np.arange(len(texts)), counts)
        first = np.cumsum(counts) - counts
        later = np.ones(len(flat), dtype=bool)
        later[first] = False
        spaced = flat.filter(pa.array(later)).dictionary_encode()
        known = self.younger.spaced.of_distinct(common.spaceless(spaced.dictionary))
        numbers = np.zeros(len(flat) + len(texts), dtype=np.int64)
        numbers[place[later]] = known[spaced.indices.to_numpy()]
        whole = common.spaceless(flat.take(pa.array(first)))
        numbers[place[first]] = [self.younger.whole[x] if x else -1 for x in whole]
        return numbers[numbers >= 0]

    def _numbers(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces, and 0 after each text; and which of the texts, in their order here, stands where."""
        even = np.flatnonzero(~odd)
        numbers = self._split(texts.take(pa.array(even))) if len(even) else np.zeros(0, dtype=np.int64)
        cut: list[int] = []
        for text in texts.filter(pa.array(odd)).to_pylist():
            whole, spaced = self.pieces(text)
            cut += [*map(self.younger.whole.__getitem__, whole), *map(self.younger.spaced.__getitem__, spaced), 0]
        order = np.argsort(np.concatenate([even, np.flatnonzero(odd)]))
        return np.concatenate([numbers, np.array(cut, dtype=np.int64)]), order

    def _forget(self, held: int) -> None:
        """held: how many ids or links the younger generation has."""
        own = self.younger
        for known in (own.whole, own.spaced):
            for piece, _ in known.new:
                if len(piece) > MAX_CACHED_CHARS:
                    del known[piece]
            known.new.clear()
        if own.numbered[0] > self.most // 2 or held > MAX_CACHED_CHARS * self.most // 4:
            self.younger, self.older = own.fresh(), own


def whole_batches(new: list[tuple[str, int]], prefix: str) -> Iterator[tuple[list[int], list[str], bool]]:
    """Numbers of pieces, the pieces with what stands before them, and whether they may be read as one text, in runs."""
    whole = [x if x[:1] == "\n" else prefix + x for x, _ in new]
    numbers = [n for _, n in new]
    white = [x[-1] in _WHITE for x in whole] if prefix else [True] * len(whole)
    for joined in (True, False):
        texts = [x for x, odd in zip(whole, white, strict=True) if odd != joined]
        own = [n for n, odd in zip(numbers, white, strict=True) if odd != joined]
        start = 0
        for some in batched(texts):
            yield own[start : start + len(some)], some, joined
            start += len(some)


class _Generation:
    """Pieces by number, whole and spaced ones, and where the ids of each are among those of all; 0 is the end of a text."""

    def __init__(self, end: np.ndarray):
        self.numbered = [1]
        self.whole, self.spaced = _Numbers(self.numbered), _Numbers(self.numbered)
        self.end = self.flat = end
        self.starts, self.sizes = np.array([0]), np.array([len(end)])

    def fresh(self) -> _Generation:
        return _Generation(self.end)

    def gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbers, one after the other, and how many each has."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return self.flat[places], sizes

    def add(self, parts: list[tuple[list[int], np.ndarray, np.ndarray]]) -> None:
        """Ids of all numbers that have none yet: numbers, their ids, how many each has."""
        numbers, sizes = np.concatenate([np.array(n, dtype=np.int64) for n, _, _ in parts]), np.concatenate([x for _, _, x in parts])
        more = np.zeros((2, len(numbers)), dtype=np.int64)
        more[:, numbers - len(self.starts)] = len(self.flat) + np.cumsum(sizes) - sizes, sizes
        self.flat = np.concatenate([self.flat, *(x for _, x, _ in parts)])
        self.starts, self.sizes = np.concatenate([self.starts, more[0]]), np.concatenate([self.sizes, more[1]])


class NumberedIds(NumberedPieces, IdCache):
    """Ids of many texts at once, each ended by end_id: every piece is looked up once, for a number, and the numbers'
    ids are gathered by numpy. Generations bound the memory as in PieceCache; a generation also ends by its ids."""

    def __init__(self, tokenizer: Tokenizer, end_id: int):
        super().__init__(tokenizer)
        self.most = MAX_NUMBERED
        self.dtype = np.dtype("<u4") if end_id > np.iinfo(self.dtype).max else self.dtype
        end = np.array([end_id], dtype=self.dtype)
        self.younger, self.older = _Generation(end), _Generation(end)

    def _learned(self, new: list[tuple[str, int]], prefix: str) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        for numbers, texts, joined in whole_batches(new, prefix):
            if joined:
                yield numbers, *self._joined(texts)
            else:
                found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                yield numbers, np.array([i for x in found for i in x], dtype=self.dtype), np.array(list(map(len, found)))

    def _add_new(self) -> None:
        """Ids of the pieces that have got a number, from the older generation or the library."""
        parts = []
        for known, kept, prefix in ((self.younger.whole, self.older.whole, ""), (self.younger.spaced, self.older.spaced, " ")):
            earlier = [kept.get(piece) for piece, _ in known.new]
            moved = [n for n in earlier if n is not None]
            if moved:
                numbers = [n for (_, n), before in zip(known.new, earlier, strict=True) if before is not None]
                parts.append((numbers, *self.older.gathered(np.array(moved))))
            parts += self._learned([x for x, before in zip(known.new, earlier, strict=True) if before is None], prefix)
        if parts:
            self.younger.add(parts)

    def of_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, with its end; a null is an empty text."""
        texts = pc.fill_null(texts, "")
        numbers, order = self._numbers(texts, self._odd(texts))
        self._add_new()
        ids, sizes = self.younger.gathered(numbers)
        self._forget(len(self.younger.flat))
        each = np.split(ids, np.cumsum(sizes)[numbers == 0][:-1])
        return [each[k] for k in order.tolist()]


@lru_cache(maxsize=4)
def numbered_ids_of_worker(open_: Callable[[str], Tokenizer], path: str, end_id: int) -> NumberedIds:
    """One cache for all tasks of a Python worker."""
    return NumberedIds(open_(path), end_id)
