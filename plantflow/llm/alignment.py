"""Alignment of two tokenizers' tokens, with inverted bitmaps of linked pairs.

The first tokenizer, byte-level BPE, reads space and text; the second, BPE over pieces with byte fallback, reads the
text, to which it adds that space itself. Where tokens of both end at the same byte, the text is cut into groups; every
token of one side is linked with every token of the other side in its group.

`align` tokenizes once. It writes, for each block of documents, the groups of each document, and for each pair of ids
linked in it a compressed bitmap of the documents that hold the pair, and bitmaps for the binary digits of how many more
links than one they hold (planes). Bitmaps of one pair, plane and block are united, their sizes give the documents and
the links of a pair in the corpus. The same postings then carry a pair's count back to the documents (`scores`). Nothing
is gathered for a pair beyond one block's bitmap, so a pair that all documents hold is no larger than any other.

A text that is null or empty, or that either tokenizer doesn't give back byte for byte, has no tokens: zeros and an empty
text for its groups. Null ids and repeated rows are documents of their own: rows are told apart by block and row, not by
id. An empty table gives no rows. Columns of the input other than those kept are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plantflow.llm import common, postings, vocabularies

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Links gathered before the bitmaps of what a block has so far are written; they are united afterwards.
MOST_LINKS = 2_000_000
#: Bytes of text handled at once, and pieces kept by a worker: with the links, what bounds its memory.
SLICE_BYTES, MOST_PIECES = 1 << 20, 400_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_SPACE = "▁"


@lru_cache(maxsize=2)
def _plain(path: str) -> Tokenizer:
    """The tokenizer that takes the strings of special tokens as ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[SentencePieceProcessor, list[bytes], str]:
    """The processor, the bytes of every id, and the characters before which a text may be cut: white space that no piece
    holds after another character, so that nothing is ever merged across."""
    processor = SentencePieceProcessor(model_file=path)
    table, inner = [], set()
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            table.append(bytes([int(piece[3:5], 16)]))
            continue
        table.append(piece.replace(_SPACE, " ").encode())
        inner.update(piece[max(1, len(piece) - len(piece.lstrip(_SPACE))) :])
    if _SPACE in inner:
        return processor, table, ""
    return processor, table, " " + "".join(c for c in "\n\t\r" if c not in inner)


class Text(NamedTuple):
    """Tokens of a text: how many of each side, its groups as text, and the links as numbers of pairs."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: np.ndarray


@dataclass
class Pieces:
    """Of pieces one after the other: n_a, n_b, n_groups (-1 each if a piece is not given back), the groups as text, a
    semicolon before each, links as numbers of pairs, and how many of these each piece has."""

    counts: np.ndarray
    groups: pa.Array
    links: np.ndarray
    sizes: np.ndarray

    def __post_init__(self):
        self.starts = np.cumsum(self.sizes) - self.sizes

    def at(self, numbers: np.ndarray) -> Pieces:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return Pieces(self.counts[numbers], self.groups.take(pa.array(numbers)), self.links[places], sizes)


def _united_pieces(parts: list[Pieces]) -> Pieces:
    groups = pa.concat_arrays([x.groups for x in parts])
    return Pieces(np.concatenate([x.counts for x in parts]), groups, *(np.concatenate(x) for x in ([y.links for y in parts], [y.sizes for y in parts])))


class _Generation:
    """Pieces by number, and what is known of each; 0 is the end of a text."""

    def __init__(self):
        self.numbered = [1]
        self.whole, self.spaced = vocabularies._Numbers(self.numbered), vocabularies._Numbers(self.numbered)
        self.known = Pieces(np.zeros((1, 3), dtype=np.int64), pa.array([""]), np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64))

    def fresh(self) -> _Generation:
        return _Generation()


class Aligner(vocabularies.NumberedPieces):
    """Groups and links of texts, by kept pieces between white space."""

    def __init__(self, path_a: str, path_b: str):
        self.a = _plain(path_a)
        self.b, self.bytes_b, self.cuts = _pieces(path_b)
        self.bytes_a = vocabularies.token_bytes(self.a)
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        white = vocabularies.ODD_WHITE + " \n\t\r"
        self.cut = re.compile(f"(?<=[^{white}])(?=[{self.cuts}])" if self.cuts else "(?!)")
        self.most = MOST_PIECES
        self.younger, self.older = _Generation(), _Generation()

    def pieces(self, text: str) -> tuple[list[str], list[str]]:
        whole, spaced = vocabularies.pieces(text) if {" ", "\n"} <= set(self.cuts) else ([text], [])
        if spaced:
            return whole, spaced
        return [text[x:y] for x, y in pairwise([0, *(m.start() for m in self.cut.finditer(text)), len(text)])], []

    def _groups(self, ids_a: list[int], ids_b: list[int], piece_ends: np.ndarray) -> Pieces:
        """Pieces of a text from the tokens of all of it, and where in its bytes each piece ends."""
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), max(0, len(ends_b) - 1))] == ends_a] if len(ends_b) else ends_b
        ends = ends[np.append(True, ends[1:] != ends[:-1])[: len(ends)]]
        to_a, to_b = (np.concatenate([[0], np.searchsorted(own, ends) + 1]) for own in (ends_a, ends_b))
        n_a, n_b = np.diff(to_a), np.diff(to_b)
        each = n_a * n_b
        to_link = np.concatenate([[0], np.cumsum(each)])
        group = np.repeat(np.arange(len(ends)), each)
        k = np.arange(len(group)) - to_link[group]
        links = a[to_a[group] + k // n_b[group]] * len(self.bytes_b) + b[to_b[group] + k % n_b[group]]
        text_a, text_b = list(map(str, ids_a)), list(map(str, ids_b))
        cuts_a, cuts_b = to_a.tolist(), to_b.tolist()
        shown = [
            f";{text_a[i]}|{text_b[x]}" if j == i + 1 and y == x + 1 else ";" + ",".join(text_a[i:j]) + "|" + ",".join(text_b[x:y])
            for (i, j), (x, y) in zip(pairwise(cuts_a), pairwise(cuts_b), strict=True)
        ]
        cuts = np.concatenate([[0], np.searchsorted(ends, piece_ends) + 1])
        counts = np.stack([np.diff(to_a[cuts]), np.diff(to_b[cuts]), np.diff(cuts)], axis=1)
        texts = pa.array([shown[i] if j == i + 1 else "".join(shown[i:j]) for i, j in pairwise(cuts.tolist())], pa.string())
        return Pieces(counts, texts, links, np.diff(to_link[cuts]))

    def _ids_b(self, text: str) -> list[int]:
        """Of a text with its leading space; of a piece from within a text, without the space that is added to it."""
        if text.startswith(" "):
            return self.b.encode(text[1:]) if len(text) > 1 else [self.b.piece_to_id(_SPACE)]
        return self.b.encode(text)[1:]

    def _align(self, texts: list[str], joined: bool) -> Pieces:
        """joined: whether the texts may be read as one, one after the other."""
        if joined:
            text = "".join(texts)
            a, b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self._ids_b(text)
            if b"".join(map(self.bytes_b.__getitem__, b)) == text.encode():
                return self._groups(a, b, np.cumsum([len(t.encode()) for t in texts]))
        all_a, all_b, ends, place = [], [], [], []
        for text, of_a in zip(texts, self.a.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            a, b, raw = of_a.ids, self._ids_b(text), text.encode()
            same = b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))
            place.append(len(ends) if same else -1)
            if same:
                all_a += a
                all_b += b
                ends.append(len(raw))
        lost = Pieces(np.full((1, 3), -1), pa.array([""]), np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64))
        if not ends:
            return lost.at(np.zeros(len(texts), dtype=np.int64))
        both = _united_pieces([self._groups(all_a, all_b, np.cumsum(ends)), lost])
        return both.at(np.array(place) % (len(ends) + 1))

    def _add_new(self) -> None:
        """What is known of the pieces that have got a number, from the older generation or both tokenizers."""
        numbers: list[int] = []
        parts: list[Pieces] = []
        for known, kept, prefix in ((self.younger.whole, self.older.whole, ""), (self.younger.spaced, self.older.spaced, " ")):
            earlier = [kept.get(piece) for piece, _ in known.new]
            moved = [n for n in earlier if n is not None]
            if moved:
                numbers += [n for (_, n), before in zip(known.new, earlier, strict=True) if before is not None]
                parts.append(self.older.known.at(np.array(moved)))
            new = [x for x, before in zip(known.new, earlier, strict=True) if before is None]
            for own, texts, joined in vocabularies.whole_batches(new, prefix):
                numbers += own
                parts.append(self._align(texts, joined))
        if parts:
            self.younger.known = _united_pieces([self.younger.known, _united_pieces(parts).at(np.argsort(numbers))])

    def of_column(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups of each text, its groups, all links, and how many each text has; zeros and an empty text
        where it is null, empty or not given back."""
        some = pc.fill_null(pc.not_equal(texts, ""), False).to_numpy(zero_copy_only=False)
        counts, groups, sizes = np.zeros((len(texts), 3), dtype=np.int64), [""] * len(texts), np.zeros(len(texts), dtype=np.int64)
        if not some.any():
            return counts, groups, np.zeros(0, dtype=np.int64), sizes
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts.filter(pa.array(some)), "")
        simple = {" ", "\n"} <= set(self.cuts)
        numbers, order = self._numbers(spaced, self._odd(spaced) if simple else np.ones(len(spaced), dtype=bool))
        lasts = np.flatnonzero(numbers == 0)
        firsts = np.append(0, lasts[:-1] + 1)
        if len(order) and (order != np.arange(len(order))).any():
            spans = [numbers[firsts[k] : lasts[k] + 1] for k in order.tolist()]
            numbers = np.concatenate(spans)
            lasts = np.cumsum(list(map(len, spans))) - 1
            firsts = np.append(0, lasts[:-1] + 1)
        self._add_new()
        found = self.younger.known.at(numbers)
        self._forget(len(self.younger.known.links))
        same = np.minimum.reduceat(found.counts[:, 0], firsts) >= 0
        own = np.flatnonzero(some)[same]
        counts[own] = np.add.reduceat(found.counts, firsts)[same]
        sizes[own] = np.add.reduceat(found.sizes, firsts)[same]
        offsets = np.frombuffer(found.groups.buffers()[1], np.int32)[: len(numbers) + 1]
        raw = memoryview(found.groups.buffers()[2])
        for k, a, b in zip(own.tolist(), offsets[firsts[same]].tolist(), offsets[lasts[same]].tolist(), strict=True):
            groups[k] = str(raw[a + 1 : b], "ascii")
        kept = np.repeat(np.repeat(same, lasts - firsts + 1), found.sizes)
        return counts, groups, found.links if same.all() else found.links[kept], sizes

    def of_documents(self, texts: list[str | None]) -> list[list[Text]]:
        """Each text as a whole; none where it is null, empty or not given back."""
        counts, groups, links, sizes = self.of_column(pa.array(texts, pa.string()))
        rows = zip(counts.tolist(), groups, np.split(links, np.cumsum(sizes)[:-1]), strict=True)
        return [[Text(*own, shown, linked)] if own[0] else [] for own, shown, linked in rows]


@lru_cache(maxsize=2)
def _aligner_of_worker(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


@dataclass(frozen=True)
class Alignment:
    """documents: block, row, the columns kept, n_a, n_b, n_groups, n_links, groups.
    postings: pair, plane, block, bitmap: united, a row each."""

    documents: DataFrame
    postings: DataFrame
    n_b: int


def align(docs: DataFrame, keep: list[str], path_a: str = BYTE_BPE, path_b: str = PIECE_BPE, text_col="text") -> Alignment:
    """Tokenizes and writes both tables into the shared folder."""
    spark = docs.sparkSession
    own = ["pair", "plane", "block", "row", "bitmap", "groups", *COUNTS]
    keep = [c for c in keep if c not in own]
    kept = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("__text"))
    fields = [("pair", T.LongType()), ("plane", T.IntegerType()), ("block", T.LongType()), ("row", T.IntegerType()), ("bitmap", T.BinaryType()), ("groups", T.StringType())]
    fields += [(c, T.LongType()) for c in COUNTS]
    schema = T.StructType([*(kept.schema[c] for c in keep), *(T.StructField(*f) for f in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner_of_worker(path_a, path_b)
        part = TaskContext.get().partitionId()
        number, links, many = 0, [], 0  # documents so far; (pair, row) of the block, as one number
        arrow = None

        def filled(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in arrow], schema=arrow)

        def written(block: int) -> Iterator[pa.RecordBatch]:
            keys, times = np.unique(np.concatenate(links), return_counts=True)
            more = times - 1
            for plane in range(int(more.max(initial=0)).bit_length() + 1):
                own = keys if plane == 0 else keys[more >> (plane - 1) & 1 == 1]
                pairs, counts = np.unique(own // postings.BLOCK, return_counts=True)
                shown = {"pair": pa.array(pairs), "plane": pa.array(np.full(len(pairs), plane)), "block": pa.array(np.full(len(pairs), block))}
                yield filled(shown | {"bitmap": postings.packed(own % postings.BLOCK, counts)}, len(pairs))

        for batch in batches:
            arrow = arrow or pa.schema([*(batch.schema.field(c) for c in keep), *_arrow(fields)])
            for some in common.slices(batch, "__text", SLICE_BYTES):
                counts, groups, own_links, sizes = aligner.of_column(some.column("__text"))
                at = number + np.arange(len(sizes))
                block = (part << 32) + at // postings.BLOCK
                shown = {c: some.column(c) for c in keep} | {"block": pa.array(block), "row": pa.array(at % postings.BLOCK)}
                for k, c in enumerate(("n_a", "n_b", "n_groups")):
                    shown[c] = pa.array(counts[:, k])
                shown["groups"] = pa.array(groups, pa.string())
                shown["n_links"] = pa.array(sizes)
                yield filled(shown, len(sizes))
                for k, x in zip(at.tolist(), np.split(own_links, np.cumsum(sizes)[:-1]), strict=True):
                    if links and (k % postings.BLOCK == 0 or many >= MOST_LINKS):
                        yield from written((part << 32) + (k - 1) // postings.BLOCK)
                        links, many = [], 0
                    links.append(x * postings.BLOCK + k % postings.BLOCK)
                    many += len(x)
                number += len(sizes)
        if links:
            yield from written((part << 32) + (number - 1) // postings.BLOCK)

    folder = f"{common.shared_dir(spark)}/alignment-{uuid.uuid4().hex}"
    rows = kept.mapInArrow(run, schema).withColumn("is_posting", F.col("pair").isNotNull())
    rows.write.partitionBy("is_posting").option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(T.StructType([*schema, T.StructField("is_posting", T.BooleanType())])).parquet(folder)
    parts = stored.filter("is_posting").groupBy("pair", "plane", "block").agg(F.collect_list("bitmap").alias("bitmaps"))  # of one block
    united = common.cut(_united(parts))
    documents = stored.filter("NOT is_posting").select("block", "row", *keep, *COUNTS, "groups")
    return Alignment(documents, united, len(_pieces(path_b)[1]))


def _arrow(fields: list[tuple[str, T.DataType]]) -> list[pa.Field]:
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.BinaryType: pa.binary(), T.StringType: pa.string()}
    return [pa.field(name, kinds[type(kind)]) for name, kind in fields]


def _united(parts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = postings.union(batch.column("bitmaps"))
            columns = [*(batch.column(c) for c in ("pair", "plane", "block")), pa.array(postings.sizes(bitmaps)), bitmaps]
            yield pa.RecordBatch.from_arrays(columns, names=["pair", "plane", "block", "size", "bitmap"])

    return parts.mapInArrow(run, "pair long, plane int, block long, size long, bitmap binary")


def pair_counts(found: Alignment) -> DataFrame:
    """Per pair of ids linked anywhere: pair (a * n_b + b), a, b, documents, links, and best: whether no other b has more
    documents with this a. One row a pair of two vocabularies at most."""
    documents = F.sum(F.when(F.col("plane") == 0, F.col("size")))
    links = F.sum(F.expr("size * shiftleft(1L, greatest(plane - 1, 0))"))
    sums = found.postings.groupBy("pair").agg(documents.alias("documents"), links.alias("links"))
    own = sums.withColumn("a", F.floor(F.col("pair") / found.n_b)).withColumn("b", F.col("pair") % found.n_b)
    most = own.groupBy("a").agg(F.max("documents").alias("most"))
    return own.join(most, "a").select("pair", "a", "b", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def scores(found: Alignment) -> DataFrame:
    """Per document with links: block, row, n_best (links whose pair is best), count_sum (documents of each link's pair)."""
    counts = common.cut(pair_counts(found).select("pair", "documents", "best"))
    told = common.join_counted(found.postings.select("pair", "plane", "block", "bitmap"), counts, ["pair"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = postings.Sums(2, np.int64)
        for batch in batches:
            rows, counts = postings.unpacked(batch.column("bitmap"))
            plane, block, documents = (batch.column(c).to_numpy() for c in ("plane", "block", "documents"))
            weight = np.int64(1) << np.maximum(plane.astype(np.int64) - 1, 0)
            best = weight * batch.column("best").to_numpy(zero_copy_only=False)
            sums.add(np.repeat(block, counts), rows, [np.repeat(best, counts), np.repeat(weight * documents, counts)])
        yield from sums.batches(["n_best", "count_sum"])

    narrow = told.select("plane", "block", "bitmap", "documents", "best").repartition("block")
    return narrow.mapInArrow(run, "block long, row int, n_best long, count_sum long")


def scored(found: Alignment, documents: DataFrame) -> DataFrame:
    """documents (block, row and any columns of found.documents), with n_best and count_sum."""
    zero = F.lit(0).cast("long")
    both = documents.join(scores(found), ["block", "row"], "left")
    return both.withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}).drop("block", "row")
