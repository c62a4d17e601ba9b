"""Benchmark decontamination: an FM-index per training shard, searched backwards for test phrases.

A shard is a run of documents inside a task. Its words become numbers (0: no word of the benchmark) and only stretches
that could hold a phrase are indexed, each ended by a separator of its own: phrases can't stand anywhere else. The
index is the Burrows-Wheeler transform of the stretches with a wavelet matrix for ranks and every SAMPLE-th suffix
position. All phrases are searched at once, step by step from their last word; occurrences are located by walking back
to the next sampled position; the spans they cover are merged per document.

A phrase is a window of 13 consecutive words of a benchmark item, or the whole item if it has fewer words. The benchmark
is dealt into blocks of bounded size. Each block is one pass over the documents, whose hits are written before the next
block is read; so neither what is broadcast nor what the driver or a task holds grows with either table.

Null and empty texts have no words and are never hit; items without words have no phrases. Repeated rows get the same
result each; equal items, each with an id of its own, are all listed; items with a null id hit, but are not listed. An
empty table of documents gives no rows, an empty benchmark no hits. Results are appended to the columns asked for.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow.llm import common, suffixes

WINDOW = 13
SAMPLE = 8
#: Words of a shard, and bytes of benchmark text searched in one pass.
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 4 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


class Phrases:
    """The distinct windows of some items as rows of word numbers from 1, padded with 0, and the items of each."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for k in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                owners.setdefault(tuple(ids[k : k + WINDOW]), set()).update(() if item is None else (item,))
        self.lengths = np.array([len(w) for w in owners], dtype=np.int64)
        self.rows = np.zeros((len(owners), WINDOW), dtype=np.int64)
        for k, w in enumerate(owners):
            self.rows[k, : len(w)] = w
        self.items = [sorted(own) for own in owners.values()]


class FMIndex:
    """Over numbers from 1; a 0 ends each stretch and is never searched for."""

    def __init__(self, stream: np.ndarray):
        n = len(stream)
        ends = stream == 0
        order = suffixes.suffix_array(stream)
        self.transform = stream[order - 1]  # the one before the first is the last, a separator
        counts = np.bincount(stream, minlength=int(stream.max(initial=0)) + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        at_start = np.concatenate([[True], ends[:-1]])
        self.sampled = (at_start | (np.arange(n) % SAMPLE == 0))[order]
        self.samples = order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.levels = []
        symbols = self.transform
        for bit in reversed(range(max(1, int(stream.max(initial=0)).bit_length()))):
            ones = (symbols >> bit) & 1
            ranks = np.concatenate([[0], np.cumsum(ones)]).astype(np.int64)
            self.levels.append((bit, ranks, n - int(ranks[-1])))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each end."""
        begin = np.zeros_like(end)
        for bit, ranks, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            a, b = ranks[begin], ranks[end]
            begin, end = np.where(one, zeros + a, begin - a), np.where(one, zeros + b, end - b)
        return end - begin

    def search(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase; empty ranges have no length."""
        lo = np.zeros(len(rows), dtype=np.int64)
        hi = np.full(len(rows), len(self.transform), dtype=np.int64)
        highest = len(self.first) - 2
        for step in range(rows.shape[1]):
            own = np.flatnonzero((lengths > step) & (lo < hi))
            symbol = rows[own, lengths[own] - 1 - step]
            known = symbol < highest
            hi[own[~known]] = lo[own[~known]]
            own, symbol = own[known], symbol[known]
            lo[own], hi[own] = (self.first[symbol] + self.rank(symbol, end[own]) for end in (lo, hi))
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Places in the stream of these suffixes."""
        steps, row = np.zeros(len(at), dtype=np.int64), at.copy()
        open_ = np.flatnonzero(~self.sampled[row])
        while len(open_):
            symbol = self.transform[row[open_]]
            row[open_] = self.first[symbol] + self.rank(symbol, row[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[row[open_]]]
        return self.samples[self.sample_rank[row]] + steps


def _candidates(ids: np.ndarray, shortest: int) -> np.ndarray:
    """Places of the stretches without 0 that are long enough for a phrase, each with the place of the 0 after it."""
    known = np.concatenate([[0], (ids != 0).view(np.int8), [0]])
    edges = np.diff(known)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= shortest
    marks = np.zeros(len(ids) + 2, dtype=np.int32)
    np.add.at(marks, starts[long], 1)
    np.add.at(marks, ends[long] + 1, -1)  # the 0 after it belongs to the stretch
    return np.flatnonzero(np.cumsum(marks)[: len(ids)] > 0)


def hits(texts: list[str | None], phrases: Phrases) -> Iterator[tuple[int, list[list[int]], list[int]]]:
    """Per text: its words, the merged spans of words inside phrases, and the items of these, for one shard."""
    get = phrases.vocabulary.get
    numbers = [[get(w, 0) for w in words_of(t)] for t in texts]
    ids = np.fromiter((x for own in numbers for x in (*own, 0)), dtype=np.int64)
    counts = np.array([len(own) for own in numbers], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(counts + 1)])[: len(texts)]
    spans: list[list[list[int]]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    places = _candidates(ids, int(phrases.lengths.min())) if len(phrases.lengths) else np.empty(0, np.int64)
    if len(places):
        index = FMIndex(ids[places])
        lo, hi = index.search(phrases.rows, phrases.lengths)
        sizes = hi - lo
        which = np.repeat(np.arange(len(sizes)), sizes)
        suffix = np.repeat(lo, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = places[index.locate(suffix)]
        change = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + phrases.lengths[which], -1)
        covered = np.concatenate([[0], (np.cumsum(change) > 0).view(np.int8)])
        edges = np.diff(covered)
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        doc = np.searchsorted(begins, first, side="right") - 1
        for d, a, b in zip(doc.tolist(), (first - begins[doc]).tolist(), (last - begins[doc]).tolist(), strict=True):
            spans[d].append([a, b])
        owner = np.searchsorted(begins, at, side="right") - 1
        for d, w in np.unique(np.stack([owner, which], axis=1), axis=0).tolist():
            items[d].update(phrases.items[w])
    return zip(counts.tolist(), spans, map(sorted, items), strict=True)


def _blocks(benchmark: DataFrame) -> tuple[int, Callable[[int], list[tuple]]]:
    """How many blocks of about BLOCK_BYTES the items' measured size asks for, and the items of one of them."""
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").alias("t")).filter("t IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    return n, lambda k: [tuple(r) for r in items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


_SPANS = T.ArrayType(T.ArrayType(T.IntegerType(), False), False)
_ITEMS = T.ArrayType(T.LongType(), False)
_FOUND = [T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS), T.StructField("items", _ITEMS)]
_KINDS = [pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64())]


def _pass(frame: DataFrame, keep: list[str], phrases: Broadcast) -> DataFrame:
    """keep and what is found of one block of phrases in the documents (__text)."""
    names = [*keep, "n_words", "spans", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Phrases(phrases.value)
        for batch in batches:
            for part in common.slices(batch, "__text", SHARD_WORDS * 4):
                found = list(hits(part.column("__text").to_pylist(), own))
                arrays = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(_KINDS)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *arrays], names=names)

    return frame.mapInArrow(run, T.StructType([*(frame.schema[c] for c in keep), *_FOUND]))


def _merged(spans: Column) -> Column:
    """merged() of an array of spans."""

    def step(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.array(last[0], F.greatest(last[1], span[1]))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (span[0] <= last[1]), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<array<int>>"), step)


def search(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep (but for columns named as the following), n_words, spans ([first word, one after the last], merged), items (ids
    of the items with hits, ascending)."""
    spark = docs.sparkSession
    keep = [c for c in keep if c not in ("n_words", "spans", "items")]
    frame = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("__text"))
    n, block = _blocks(benchmark)
    if n == 1:
        return _pass(frame, keep, spark.sparkContext.broadcast(block(0)))
    folder = f"{common.shared_dir(spark)}/decontamination-{uuid.uuid4().hex}"
    frame.withColumn("__row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{folder}/documents")
    numbered = spark.read.schema(T.StructType([*frame.schema, T.StructField("__row", T.LongType())])).parquet(f"{folder}/documents")
    for k in range(n):  # one block at a time in the driver and in the tasks; of all but the first only documents with hits
        phrases = spark.sparkContext.broadcast(block(k))
        found = _pass(numbered.select("__row", "__text"), ["__row"], phrases)
        (found if k == 0 else found.filter(F.size("spans") > 0)).write.parquet(f"{folder}/found/block={k}")
        phrases.destroy()
    found = spark.read.schema(T.StructType([T.StructField("__row", T.LongType()), *_FOUND])).parquet(f"{folder}/found")
    per_row = found.groupBy("__row").agg(
        F.max("n_words").alias("n_words"),
        _merged(F.flatten(F.collect_list("spans"))).alias("spans"),  # of one document
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return numbered.drop("__text").join(per_row, "__row").drop("__row")


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))


def contaminated(found: Column, words: Column) -> Column:
    """At least a twentieth of the words hit."""
    return (found > 0) & (20 * found >= words)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    row = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    found = search(row, benchmark, keep=["__row"])
    return found.filter(~contaminated(n_hit(), F.col("n_words"))).select("__row.*")


def without_spans(text: str | None, spans: list[list[int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not spans or text is None:
        return text
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.lower())]
    kept, end = [], 0
    for a, b in spans:
        kept.append(raw[end : at[a][0]])
        end = at[b - 1][1]
    return b"".join([*kept, raw[end:]]).decode()
