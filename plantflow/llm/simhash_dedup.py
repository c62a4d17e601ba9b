"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set if over half of its 4-word shingles' XXH64 hashes have it. Fingerprints link at
RADIUS or fewer differing bits. Every bit position gets a random non-zero vector of RADIUS + 1 bits; for each of the
2^(RADIUS+1) - 1 non-zero vectors v there is a table, whose mask keeps the positions whose vector has odd overlap with
v. For at most RADIUS differing positions some v is orthogonal to all of their vectors, and in its table the two agree:
every linked pair meets in some bucket, whatever the draw.

Only distinct fingerprints are put into tables, counted by bucket before anything is gathered. Buckets of two give their
pair at once. Larger ones are dealt into chunks, and each pair of chunks is compared in a task of its own, which returns
a spanning forest instead of all pairs; no bucket is ever cut off. Components are found by joins (components.py).

Words are runs without ASCII white space, A-Z lower-cased; a shorter text is one shingle; a null text or one without
words has fingerprint zero, linked like any other. Rows that repeat get a row each, with the same component. A null id
is larger than all others. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow.llm import common, components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Distinct fingerprints in a chunk of a large bucket.
CHUNK = 2048


def fingerprint(text: str | None) -> int:
    """As a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, digest = len(words) - size + 1, xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 14):
        b = min(n, a + (1 << 14))
        spans = zip(starts[a:b].tolist(), ends[a + size - 1 : b + size - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[x:y], SEED) for x, y in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def masks(radius: int = RADIUS, seed: int = SEED) -> list[int]:
    """Of the tables, as signed 64-bit numbers."""
    draw = random.Random(seed)
    vectors = [draw.randrange(1, 1 << (radius + 1)) for _ in range(64)]
    kept = [
        sum(1 << bit for bit, own in enumerate(vectors) if (own & v).bit_count() & 1) for v in range(1, 1 << (radius + 1))
    ]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", name: str = "fp") -> DataFrame:
    def start():
        return lambda texts: [pa.array([fingerprint(t) for t in texts], pa.int64())]

    return common.with_computed(docs, keep, text_col, [T.StructField(name, T.LongType())], start)


def _forest(group: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is connected inside the group."""
    values, links = group.view(np.uint64), []
    rest = np.arange(len(group))
    while len(rest) > 1:
        root, front, rest = int(group[rest[0]]), rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            for a in range(0, len(front), 64):
                near |= (np.bitwise_count(values[front[a : a + 64], None] ^ values[rest]) <= radius).any(axis=0)
            front, rest = rest[near], rest[~near]
            links += [(int(x), root) for x in group[front]]
    return links


def links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(a, b) of fingerprints that connects all of distinct (one column, fp) that are linked, directly or by others."""
    tables = F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks(radius))))
    placed = distinct.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    buckets = placed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    buckets = common.cut(buckets.filter((F.col("n") > 2) | (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).filter("n > 1"))
    pairs = buckets.filter("n = 2").select("a", "b")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    large = (
        placed.join(buckets.filter("n > 2").select("t", "key", "n"), ["t", "key"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .groupBy("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))  # two chunks at most
        .select("fps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("fps")
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            found = [x for a, b in zip(ends, ends[1:], strict=False) for x in _forest(np.unique(flat[a:b]), radius)]
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.union(large.mapInArrow(run, "a long, b long"))


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, component (the smallest fingerprint of it) and first, the smallest (no id, id, fp) of the component.

    prints: id and fp.
    """
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp")))
    distinct = common.cut(prints.groupBy("fp").agg(F.min("id").alias("id")))
    found = components.smallest_reachable(links(distinct.select("fp"), radius))
    own = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "id", "fp", F.coalesce("component", "fp").alias("component")
    )
    first = own.groupBy("component").agg(smallest.alias("first"))
    return own.select("fp", "component").join(first, "component").select("fp", "component", "first")


def dedup(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: the id, fingerprint in hex, and component_id, the smallest id reachable."""
    prints = common.cut(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id"]))
    found = classes(prints, radius).select("fp", F.col("first.id").alias("component_id"))
    return prints.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The first document of each component, as it is; of rows with its id and fingerprint, one."""
    own = docs.select(F.col("doc_id").alias("__id"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    prints = common.cut(fingerprints(docs.select(F.col("doc_id").alias("id"), "text"), ["id"]))
    first = classes(prints, radius).select(F.col("first.id").alias("id"), F.col("first.fp").alias("fp")).distinct()
    rows = fingerprints(own, ["__id", "__row"], name="__fp")
    kept = rows.join(first, rows["__id"].eqNullSafe(first["id"]) & (rows["__fp"] == first["fp"]), "left_semi")
    return kept.dropDuplicates(["__id", "__fp"]).select("__row.*")
