"""Token ids in files of fixed-width packed blocks.

Each id takes the fewest bits that hold the vocabulary. A file row is a block: the documents in it, the place of each in
the block, and their ids packed one after the other; ids lie in ascending order of document id over all files. Because
the width is fixed, one document or any range of ids is cut out of a block without unpacking the rest, and unpacking is
a few numpy operations. Blocks are written as Parquet rows, so that Spark's commit protocol guards them on any store.

A null text is an empty one and has only its end id. Null ids come first. Rows with equal ids lie next to each other, by
the hash of their texts. An empty table gives no blocks. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantflow.llm import common, vocabularies

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
BLOCK_IDS = 1 << 19
#: Bytes of text encoded at once.
SLICE_BYTES = 4 << 20
BLOCK = "part int, block int, n_ids long, width int, doc_ids array<long>, offsets array<long>, payload binary"


def width_of(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as consecutive little-endian bit fields."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for a in range(0, len(ids), 1 << 16):  # a multiple of 8 ids ends at a byte
        bits = (ids[a : a + (1 << 16), None].astype(np.uint64) >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """count ids from the start-th on; reads only the bytes that hold them."""
    first, last = start * width // 8, -(-(start + count) * width // 8)
    raw = np.frombuffer(payload, dtype=np.uint8)[first:last]
    if width in (8, 16, 32):
        return raw.view(f"<u{width // 8}").astype(np.uint32)
    out = np.empty(count, np.uint32)
    for a in range(0, count, 1 << 16):
        n = min(1 << 16, count - a)
        bit = (start + a) * width - first * 8
        own = np.unpackbits(raw[bit // 8 : -(-(bit + n * width) // 8)], bitorder="little")
        fields = own[bit % 8 : bit % 8 + n * width].reshape(n, width).astype(np.uint32)
        out[a : a + n] = (fields << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    return out


def write(docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int = END_ID, id_col="doc_id", text_col="text") -> None:
    """Encodes every text, ends it with end_id, and writes all in ascending order of id below folder."""
    key = F.xxhash64("text")
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .repartitionByRange("id", key)
        .sortWithinPartitions("id", key)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = vocabularies.numbered_ids_of_worker(vocabularies.from_json, path, end_id)
        width = width_of(max(len(cache.lengths), end_id + 1))
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        found: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(found)
            offsets = np.cumsum([0, *map(len, found)]).tolist()
            row = [part, number, len(flat), width, ids, offsets, pack(flat, width)]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema=types)

        for batch in batches:
            for some in common.slices(batch, "text", SLICE_BYTES):
                for doc_id, own in zip(some.column("id").to_pylist(), cache.of_all(some.column("text")), strict=True):
                    if size and size + len(own) > BLOCK_IDS:
                        yield block()
                        ids, found, size, number = [], [], 0, number + 1
                    ids.append(doc_id)
                    found.append(own)
                    size += len(own)
        if ids:
            yield block()

    names = [f.split()[0] for f in BLOCK.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    types = pa.schema(list(zip(names, kinds, strict=True)))
    ordered.mapInArrow(run, BLOCK).write.parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(folder)


def starts(files: DataFrame) -> DataFrame:
    """part, block, and how many ids lie before the block. Only block sizes are read, one row a part is summed up."""
    sizes = files.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_start"))
    return own.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("block_start"))


def documents(files: DataFrame) -> DataFrame:
    """Per document of the files: id, part, block, place in the block, n_tokens and the CRC of its ids."""
    schema = "doc_id long, part int, block int, place long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, width, ids, offsets, payload = (
                    batch.column(c)[row].as_py() for c in ("part", "block", "width", "doc_ids", "offsets", "payload")
                )
                flat = unpack(payload, width, 0, offsets[-1]).astype("<u4")
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
                counts = np.diff(offsets)
                columns = [ids, [part] * len(ids), [block] * len(ids), offsets[:-1], counts, crc]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    return files.select("part", "block", "width", "doc_ids", "offsets", "payload").mapInArrow(run, schema)


def read_document(row, k: int) -> np.ndarray:
    """Ids of the k-th document of a block row, without unpacking the others."""
    return unpack(row["payload"], row["width"], row["offsets"][k], row["offsets"][k + 1] - row["offsets"][k])


def round_trip(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Writes the files into the shared folder, and tells from them where each document lies."""
    spark = docs.sparkSession
    folder = f"{common.shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write(docs, folder, path, end_id)
    files = blocks(spark, folder)
    found = documents(files).join(starts(files), ["part", "block"])
    return found.select("doc_id", (F.col("block_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
