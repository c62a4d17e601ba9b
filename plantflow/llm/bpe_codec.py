"""Byte-level BPE encoding and decoding over Arrow batches.

`encode` gives the ids that the rank file's own library gives, through the tokenizers library: the ranks become its
merge list (vocabularies.from_ranks) and each match of the pattern is a pre-token. Character offsets come from token
lengths and a byte-to-character map. `decode` reverses the byte table; a character split over tokens is whole again once
its bytes are joined, and `decode_stream` gives text token by token, holding back the bytes of an unfinished one.

A null text is an empty one and has no ids; null ids decode to null. Rows are handled one by one: repeated rows get the
same ids, an empty table gives no rows, a very long text is encoded piece by piece. Only the named columns are kept.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plantflow.llm import common, vocabularies

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
_INTS = T.ArrayType(T.IntegerType(), containsNull=False)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(v) for v in values)]).astype(np.int32)
    flat = np.concatenate([*values, np.empty(0, np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def char_offsets(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token, and the one after its last; a character split over tokens belongs to each."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    if not len(lengths):
        return np.empty(0, np.int32), np.empty(0, np.int32)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return char_of[ends - lengths].astype(np.int32), (char_of[ends - 1] + 1).astype(np.int32)


def encode(
    docs: DataFrame, path: str = RANKS, text_col: str = "text", keep: list[str] | None = None, offsets: bool = False
) -> DataFrame:
    """keep (default: all columns), ids, and with offsets also starts and ends in characters, all array<int>."""
    added = ["ids", *(["starts", "ends"] if offsets else [])]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]

    def start():
        tokenizer = vocabularies.from_ranks(path)
        cache = vocabularies.IdCache(tokenizer)

        def compute(texts: list) -> list:
            ids = [cache.ids(t or "") for t in texts]
            if not offsets:
                return [_lists(ids)]
            spans = [char_offsets(t or "", cache.lengths[i]) for t, i in zip(texts, ids, strict=True)]
            return [_lists(ids), _lists([s[0] for s in spans]), _lists([s[1] for s in spans])]

        return compute

    return common.with_computed(docs, keep, text_col, [T.StructField(c, _INTS) for c in added], start)


def decode_bytes(ids: Iterable[int], table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids])


def decode_stream(ids: Iterable[int], table: list[bytes]) -> Iterator[str]:
    """The text each id completes; bytes that can't become a character are shown as U+FFFD."""
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for i in ids:
        yield decoder.decode(table[i])
    if rest := decoder.decode(b"", final=True):
        yield rest


def decode(encoded: DataFrame, path: str = RANKS, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns) and decoded, the bytes that the ids stand for."""
    keep = [c for c in (encoded.columns if keep is None else keep) if c != "decoded"]
    needed = list(dict.fromkeys([*keep, ids_col]))
    frame = encoded.select(*(encoded[f"`{c}`"] for c in needed))
    schema = T.StructType([*(f for f in frame.schema.fields if f.name in keep), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabularies.token_bytes(vocabularies.from_ranks(path))
        for batch in batches:
            lists = batch.column(ids_col)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            there = lists.is_valid().to_pylist()
            for a in range(0, batch.num_rows, 256):
                rows = range(a, min(a + 256, batch.num_rows))
                raw = [decode_bytes(flat[ends[k] : ends[k + 1]].tolist(), table) if there[k] else None for k in rows]
                part = batch.slice(a, len(rows))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(raw, pa.binary())], names=schema.names)

    return frame.mapInArrow(run, schema)
