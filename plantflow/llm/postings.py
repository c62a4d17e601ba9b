"""Inverted postings over blocks of documents: compressed bitmaps, their union and size, and sums carried back.

A block holds at most BLOCK documents that one task has seen one after the other; a document is known by its block and
its row there. A bitmap is kept as a sorted list of rows (two bytes each) or, where that is smaller, as one bit a row.
Whatever is gathered for a key is gathered for one block, so that a key of all documents is no larger than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Documents of a block; a power of two.
BLOCK = 1 << 13
DENSE_BYTES = BLOCK // 8


def binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow array of byte strings that take `counts` items each of data, one after the other."""
    offsets = np.concatenate([[0], np.cumsum(counts * data.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def numbers(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of an Arrow array of byte strings, how many of them each string has); a null has none."""
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    size = np.dtype(dtype).itemsize
    if data is None or not len(column):
        return np.zeros(0, dtype), np.zeros(len(column), np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]].view(dtype)
    return flat, np.diff(offsets).astype(np.int64) // size


def packed(rows: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Bitmaps of sorted rows, `counts` of them each. Their length tells the two forms apart."""
    wide = counts * 2 >= DENSE_BYTES
    if not wide.any():
        return binaries(rows.astype("<u2"), counts)
    ends = np.cumsum(counts)
    narrow = rows[~np.repeat(wide, counts)].astype("<u2")
    dense = {int(k): np.packbits(np.bincount(rows[ends[k] - counts[k] : ends[k]], minlength=BLOCK).astype(bool), bitorder="little") for k in np.flatnonzero(wide)}
    sizes = np.where(wide, DENSE_BYTES, counts * 2)
    out, at = np.empty(int(sizes.sum()), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
    out[np.repeat(~wide, sizes)] = narrow.view(np.uint8)
    for k, bits in dense.items():
        out[at[k] : at[k + 1]] = bits
    return binaries(out, sizes)


def unpacked(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows of all bitmaps, how many each has)."""
    flat, sizes = numbers(bitmaps, "u1")
    wide = sizes == DENSE_BYTES
    counts = np.where(wide, 0, sizes // 2)
    if not wide.any():
        return flat.view("<u2").astype(np.int64), counts
    at = np.concatenate([[0], np.cumsum(sizes)])
    dense = {int(k): np.flatnonzero(np.unpackbits(flat[at[k] : at[k + 1]], bitorder="little")) for k in np.flatnonzero(wide)}
    for k, own in dense.items():
        counts[k] = len(own)
    out = np.empty(int(counts.sum()), np.int64)
    out[np.repeat(~wide, counts)] = flat[np.repeat(~wide, sizes)].view("<u2")
    to = np.concatenate([[0], np.cumsum(counts)])
    for k, own in dense.items():
        out[to[k] : to[k + 1]] = own
    return out, counts


def sizes(bitmaps: pa.Array) -> np.ndarray:
    """How many rows each bitmap has."""
    flat, lengths = numbers(bitmaps, "u1")
    found, ends = lengths // 2, np.cumsum(lengths)
    for k in np.flatnonzero(lengths == DENSE_BYTES).tolist():
        found[k] = np.bitwise_count(flat[ends[k] - DENSE_BYTES : ends[k]]).sum()
    return found


def union(lists: pa.ListArray) -> pa.Array:
    """Of each list of bitmaps (never empty), the bitmap of the rows that any has; those alone in their list stand as they are."""
    counts = np.diff(lists.offsets.to_numpy())
    several = counts > 1
    alone = lists.filter(pa.array(~several)).flatten()
    if not several.any():
        return alone
    rows, of = unpacked(lists.filter(pa.array(several)).flatten())
    owner = np.repeat(np.repeat(np.arange(several.sum()), counts[several]), of)
    both = np.unique(owner * BLOCK + rows)
    united = packed(both % BLOCK, np.bincount(both // BLOCK, minlength=int(several.sum())))
    place = np.empty(len(counts), np.int64)
    place[~several], place[several] = np.arange(len(alone)), len(alone) + np.arange(len(united))
    return pa.concat_arrays([alone, united]).take(pa.array(place))


class Sums:
    """Per block, sums over its rows of values that come with bitmaps."""

    def __init__(self, n: int, dtype: type = np.float64):
        self.n, self.dtype = n, dtype
        self.of: dict[int, np.ndarray] = {}

    def add(self, blocks: np.ndarray, rows: np.ndarray, values: list[np.ndarray]) -> None:
        order = np.argsort(blocks, kind="stable")
        ordered = blocks[order]
        cuts = np.flatnonzero(np.diff(ordered)) + 1
        for own in np.split(order, cuts) if len(order) else ():
            found = self.of.setdefault(int(blocks[own[0]]), np.zeros((self.n, BLOCK), self.dtype))
            for k, value in enumerate(values):
                np.add.at(found[k], rows[own], value[own])

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        """block, row and the sums, of rows with any."""
        for block, found in self.of.items():
            rows = np.flatnonzero(found.any(axis=0))
            arrays = [pa.array(np.full(len(rows), block, np.int64)), pa.array(rows.astype(np.int32)), *(pa.array(x[rows]) for x in found)]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "row", *names])
