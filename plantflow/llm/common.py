"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow.sources import shared

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words when only white space does, and when all ASCII but digits and letters does.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = r"[\x09-\x0D\x20]+"
SEPARATOR_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a new one of this machine, with a local
    master only (tests)."""
    folder = shared.folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read from the shared folder from then on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark's own switch: what an execution shuffled is removed from the executors' disks when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """The same rows, written to path and read from there; the files that were shuffled for them are gone afterwards, not
    only when the driver happens to collect its garbage. For large frames that are executed this once."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z and nothing else. For pure ASCII, told by its length in bytes, that is lower()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once a row however often the body names it."""
    return F.transform(F.array(value), body)[0]


#: Bytes of text handled at once by a Python worker; a longer text is handled alone.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with a bounded number of bytes in the column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    groups = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def spaceless(array: pa.Array) -> list:
    """Strings or byte strings, of which none has a space, as Python's: far quicker than one by one."""
    if not len(array):
        return []
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array), pa.scalar(" ", array.type))[0].as_py()
    return whole.split(" " if isinstance(whole, str) else b" ")


def with_computed(
    df: DataFrame, keep: list[str], column: str, added: list[T.StructField], start: Callable[[], Callable[[list], list]]
) -> DataFrame:
    """keep, and the columns that the function start() returns makes from runs of the column's values, as Arrow arrays.

    start() runs once a task, so that tables are opened there. Nulls reach the function as None.
    """
    needed = list(dict.fromkeys([*keep, column]))
    frame = df.select(*(F.col(f"`{c}`") for c in needed))
    schema = T.StructType([*(f for f in frame.schema.fields if f.name in keep), *added])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for part in slices(batch, column):
                arrays = compute(part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *arrays], names=names)

    return frame.mapInArrow(run, schema)


#: Rows of a side that may be broadcast; its rows are a few numbers each.
BROADCAST_ROWS = 500_000


def join_counted(large: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """large joined with small, a frame already cut: broadcast if its counted rows are few, else as Spark sees fit."""
    return large.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on, how)
