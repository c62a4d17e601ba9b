"""Stored tables of summaries that merge: counts, sums, first and last.

Every batch adds its own partial rows, in a place named by its label that a repetition overwrites; reading merges rows of
equal keys. So a batch costs what its own rows cost, however much is stored, and late or repeated batches give the same
as one batch of everything. `fold` replaces many small batches by one, without a reader or a writer noticing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow.functions import timecols
from plantflow.sources import labels

PART, BATCH = "part", "batch"
#: The part of rows without a time, and of tables that are not kept by day.
WHOLE = "all"


def day_of(ts: Column) -> Column:
    """UTC day as a part's name."""
    return F.coalesce(F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(timecols.DAY_US)).cast("int")).cast("string"), F.lit(WHOLE))


@dataclass(frozen=True)
class Summaries:
    """A table at `path`. `merges` says for each value how two of them become one: sum, min or max; all other columns are
    keys. `by` names a timestamp among the keys whose day the table is kept by, if any."""

    path: str
    merges: Mapping[str, str]
    by: str | None = None

    def merged(self, rows: DataFrame) -> DataFrame:
        """Rows of equal keys, nulls included, as one."""
        keys = [c for c in rows.columns if c not in self.merges]
        how = {"sum": F.sum, "min": F.min, "max": F.max}
        return rows.groupBy(*keys).agg(*[how[kind](c).alias(c) for c, kind in self.merges.items()])

    def add(self, rows: DataFrame, label: str) -> None:
        """Adds the summaries of a batch; nothing where the batch has been folded already."""
        part = F.lit(WHOLE) if self.by is None else day_of(F.col(self.by))
        placed = self.merged(rows).withColumn(PART, part)
        done = labels.read(rows.sparkSession, self.path).parts_without(label)
        if done:
            placed = placed.filter(~F.col(PART).isin(done))
        self._write(placed, label)

    def _write(self, placed: DataFrame, label: str) -> None:
        (
            placed.withColumn(BATCH, F.lit(label))
            .hint("rebalance", PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PART, BATCH)
            .parquet(self.path)
        )

    def _stored(self, spark: SparkSession, fields: T.StructType) -> DataFrame:
        kept = [T.StructField(PART, T.StringType()), T.StructField(BATCH, T.StringType())]
        return spark.read.schema(T.StructType([*fields.fields, *kept])).parquet(self.path)

    def read(self, spark: SparkSession, fields: T.StructType | str, since: str | None = None, until: str | None = None) -> DataFrame:
        """The merged table, of the days from `since` to `until` (ISO dates, both included) if asked."""
        fields = T._parse_datatype_string(fields) if isinstance(fields, str) else fields
        if not labels._Store(spark, self.path).names():
            return spark.createDataFrame([], fields)
        stored = self._stored(spark, fields)
        stored = stored.filter(labels.read(spark, self.path).counting(F.col(PART), F.col(BATCH)))
        if since is not None:
            stored = stored.filter(F.col(PART) >= since)
        if until is not None:
            stored = stored.filter(F.col(PART) <= until)
        return self.merged(stored.drop(PART, BATCH))

    def _folders(self, store: labels._Store) -> Iterator[tuple[str, str, str]]:
        for status in store.files.globStatus(store.at(f"{PART}=*/{BATCH}=*")) or ():
            folder = status.getPath()
            part, label = folder.getParent().getName(), folder.getName()
            yield part.removeprefix(f"{PART}="), label.removeprefix(f"{BATCH}="), f"{part}/{label}"

    def fold(self, spark: SparkSession, fields: T.StructType | str, least: int = 2) -> list[str]:
        """Replaces the batches of each part that has `least` or more by one; returns the parts. Any step may be its last."""
        fields = T._parse_datatype_string(fields) if isinstance(fields, str) else fields
        seen, known = labels.current(spark, self.path)
        batches: dict[str, set[str]] = {}
        for part, label, _ in self._folders(labels._Store(spark, self.path)):
            if not known.is_replaced(part, label) and (not label.startswith(labels.MERGED) or known.merged.get(part) == label):
                batches.setdefault(part, set()).add(label)
        chosen = {part: own for part, own in batches.items() if len(own) >= max(2, least)}
        if not chosen:
            return []
        label = labels.new_label()
        rows = self._stored(spark, fields).filter(labels.in_batches(F.col(PART), F.col(BATCH), chosen)).drop(BATCH)
        self._write(self.merged(rows), label)
        replaced = known.replaced | {p: sorted({*known.replaced.get(p, ()), *own}) for p, own in chosen.items()}
        labels.publish(spark, self.path, seen, labels.Labels(known.merged | dict.fromkeys(chosen, label), replaced))
        return sorted(chosen)

    def clean(self, spark: SparkSession) -> list[str]:
        """Deletes what folding has replaced; see `labels.clean`."""
        return labels.clean(spark, self.path, self._folders)

