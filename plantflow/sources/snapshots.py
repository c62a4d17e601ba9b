"""State of every machine at the end of a day, and the machines there are, so that no report reads history.

`StateSnapshots` keeps, for each day that has been sealed, the last change of every state variable of every machine up to
the day's end. A batch of events that comes later adds the changes it has for sealed days; reading takes the last of all
rows of a key, so the order in which batches come, and batches that come twice, don't matter.

    snapshots = StateSnapshots("/data/states")
    eventtable.append(events, table, label); snapshots.correct(events, label)      # every batch, late ones included
    snapshots.seal(spark, eventtable.read(spark, table), "2024-01-19")             # once a day
    kpis.kpi_summary(snapshots.events(eventtable.read(spark, table), within), within, machines=register.read(spark))

`Register` keeps the first and last sight of every machine, merged from batches in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantflow import schema
from plantflow.params import TimeRange
from plantflow.sources import eventlog, eventtable, labels
from plantflow.sources.summaries import Summaries

STATES = (schema.DATA_VALID, schema.MACHINE_ANOMALY, *schema.MACHINE_STATES)
FIELDS = "machine_id int, variable string, latest struct<timestamp:timestamp,event_id:bigint,value:int,type:string,event_type:string>"
_OPENED, _SEALED = "_opened", "_sealed"


def _day(text: str) -> date:
    return date.fromisoformat(text)


def _latest(rows: DataFrame) -> DataFrame:
    """The last change of each machine and variable. Rows without a machine, variable or time belong to no state."""
    known = rows.filter("machine_id IS NOT NULL AND timestamp IS NOT NULL").filter(F.col("variable").isin(*STATES))
    return known.groupBy("machine_id", "variable").agg(F.max(F.struct("timestamp", "event_id", "value", "type", "event_type")).alias("latest"))


@dataclass(frozen=True)
class StateSnapshots:
    """Snapshots below `path`, a folder for each sealed day."""

    path: str

    def _table(self, day: str) -> Summaries:
        return Summaries(f"{self.path.rstrip('/')}/{day}", {"latest": "max"})

    def _days(self, spark: SparkSession, mark: str) -> list[str]:
        """Days with the mark: opened ones get corrections, sealed ones may be read."""
        store = labels._Store(spark, self.path)
        return [day for day in store.names() if store.files.exists(store.at(f"{day}/{mark}"))]

    def _mark(self, spark: SparkSession, day: str, mark: str) -> None:
        store = labels._Store(spark, self.path)
        if not store.files.exists(store.at(f"{day}/{mark}")):
            store.write(f"{day}/{mark}", "")

    def sealed(self, spark: SparkSession) -> list[str]:
        return self._days(spark, _SEALED)

    def seal(self, spark: SparkSession, stored: DataFrame, day: str) -> None:
        """Makes the snapshot of the end of an ISO date, from the snapshot before it and the dates since.

        First the day is opened: batches that come from now on correct it. Those that came before are in the table, which is
        read only then. It may end after any step and be run again."""
        self._mark(spark, day, _OPENED)
        earlier = [d for d in self.sealed(spark) if d < day]
        changes = stored.filter(F.col("event_date") <= F.lit(_day(day)))
        if earlier:
            changes = changes.filter(F.col("event_date") > F.lit(_day(earlier[-1])))
        rows = _latest(changes)
        if earlier:
            rows = rows.unionByName(self._table(earlier[-1]).read(spark, FIELDS))
        self._table(day).add(rows, "sealed")
        self._mark(spark, day, _SEALED)

    def correct(self, events: DataFrame, label: str) -> list[str]:
        """Adds a batch's changes to the days opened already that they precede; returns these days. Call it after the batch
        has been appended to the table. A batch without late changes costs one look at its first state change."""
        spark = events.sparkSession
        opened = self._days(spark, _OPENED)
        if not opened:
            return []
        first = eventtable.with_date(events.filter(F.col("variable").isin(*STATES))).agg(F.min("event_date")).first()[0]
        touched = [] if first is None else [d for d in opened if _day(d) >= first]
        for day in touched:
            until = eventtable.with_date(events).filter(F.col("event_date") <= F.lit(_day(day)))
            self._table(day).add(_latest(until), label)
        return touched

    def events(self, stored: DataFrame, within: TimeRange) -> DataFrame:
        """Events for any report over the range: those since the last day sealed before it, and of what was before, the last
        change of each state. Earlier dates of the table are not opened; without a sealed day before the range all are."""
        spark = stored.sparkSession
        start = eventlog.date_of(within.start_us)
        usable = [d for d in self.sealed(spark) if _day(d) < start]
        if not usable:
            return stored
        opening = self._table(usable[-1]).read(spark, FIELDS).select("machine_id", "variable", "latest.*")
        dated = eventtable.with_date(opening)
        missing = {c: F.lit(None).cast(stored.schema[c].dataType) for c in stored.columns if c not in dated.columns}
        since = stored.filter(F.col("event_date") > F.lit(_day(usable[-1])))
        return since.unionByName(dated.withColumns(missing).select(*stored.columns))

    def drop_before(self, spark: SparkSession, day: str) -> list[str]:
        """Deletes the snapshots of earlier days."""
        store = labels._Store(spark, self.path)
        gone = [d for d in self._days(spark, _OPENED) if d < day]
        for d in gone:
            store.delete(d)
        return gone


REGISTER = "machine_id int, first_seen timestamp, last_seen timestamp"


@dataclass(frozen=True)
class Register:
    """Machines and when they were first and last heard of."""

    path: str

    @property
    def _table(self) -> Summaries:
        return Summaries(self.path, {"first_seen": "min", "last_seen": "max"})

    def add(self, events: DataFrame, label: str) -> None:
        """A batch's machines; rows without a machine or a time are nobody's."""
        seen = events.filter("machine_id IS NOT NULL AND timestamp IS NOT NULL")
        self._table.add(sightings(seen), label)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._table.read(spark, REGISTER)

    def fold(self, spark: SparkSession) -> list[str]:
        return self._table.fold(spark, REGISTER)

    def clean(self, spark: SparkSession) -> list[str]:
        return self._table.clean(spark)


def sightings(events: DataFrame) -> DataFrame:
    return events.groupBy("machine_id").agg(F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))


def known_until(register: DataFrame, until: Column) -> DataFrame:
    """Machines first heard of before an instant: those a report of that time should have a row for."""
    return register.filter(F.col("first_seen") < until)

