"""Reading slices of the event log so that storage can skip the rest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow.params import TimeRange

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
EVENT_DATE = "event_date"


def date_of(micros: int) -> date:
    """UTC date."""
    return (_EPOCH + timedelta(microseconds=micros)).date()


def _date(micros: int) -> Column:
    return F.lit(date_of(micros))


def of_variables(events: DataFrame, variables: Iterable[str], machine_id: int | None = None) -> DataFrame:
    """Rows of some variables, of one machine or of all.

    Written as equalities: where the variable is computed from other columns, the optimizer turns these into conditions
    on them and leaves out inputs that cannot hold any of the variables.
    """
    picked = events.filter(reduce(or_, [F.col("variable") == name for name in variables]))
    return picked if machine_id is None else picked.filter(F.col("machine_id") == machine_id)


def during(events: DataFrame, within: TimeRange) -> DataFrame:
    """Rows of the range; on a table kept by date the other dates are not opened."""
    picked = events.filter((F.col("timestamp") >= within.start) & (F.col("timestamp") < within.end))
    if EVENT_DATE in events.columns:
        picked = picked.filter(F.col(EVENT_DATE).between(_date(within.start_us), _date(within.end_us - 1)))
    return picked


def before(events: DataFrame, within: TimeRange) -> DataFrame:
    """Rows ahead of the range."""
    picked = events.filter(F.col("timestamp") < within.start)
    if EVENT_DATE in events.columns:
        picked = picked.filter(F.col(EVENT_DATE) <= _date(within.start_us - 1))
    return picked


def relevant_changes(changes: DataFrame, keys: Sequence[str], within: TimeRange) -> DataFrame:
    """The changes of the range and, per key, the last one ahead of it: keys, timestamp, event_id and value.

    Of all the history ahead of the range only the state it leaves behind matters. It is condensed to one row per key
    before anything is shuffled. On the bare table all earlier dates of these variables are read for it; on events from
    `snapshots.StateSnapshots.events` only those since the last snapshot.
    """
    slim = changes.select(*keys, "timestamp", "event_id", "value", *[c for c in changes.columns if c == EVENT_DATE])
    latest = F.max(F.struct("timestamp", "event_id", "value"))
    opening = before(slim, within).groupBy(*keys).agg(latest.alias("_row")).select(*keys, "_row.*")
    return during(slim, within).drop(EVENT_DATE).unionByName(opening)
