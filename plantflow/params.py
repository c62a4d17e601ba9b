"""Query parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def to_micros(moment: datetime | str) -> int:
    """Microseconds since the epoch; a value without a zone is taken as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return (moment - _EPOCH) // timedelta(microseconds=1)


def instant(micros: int) -> Column:
    """A timestamp literal that does not depend on any time zone setting."""
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


@dataclass(frozen=True)
class TimeRange:
    """The selected range of a report: start inclusive, end exclusive."""

    start_us: int
    end_us: int

    def __post_init__(self) -> None:
        if self.end_us < self.start_us:
            raise ValueError("a time range must not end before it starts")

    @classmethod
    def of(cls, start: datetime | str, end: datetime | str) -> TimeRange:
        return cls(to_micros(start), to_micros(end))

    @property
    def start(self) -> Column:
        return instant(self.start_us)

    @property
    def end(self) -> Column:
        return instant(self.end_us)

    @property
    def length_us(self) -> int:
        return self.end_us - self.start_us


@dataclass(frozen=True)
class WatchdogConfig:
    """When a stalled machine counter on a running line counts as an anomaly."""

    timeout_seconds: float = 20.0
    min_pieces: int = 1
    line_counter_name: str = "LinePieceCounter"
    machine_counter_name: str = "MachinePieceCounter"

    @property
    def timeout_us(self) -> int:
        return round(self.timeout_seconds * 1_000_000)
