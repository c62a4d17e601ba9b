"""plantflow: industrial-telemetry analytics as Spark DataFrame jobs."""

from plantflow.params import TimeRange, WatchdogConfig

__all__ = ["TimeRange", "WatchdogConfig"]
