"""The reports as SQL views of one session.

    views.register(events, TimeRange.of("2024-01-05", "2024-01-25"))
    spark.sql("SELECT total_pieces_counted FROM pieces_total WHERE machine_id = :machine_id", args={"machine_id": 7})

A condition on `machine_id` reaches the scan. A machine that never reported has no row here; the functions in `kpis`
give it one with zeros when asked for it by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange
from plantflow.plans import kpis, states

FIGURES = (
    kpis.pieces_total,
    kpis.rejected_total,
    kpis.rejected_percentage,
    kpis.anomaly_starts,
    kpis.anomaly_seconds,
    kpis.kpi_summary,
)
STATES = (states.state_intervals, states.state_timeline, states.state_time_share)


def register(
    events: DataFrame, within: TimeRange, machines: DataFrame | None = None, plan: SegmentPlan | None = None
) -> list[str]:
    """Create or replace `machine_events` and one view per report over the range; returns their names."""
    events.createOrReplaceTempView("machine_events")
    for report in FIGURES:
        report(events, within, machines=machines, plan=plan).createOrReplaceTempView(report.__name__)
    for report in STATES:
        report(events, within, plan=plan).createOrReplaceTempView(report.__name__)
    return ["machine_events", *[r.__name__ for r in FIGURES + STATES]]
