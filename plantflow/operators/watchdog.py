"""Counter-stall watchdog: the line keeps counting while the machine's counter stands still.

A machine sample starts a new epoch. Within an epoch the first line sample that comes later than the timeout, after
enough pieces on the line, raises an anomaly; the machine sample that ends such an epoch clears it. Time is the
samples' own, so replaying history gives what the stream gave. Everything is running values over one order of a
machine's samples: one shuffle on the machine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantflow import schema
from plantflow.functions import values
from plantflow.operators import segments
from plantflow.operators.segments import SegmentPlan
from plantflow.params import WatchdogConfig
from plantflow.sources import eventlog

_KEYS = ["machine_id"]


def _order() -> list[Column]:
    return [F.col("timestamp"), F.col("event_id")]


def _is_machine(cfg: WatchdogConfig) -> Column:
    return F.col("variable") == cfg.machine_counter_name


def _is_line(cfg: WatchdogConfig) -> Column:
    return F.col("variable") == cfg.line_counter_name


def watched(samples: DataFrame, cfg: WatchdogConfig, machine_id: int | None = None) -> DataFrame:
    """The two counters; nothing else touches the watchdog."""
    return eventlog.of_variables(samples, (cfg.machine_counter_name, cfg.line_counter_name), machine_id)


def _in_epochs(rows: DataFrame, cfg: WatchdogConfig, cut: bool) -> DataFrame:
    placed = segments.running(
        rows,
        _KEYS,
        _order(),
        {
            "epoch": segments.total(F.when(_is_machine(cfg), F.lit(1)).otherwise(F.lit(0))),
            "_machine_ts": segments.last(F.when(_is_machine(cfg), F.col("timestamp"))),
            "_started": segments.first(F.col("timestamp")),
            "_line_before": segments.previous(F.when(_is_line(cfg), F.col("value"))),
        },
        cut,
    )
    # Until the first machine sample the watchdog's own start counts, which is the first watched sample.
    delta = values.counter_delta(F.col("value"), F.coalesce(F.col("_line_before"), F.lit(0)))
    return (
        placed.withColumn("last_machine_ts", F.coalesce(F.col("_machine_ts"), F.col("_started")))
        .withColumn("delta", F.when(_is_line(cfg), delta).otherwise(F.lit(0).cast("bigint")))
        .drop("_machine_ts", "_started", "_line_before")
    )


def _with_pieces(rows: DataFrame, cfg: WatchdogConfig, cut: bool) -> DataFrame:
    counted = segments.running(rows, _KEYS, _order(), {"_counted": segments.total(F.col("delta"))}, cut)
    based = segments.running(
        counted, _KEYS, _order(), {"_base": segments.last(F.when(_is_machine(cfg), F.col("_counted")))}, cut
    )
    pieces = F.col("_counted") - F.coalesce(F.col("_base"), F.lit(0).cast("bigint"))
    return based.withColumn("pieces", pieces).drop("_counted", "_base")


def _ready(cfg: WatchdogConfig) -> Column:
    """Line samples later than the timeout."""
    waited = F.unix_micros("timestamp") - F.unix_micros("last_machine_ts")
    return _is_line(cfg) & (waited > F.lit(cfg.timeout_us))


def _with_changes(rows: DataFrame, cfg: WatchdogConfig, cut: bool) -> DataFrame:
    """`change` is 1 where an anomaly is raised, 0 where it is cleared, else null."""
    if cut:
        return _marked(_due_in_segments(_in_epochs(rows, cfg, cut), cfg), cfg)
    due = _with_pieces(_in_epochs(rows, cfg, cut), cfg, cut).withColumn(
        "_due", _ready(cfg) & (F.col("pieces") >= F.lit(cfg.min_pieces))
    )
    last_due = {"_due_epoch": segments.previous(F.when(F.col("_due"), F.col("epoch")))}
    return _marked(segments.running(due, _KEYS, _order(), last_due, cut), cfg)


def _marked(rows: DataFrame, cfg: WatchdogConfig) -> DataFrame:
    opening = F.col("_due_epoch").isNull() | (F.col("_due_epoch") < F.col("epoch"))
    change = F.when(F.col("_due") & opening, F.lit(1)).when(
        _is_machine(cfg) & (F.col("_due_epoch") == F.col("epoch") - 1), F.lit(0)
    )
    return rows.withColumn("change", change).drop("_due", "_due_epoch")


def _due_in_segments(rows: DataFrame, cfg: WatchdogConfig) -> DataFrame:
    """Pieces, whether an anomaly is due, and the last epoch it was due in before, for hot machines.

    A segment hands on three things: how many pieces its first and its last epoch add, the highest count its first
    epoch reaches among samples past the timeout, and the last of its other epochs in which an anomaly was due. From
    these the pieces a segment begins with and the epochs due before it follow without looking at rows again.
    """
    seg = segments.SEGMENT
    parts = ["machine_id", seg]
    ordered = Window.partitionBy(*parts).orderBy(*_order())
    in_epoch = Window.partitionBy(*parts, "epoch").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0)
    local = (
        rows.withColumn("_first", F.min("epoch").over(Window.partitionBy(*parts)))
        .withColumn("_own", F.sum("delta").over(in_epoch))
    )
    enough = F.lit(cfg.min_pieces)

    epochs_of = local.groupBy(*parts, "_first", "epoch").agg(
        F.sum("delta").alias("_sum"), F.max(F.when(_ready(cfg), F.col("_own"))).alias("_peak")
    )
    is_first = F.col("epoch") == F.col("_first")
    handed_on = epochs_of.groupBy(*parts).agg(
        F.min("epoch").alias("_first"),
        F.max("epoch").alias("_last"),
        F.max(F.when(is_first, F.col("_sum"))).alias("_first_sum"),
        F.max(F.when(is_first, F.col("_peak"))).alias("_first_peak"),
        F.max_by("_sum", "epoch").alias("_last_sum"),
        F.max(F.when(~is_first & (F.col("_peak") >= enough), F.col("epoch"))).alias("_later_due"),
    )
    # An epoch that crosses segments is the last of one and the first of the next ones.
    ends = F.array(
        F.struct(F.col("_first").alias("epoch"), F.col("_first_sum").alias("_sum"), F.lit(True).alias("_opens")),
        F.struct(F.col("_last").alias("epoch"), F.col("_last_sum").alias("_sum"), F.lit(False).alias("_opens")),
    )
    edges = handed_on.select(*parts, "_first", "_first_peak", "_later_due", F.inline(ends)).filter(
        F.col("_opens") | (F.col("epoch") > F.col("_first"))
    )
    same_epoch = Window.partitionBy("machine_id", "epoch").orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    opened = edges.withColumn("_pieces_in", F.coalesce(F.sum("_sum").over(same_epoch), F.lit(0).cast("bigint"))).filter(
        F.col("_opens")
    )
    first_due = F.when(F.col("_pieces_in") + F.col("_first_peak") >= enough, F.col("_first"))
    earlier = Window.partitionBy("machine_id").orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    inherited = opened.withColumn(
        "_due_in", F.max(F.greatest(F.col("_later_due"), first_due)).over(earlier)
    ).select(*parts, "_pieces_in", "_due_in")

    begun = F.when(F.col("epoch") == F.col("_first"), F.col("_pieces_in")).otherwise(F.lit(0).cast("bigint"))
    judged = (
        segments.join_null_safe(local, inherited, parts)
        .withColumn("pieces", F.col("_own") + begun)
        .withColumn("_due", _ready(cfg) & (F.col("pieces") >= enough))
    )
    due_here = F.last(F.when(F.col("_due"), F.col("epoch")), ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, -1)
    )
    return judged.withColumn("_due_epoch", F.coalesce(due_here, F.col("_due_in"))).drop(
        "_first", "_own", "_pieces_in", "_due_in"
    )


def _by_heat(
    samples: DataFrame,
    cfg: WatchdogConfig,
    machine_id: int | None,
    plan: SegmentPlan | None,
    build: Callable[[DataFrame, WatchdogConfig, bool], DataFrame],
) -> DataFrame:
    rows = watched(samples, cfg, machine_id)
    return segments.by_heat(rows, _KEYS, _order(), plan, lambda part, cut: build(part, cfg, cut))


def epochs(
    samples: DataFrame, cfg: WatchdogConfig, machine_id: int | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """Watched samples with the number of machine samples so far, the last machine time and the line's advance."""
    return _by_heat(samples, cfg, machine_id, plan, _in_epochs)


def line_pieces(
    samples: DataFrame, cfg: WatchdogConfig, machine_id: int | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """Line samples with the pieces counted since the last machine sample."""
    counted = _by_heat(
        samples, cfg, machine_id, plan, lambda rows, cfg, cut: _with_pieces(_in_epochs(rows, cfg, cut), cfg, cut)
    )
    return counted.filter(_is_line(cfg))


def changes(
    samples: DataFrame, cfg: WatchdogConfig, machine_id: int | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """Samples at which the anomaly state of their machine changes."""

    return _by_heat(samples, cfg, machine_id, plan, _with_changes).filter(F.col("change").isNotNull())


def raised(
    samples: DataFrame, cfg: WatchdogConfig, machine_id: int | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """Samples that raise an anomaly, with the pieces and the last machine time that made it due."""
    return changes(samples, cfg, machine_id, plan).filter(F.col("change") == 1)


def batch(
    samples: DataFrame, cfg: WatchdogConfig, machine_id: int | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """Derived anomaly events; each takes time and number of the sample that caused it."""
    return as_events(changes(samples, cfg, machine_id, plan))


def as_events(changed: DataFrame) -> DataFrame:
    return changed.select(
        "event_id",
        "timestamp",
        "machine_id",
        F.lit(schema.MACHINE_ANOMALY).alias("variable"),
        F.lit("Boolean").alias("type"),
        F.col("change").cast("int").alias("value"),
        F.lit(schema.DERIVED).alias("event_type"),
    )


def merged(raw: DataFrame, derived: DataFrame) -> DataFrame:
    """One log of raw and derived events."""
    columns = list(schema.MODEL_COLUMNS)
    return raw.select(*columns).unionByName(derived.select(*columns))


_SAME = ["machine_id", "event_id", "timestamp", "value"]


def corrections(
    samples: DataFrame, derived: DataFrame, cfg: WatchdogConfig, machines: DataFrame | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """What late samples change: derived events to retract (`retracted`) and to add, so that `derived` becomes what all
    samples give.

    A stream takes samples in the order they come and can't take back what it derived meanwhile. `machines` (machine_id)
    limits the work to those that had late samples; the events of all others stand. Empty if nothing was late.
    """
    if machines is not None:
        touched = machines.select("machine_id").distinct()
        samples, derived = (df.join(touched, "machine_id", "left_semi") for df in (samples, derived))
    wanted = batch(samples, cfg, plan=plan)
    columns = list(schema.MODEL_COLUMNS)
    added = wanted.join(derived, _SAME, "left_anti").select(*columns, F.lit(False).alias("retracted"))
    gone = derived.join(wanted, _SAME, "left_anti").select(*columns, F.lit(True).alias("retracted"))
    return added.unionByName(gone)


def corrected(derived: DataFrame, changes_: DataFrame) -> DataFrame:
    """The derived events with corrections applied. Corrections that are applied twice change nothing more."""
    columns = list(schema.MODEL_COLUMNS)
    kept = derived.select(*columns).join(changes_.select(*_SAME), _SAME, "left_anti")
    return kept.unionByName(changes_.filter(~F.col("retracted")).select(*columns))
