"""The counter-stall watchdog on a stream.

Four numbers per machine are kept between micro-batches. A micro-batch is sorted by time and number per machine and
handled as arrays; a sample older than what was handled before is taken in the order of arrival, as a gateway would.
The rows of a machine in one micro-batch must fit a task, which the source's micro-batch size sees to.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plantflow.operators import watchdog as rules
from plantflow.params import WatchdogConfig

_CHANGES = "event_id long, ts_us long, machine_id int, change int"
_STATE = "machine_us long, line_count long, pieces long, anomaly boolean"


class WatchdogState(NamedTuple):
    machine_us: int
    line_count: int = 0
    pieces: int = 0
    anomaly: bool = False


def advance(
    state: WatchdogState | None, ts_us: np.ndarray, is_machine: np.ndarray, value: np.ndarray, cfg: WatchdogConfig
) -> tuple[WatchdogState, np.ndarray]:
    """Handle ordered samples of one machine; returns the new state and, per sample, 1, 0 or -1 for no change."""
    if state is None:
        state = WatchdogState(machine_us=int(ts_us[0]))
    is_line = ~is_machine
    epoch = np.cumsum(is_machine)

    delta = np.zeros(len(value), dtype=np.int64)
    line_values = value[is_line]
    if len(line_values):
        before = np.concatenate(([state.line_count], line_values[:-1]))
        delta[is_line] = np.where(line_values < before, line_values, line_values - before)

    # What every epoch starts from; epoch 0 goes on from the state.
    counted = np.cumsum(delta)
    base = np.concatenate(([-state.pieces], counted[is_machine]))
    since = np.concatenate(([state.machine_us], ts_us[is_machine]))
    pieces = counted - base[epoch]
    due = is_line & (ts_us - since[epoch] > cfg.timeout_us) & (pieces >= cfg.min_pieces)

    anomalous = np.zeros(len(base), dtype=bool)
    anomalous[epoch[due]] = True
    anomalous[0] |= state.anomaly

    change = np.full(len(value), -1, dtype=np.int32)
    at = np.flatnonzero(due)
    raised, first = np.unique(epoch[at], return_index=True)
    first = first[~((raised == 0) & state.anomaly)]
    change[at[first]] = 1
    ends = np.flatnonzero(is_machine)
    change[ends[anomalous[:-1]]] = 0

    return (
        WatchdogState(
            machine_us=int(since[-1]),
            line_count=int(line_values[-1]) if len(line_values) else state.line_count,
            pieces=int(pieces[-1]),
            anomaly=bool(anomalous[-1]),
        ),
        change,
    )


def stream(samples: DataFrame, cfg: WatchdogConfig) -> DataFrame:
    """Derived anomaly events of a stream of samples."""

    def handle(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts_us", "event_id"], kind="stable")
        state = WatchdogState(*group.get) if group.exists else None
        state, change = advance(
            state,
            rows["ts_us"].to_numpy(np.int64),
            rows["is_machine"].to_numpy(bool),
            rows["value"].to_numpy(np.int64),
            cfg,
        )
        group.update(tuple(state))
        changed = change >= 0
        yield pd.DataFrame(
            {
                "event_id": rows["event_id"].to_numpy()[changed],
                "ts_us": rows["ts_us"].to_numpy()[changed],
                "machine_id": np.full(changed.sum(), key[0], dtype=np.int32),
                "change": change[changed],
            }
        )

    watched = rules.watched(samples, cfg).select(
        "machine_id",
        "event_id",
        F.unix_micros("timestamp").alias("ts_us"),
        (F.col("variable") == cfg.machine_counter_name).alias("is_machine"),
        F.col("value").cast("long").alias("value"),
    )
    changed = watched.groupBy("machine_id").applyInPandasWithState(
        handle, _CHANGES, _STATE, "append", GroupStateTimeout.NoTimeout
    )
    return rules.as_events(changed.withColumn("timestamp", F.timestamp_micros("ts_us")))
