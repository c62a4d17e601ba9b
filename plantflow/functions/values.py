"""Expressions over sample values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(text: Column) -> Column:
    """Device value as an integer: booleans become 0 or 1, fractions are cut towards zero, anything else is null."""
    plain = F.lower(F.trim(text))
    # The cast alone would also take a type letter, as in "12d", and names such as "infinity".
    number = F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"), plain).try_cast("double")
    return (
        F.when(plain == "true", F.lit(1))
        .when(plain == "false", F.lit(0))
        .otherwise(number.try_cast("int"))
    )


def counter_delta(value: Column, previous: Column, first: str = "zero") -> Column:
    """Advance of a counter that may restart from zero.

    A reading below the one before means a restart, so all of it counts. `first` says what a reading without
    a predecessor contributes: "zero" takes it as a baseline, "value" counts it whole.
    """
    if first not in ("zero", "value"):
        raise ValueError("first must be 'zero' or 'value'")
    opening = F.lit(0).cast("bigint") if first == "zero" else value.cast("bigint")
    wide = value.cast("bigint")
    return (
        F.when(previous.isNull(), opening)
        .when(value < previous, wide)
        .otherwise(wide - previous.cast("bigint"))
    )


def percentage(part: Column, whole: Column) -> Column:
    """part * 100 / whole as a double; 0 where there is no whole."""
    return F.coalesce(
        part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0)
    )
