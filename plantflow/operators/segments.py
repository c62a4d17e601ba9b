"""Running values along ordered keys, with hot keys cut into segments.

Most operators here follow one machine (or one order) through time: the last known state, the reading before, a
running total. As plain windows they need one shuffle on the key and no join, but then one task sees the whole history
of one key. A key that holds a large part of all rows is therefore cut along time: windows run per (key, segment), one
small summary row per segment is carried across the segments of the key, and every row takes over what its segment
inherited. Both forms give the same rows; which keys are cut is decided by `measure`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Segment widths to choose from, widest first: day, hour, minute, second, and on to a microsecond, the finest time.
WIDTHS_US = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 10_000, 100, 1)
MAX_HOT_KEYS = 1000
# Neighbouring segments whose summaries are carried on as one.
SEGMENTS_OF_STRETCH = 4096


@dataclass(frozen=True)
class SegmentPlan:
    """Hot keys and the width of their segments. A plan changes how the work is spread, never its result."""

    key: str
    ts: str
    cuts: tuple[tuple[int, tuple[int, ...]], ...] = ()
    # Width for all other keys; None leaves them whole.
    others: int | None = None

    @property
    def hot_keys(self) -> tuple[int, ...]:
        return tuple(key for _, keys in self.cuts for key in keys)

    @property
    def cuts_any(self) -> bool:
        return bool(self.cuts) or self.others is not None

    def is_hot(self) -> Column:
        if self.others is not None:
            return F.lit(True)
        return F.coalesce(F.col(self.key).isin(*self.hot_keys), F.lit(False))

    def segment(self) -> Column:
        """Number of the segment a row of a hot key falls into; rises with time."""
        micros = F.unix_micros(F.col(self.ts))

        def cut(width: int) -> Column:
            return ((micros - F.pmod(micros, F.lit(width))) / F.lit(width)).cast("bigint")

        number = F.lit(None).cast("bigint") if self.others is None else cut(self.others)
        for width, keys in self.cuts:
            number = F.when(F.col(self.key).isin(*keys), cut(width)).otherwise(number)
        return number


def measure(
    df: DataFrame, key: str, ts: str, max_rows: int = 4_000_000, widths: Sequence[int] = WIDTHS_US
) -> SegmentPlan:
    """Find the keys with more than `max_rows` rows and the widest segment that keeps their parts below it.

    Counting by key reads one column and is combined before the shuffle; the driver receives at most a few values for
    each of MAX_HOT_KEYS keys. Where more keys than that are large, all keys are cut alike and none is listed. Call it
    once per table, as one would ANALYZE TABLE, and pass the plan on; a stale plan costs time, not correctness.
    """
    large = df.groupBy(key).count().filter(F.col("count") > max_rows).select(key)
    hot = [row[0] for row in large.limit(MAX_HOT_KEYS + 1).collect() if row[0] is not None]
    micros = F.unix_micros(F.col(ts))

    def cells(rows: DataFrame, width: int) -> DataFrame:
        return rows.groupBy(key, (micros - F.pmod(micros, F.lit(width))).alias("_cell")).count()

    # Widest first: most often nothing has to be counted at the finer widths.
    if len(hot) > MAX_HOT_KEYS:
        for width in widths:
            if width == widths[-1] or cells(df, width).agg(F.max("count")).first()[0] <= max_rows:
                return SegmentPlan(key, ts, others=width)
    cuts = []
    for width in widths:
        if not hot:
            break
        densest = cells(df.filter(F.col(key).isin(*hot)), width).groupBy(key).agg(F.max("count"))
        fitting = sorted(k for k, peak in densest.collect() if peak <= max_rows or width == widths[-1])
        if fitting:
            cuts.append((width, tuple(fitting)))
        hot = [k for k in hot if k not in fitting]
    return SegmentPlan(key, ts, tuple(sorted(cuts)))


SEGMENT = "_segment"


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    plan: SegmentPlan | None,
    build: Callable[[DataFrame, bool], DataFrame],
    gather: bool = True,
) -> DataFrame:
    """Run `build` on rows brought together by key and put in order: whole keys, and hot ones in segments.

    `build` gets the rows and whether they are cut; it hands both to `running`. Rows are shuffled and sorted here, while
    they are narrow, and not after the running values have added their inputs to them. With `gather` off that is left to
    the windows; the optimizer then drops the shuffle together with running values nobody asks for.
    """

    def whole(rows: DataFrame) -> DataFrame:
        return build(_arranged(rows, keys, order) if gather else rows, False)

    def in_segments(rows: DataFrame) -> DataFrame:
        parts = [*keys, SEGMENT]
        cut = rows.withColumn(SEGMENT, plan.segment())
        return build(_arranged(cut, parts, order) if gather else cut, True).drop(SEGMENT)

    if plan is None or not plan.cuts_any:
        return whole(df)
    if plan.others is not None:
        return in_segments(df)
    return whole(df.filter(~plan.is_hot())).unionByName(in_segments(df.filter(plan.is_hot())))


def _arranged(df: DataFrame, parts: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.repartition(*parts).sortWithinPartitions(*parts, *order)


@dataclass(frozen=True)
class Running:
    """One running value: `kind` applied to `expr` along the order of a key."""

    kind: str
    expr: Column

    def over(self, keys: Sequence[str], order: Sequence[Column]) -> Column:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if self.kind == "last":
            return F.last(self.expr, ignorenulls=True).over(so_far)
        if self.kind == "first":
            return F.first(self.expr, ignorenulls=True).over(so_far)
        if self.kind == "sum":
            return F.sum(self.expr).over(so_far)
        if self.kind == "previous":
            return F.last(self.expr, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        return F.lead(self.expr).over(ordered)

    def of_segment(self, order: Sequence[Column]) -> Column:
        """What a whole segment hands on to its neighbours."""
        if self.kind == "sum":
            return F.sum(self.expr)
        place = F.when(self.expr.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
        pick = F.min_by if self.kind in ("first", "next") else F.max_by
        return pick(self.expr, place)

    def of_segments(self, handed_on: Column) -> Column:
        """What a stretch of segments hands on; rows without a time form the first segment."""
        if self.kind == "sum":
            return F.sum(handed_on)
        place = F.when(handed_on.isNotNull(), F.struct(F.col(SEGMENT)))
        pick = F.min_by if self.kind in ("first", "next") else F.max_by
        return pick(handed_on, place)

    def inherited(self, handed_on: Column, across: Window) -> Column:
        """What a segment receives from the earlier (for "next": the following) segments of its key."""
        earlier = across.rowsBetween(Window.unboundedPreceding, -1)
        if self.kind == "sum":
            return F.sum(handed_on).over(earlier)
        if self.kind == "first":
            return F.first(handed_on, ignorenulls=True).over(earlier)
        if self.kind == "next":
            return F.lead(handed_on).over(across)
        return F.last(handed_on, ignorenulls=True).over(earlier)

    def combined(self, local: Column, inherited: Column) -> Column:
        if self.kind == "sum":
            return F.when(local.isNull(), inherited).otherwise(local + F.coalesce(inherited, F.lit(0)))
        if self.kind == "first":
            return F.coalesce(inherited, local)
        return F.coalesce(local, inherited)


def last(expr: Column) -> Running:
    """Last known value up to and including the row."""
    return Running("last", expr)


def previous(expr: Column) -> Running:
    """Last known value before the row."""
    return Running("previous", expr)


def first(expr: Column) -> Running:
    """First known value of the key so far."""
    return Running("first", expr)


def following(expr: Column) -> Running:
    """Value of the next row; `expr` must not be null."""
    return Running("next", expr)


def total(expr: Column) -> Running:
    """Sum up to and including the row."""
    return Running("sum", expr)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: dict[str, Running], is_cut: bool
) -> DataFrame:
    """Add running values along `order` (a total order whose first part is the time) within `keys`.

    Used inside `by_heat`, whose rows are in place already. With `is_cut` the windows run per segment, and one summary
    row per segment carries the values across the segments of a key.
    """
    if not is_cut:
        return df.select("*", *[v.over(keys, order).alias(name) for name, v in values.items()])

    parts = [*keys, SEGMENT]
    local = df.select("*", *[v.over(parts, order).alias(name) for name, v in values.items()])
    handed_on = df.groupBy(*parts).agg(*[v.of_segment(order).alias(name) for name, v in values.items()])
    inherited = _carried(handed_on, keys, values).select(*parts, *[F.col(name).alias(f"_in_{name}") for name in values])
    return join_null_safe(local, inherited, parts, "left").select(
        *df.columns, *[v.combined(F.col(name), F.col(f"_in_{name}")).alias(name) for name, v in values.items()]
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, two nulls being equal; the left side's keys stay."""
    named = right.select(*[F.col(c).alias(f"_on_{c}" if c in keys else c) for c in right.columns])
    same = [left[k].eqNullSafe(named[f"_on_{k}"]) for k in keys]
    return left.join(named, same, how).drop(*[f"_on_{k}" for k in keys])


def _carried(handed_on: DataFrame, keys: Sequence[str], values: dict[str, Running]) -> DataFrame:
    """What each segment inherits from the others of its key.

    Carried in two steps, within stretches of segments and across them: a key cut by seconds or finer has millions of
    segments, which no task sees all of.
    """
    rows = handed_on.withColumn("_stretch", F.floor(F.col(SEGMENT) / SEGMENTS_OF_STRETCH))
    inside = Window.partitionBy(*keys, "_stretch").orderBy(SEGMENT)
    across = Window.partitionBy(*keys).orderBy("_stretch")
    near = rows.select(*keys, SEGMENT, "_stretch", *[v.inherited(F.col(n), inside).alias(n) for n, v in values.items()])
    stretches = rows.groupBy(*keys, "_stretch").agg(*[v.of_segments(F.col(n)).alias(n) for n, v in values.items()])
    far = stretches.select(*keys, "_stretch", *[v.inherited(F.col(n), across).alias(f"_far_{n}") for n, v in values.items()])
    return join_null_safe(near, far, [*keys, "_stretch"]).select(
        *keys, SEGMENT, *[v.combined(F.col(n), F.col(f"_far_{n}")).alias(n) for n, v in values.items()]
    )
