"""Bucketed distributions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_of(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the bucket of `value`; bounds are upper limits and belong to their bucket, above the last comes one more."""
    index = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        index = F.when(value <= F.lit(float(bounds[i])), F.lit(i)).otherwise(index)
    return index


def bucket_counts(bucket: Column, weight: Column, buckets: int) -> Column:
    """Aggregate: count per bucket as an array, combined before the shuffle."""
    return F.array(*[F.coalesce(F.sum(F.when(bucket == i, weight)), F.lit(0)).cast("double") for i in range(buckets)])


def histogram_quantile(bounds: Column, counts: Column, q: float) -> Column:
    """Quantile estimated from a histogram.

    `bounds` are the finite upper limits, `counts` the numbers per bucket with one more for values above the last
    limit. Inside the bucket holding rank q * total the values are taken as evenly spread, from 0 in the first
    bucket. A rank above the last limit gives that limit; an empty histogram gives null.
    """
    whole = F.aggregate(counts, F.lit(0.0), lambda acc, n: acc + n)
    rank = F.lit(float(q)) * whole
    uppers = F.concat(bounds, F.array(F.lit(None).cast("double")))
    lowers = F.concat(F.array(F.lit(0.0)), bounds)
    rows = F.arrays_zip(lowers.alias("lower"), uppers.alias("upper"), counts.alias("n"))

    def step(acc: Column, row: Column) -> Column:
        seen = acc["seen"] + row["n"]
        here = acc["found"].isNull() & (row["n"] > 0) & (seen >= rank)
        estimate = F.when(row["upper"].isNull(), row["lower"]).otherwise(
            row["lower"] + (row["upper"] - row["lower"]) * ((rank - acc["seen"]) / row["n"])
        )
        return F.struct(seen.alias("seen"), F.when(here, estimate).otherwise(acc["found"]).alias("found"))

    start = F.struct(F.lit(0.0).alias("seen"), F.lit(None).cast("double").alias("found"))
    return F.aggregate(rows, start, step, lambda acc: acc["found"])


def exponential_bucket(value: Column, scale: int) -> Column:
    """Index i of the bucket (base^i, base^(i+1)] with base 2^(2^-scale); null for values that are not positive.

    The logarithm may be off by a bit next to a bucket's bounds, so the index it gives is held against them. Powers of two
    are exact bounds.
    """
    steps = F.lit(float(2.0**scale))
    guess = (F.ceil(F.log2(value) * steps) - 1).cast("int")

    def bound(index: Column) -> Column:
        """The power of two that is a factor of it comes exactly, and the rest by pow()."""
        whole = F.floor(index / steps)
        return F.pow(F.lit(2.0), whole.cast("double")) * F.pow(F.lit(2.0), index / steps - whole)

    fitting = F.when(value <= bound(guess), guess - 1).when(value > bound(guess + 1), guess + 1).otherwise(guess)
    return F.when(value > 0, fitting)
