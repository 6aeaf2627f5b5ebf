"""Exact continuous percentiles without sorting or collecting the column in one task.

``percentile`` keeps every distinct value in one aggregation buffer, which cannot hold a column of billions
of distinct amounts. Here the wanted ranks are narrowed down in three counting passes. Buckets are monotone in
the value, so ranks follow from running counts over the buckets. Equal values are counted together first; that
shuffle of (value, count) is the only one of the whole column, and the three passes share it:

1. coarse: 1024 buckets per power of two (a bounded number, whatever the row count);
2. fine: each coarse bucket that holds a wanted rank, cut into 2**18 equal steps between its own ends;
3. the distinct values of the fine buckets that hold a wanted rank.

A double has 2**52 values per power of two, so a fine bucket spans at most about 2**24 distinct values:
the last, ordered pass is bounded by the number format and not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE_PER_OCTAVE = 1024
FINE_STEPS = 2**18
_OCTAVES = 1100  # more than the binary exponents of a double, so that bucket numbers are positive


def exact_percentiles(df: DataFrame, column: str, probabilities: Mapping[str, float]) -> DataFrame:
    """One row with a linearly interpolated percentile per name; NULLs are ignored."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    counts = values.groupBy("v").agg(F.count("*").alias("n")).withColumn("coarse", _coarse_bucket(F.col("v")))

    coarse = counts.groupBy("coarse").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    whole = Window.orderBy("coarse").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    coarse = coarse.select(
        "coarse", "low", "high", (F.sum("n").over(whole) - F.col("n")).alias("start"), F.col("n"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    ).where(_holds_wanted_rank(probabilities))  # at most two buckets per probability: safe to broadcast

    fine = counts.join(F.broadcast(coarse.drop("n")), "coarse").withColumn("fine", _fine_bucket())
    steps = fine.groupBy("coarse", "start", "total", "fine").agg(F.sum("n").alias("n"))
    steps = steps.withColumn("start", F.col("start") + _running_before("fine", "coarse")).where(
        _holds_wanted_rank(probabilities)
    )

    hits = fine.drop("start", "total").join(
        F.broadcast(steps.select("coarse", "fine", "start", "total")), ["coarse", "fine"]
    )
    ranked = hits.withColumn("start", F.col("start") + _running_before("v", "coarse", "fine"))
    return ranked.agg(*[_interpolated(p).alias(name) for name, p in probabilities.items()])


def _coarse_bucket(v: Column) -> Column:
    """Never NULL, also in Spark's eyes: a join on it then adds no filter below the counts, whose shuffle the
    three passes can only share if it is the same for all."""
    magnitude = F.floor(F.log2(F.abs(v)) * COARSE_PER_OCTAVE) + _OCTAVES * COARSE_PER_OCTAVE
    return F.coalesce(F.when(v > 0, magnitude).when(v < 0, -magnitude), F.lit(0).cast("long"))


def _fine_bucket() -> Column:
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    return F.coalesce(F.when(high > low, F.floor((v - low) / (high - low) * FINE_STEPS)), F.lit(0).cast("long"))


def _running_before(order: str, *group: str) -> Column:
    """Rows counted in the buckets before this one."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum("n").over(upto) - F.col("n")


def _position(p: float) -> Column:
    return (F.col("total") - 1) * F.lit(float(p))


def _covers(rank: Column) -> Column:
    return (F.col("start") <= rank) & (rank < F.col("start") + F.col("n"))


def _holds_wanted_rank(probabilities: Mapping[str, float]) -> Column:
    wanted = [rounding(_position(p)) for p in probabilities.values() for rounding in (F.floor, F.ceil)]
    return reduce(or_, [_covers(rank) for rank in wanted])


def _interpolated(p: float) -> Column:
    if not 0 <= p <= 1 or math.isnan(p):
        raise ValueError(f"probability out of range: {p}")
    position = _position(p)
    below = F.max(F.when(_covers(F.floor(position)), F.col("v")))
    above = F.max(F.when(_covers(F.ceil(position)), F.col("v")))
    share = F.max(position - F.floor(position))
    return below + (above - below) * share


#: Size of a sketch, and the part of all rows by which the rank of a percentile may be off (in 99 of 100 cases).
SKETCH_SIZE = 400
RANK_ERROR = 0.0075


def quantile_sketches(df: DataFrame, column: str, *groups: str) -> DataFrame:
    """A mergeable quantile sketch of ``column`` per group, of a few kilobytes: made once per date, say, and kept."""
    value = F.col(column).cast("double")
    return df.groupBy(*groups).agg(F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE)).alias("sketch"), F.count(column).alias("values"))


def merged_percentiles(sketches: DataFrame, probabilities: Mapping[str, float], *groups: str) -> DataFrame:
    """Approximate percentiles of any union of groups, out of their sketches alone. Each is a value that occurs."""
    some = sketches.where("values > 0").groupBy(*groups)
    merged = some.agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("values").alias("values"))
    found = [
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probabilities.items()
    ]
    return merged.select(*groups, "values", *found)
