"""Regular time grids, re-binning, completion and gap detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import segments as sg

HALF_HOUR = 1800


def rebin(
    df: DataFrame,
    keys: list[str],
    ts: str,
    aggs: Mapping[str, str],
    width: int = HALF_HOUR,
    label: str = "start",
    null: str = "skip",
) -> DataFrame:
    """Sum, mean, min or max of columns per time bin.

    ``null='strict'`` makes a bin NULL when any of its values is, ``'skip'``
    leaves missing values out. All aggregates are partial, so a hot sensor is
    reduced before the shuffle.
    """
    fns = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}
    out = []
    for col, how in aggs.items():
        value = fns[how](col)
        if null == "strict":
            value = F.when(F.count(col) == F.count(F.lit(1)), value)
        out.append(value.alias(col))
    return df.withColumn(ts, tp.bin_time(ts, width, label)).groupBy(*keys, ts).agg(*out)


def series_bounds(
    df: DataFrame, keys: list[str], ts: str, inward: bool = True
) -> DataFrame:
    """First and last whole day of each series (or of all together without keys).

    ``inward`` rounds the start up and the end down; otherwise outward.
    """
    lo, hi = F.min(ts), F.max(ts)
    first, last = (tp.ceil_day, tp.floor_day) if inward else (tp.floor_day, tp.ceil_day)
    return df.groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi")).select(
        *keys, first("_lo").alias("start"), last("_hi").alias("end")
    )


def make_grid(bounds: DataFrame, keys: list[str], ts: str, step: int = HALF_HOUR, label: str = "end") -> DataFrame:
    """One row per step between ``start`` and ``end``.

    With end labels the first midnight is left out, with start labels the last
    one. Days are generated first, dealt out over the tasks, and expanded to
    steps second: the few rows of bounds would otherwise make the grid of all
    series in one task.
    """
    days = F.sequence(F.to_date("start"), F.date_sub(F.to_date("end"), 1))
    per_day = tp.DAY_SECONDS // step
    offset = 1 if label == "end" else 0
    by_day = bounds.filter(F.col("start") < F.col("end")).select(*keys, F.explode(days).alias("_day"))
    tasks = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = F.sequence(F.lit(offset), F.lit(per_day - 1 + offset))
    return by_day.repartition(tasks, *keys, "_day").select(*keys, "_day", F.explode(slots).alias("_slot")).select(
        *keys, tp.plus_seconds(F.col("_day").cast("timestamp_ntz"), F.col("_slot") * step).alias(ts)
    )


def complete_grid(
    df: DataFrame,
    keys: list[str],
    ts: str,
    step: int = HALF_HOUR,
    label: str = "end",
    bounds: DataFrame | None = None,
    common: bool | Sequence[str] = True,
    inward: bool = True,
) -> DataFrame:
    """Every step of the grid for every series, values NULL where none were read.

    ``common`` uses one span for all series, as when two towers are stacked;
    named keys use one span for all series that agree in them.
    Without ``bounds`` the rows are read twice, first for keys and stamps
    alone; settle rows that are dear to make.
    """
    if bounds is None:
        bounds = series_bounds(df, keys, ts, inward)
        if not isinstance(common, bool):
            # One row per series: windows over the series of a group stay small.
            group = Window.partitionBy(*common)
            dated = bounds.filter(F.coalesce("start", "end").isNotNull())
            bounds = dated.select(*keys, F.min("start").over(group).alias("start"), F.max("end").over(group).alias("end"))
        elif common and keys:
            # Both uses keep start and end, so that they share one aggregate.
            dated = bounds.filter(F.coalesce("start", "end").isNotNull())
            span = dated.agg(F.struct(F.min("start").alias("start"), F.max("end").alias("end"))).scalar()
            bounds = dated.select(*keys, span.alias("_span")).select(*keys, "_span.*")
    grid = make_grid(bounds, keys, ts, step, label)
    return grid.join(df, [*keys, ts], "left")


def gap_runs(
    df: DataFrame,
    keys: list[str],
    ts: str,
    required: list[str],
    steps_per_day: int = 48,
    seconds: int = sg.SEGMENT_SECONDS,
) -> DataFrame:
    """Contiguous runs of rows in which any required value is missing.

    Every missing row is named by the last complete row before it, found inside
    its time segment or handed on from an earlier one; rows of one name are one
    run. Counting them is a partial aggregate, however long a run may be.
    """
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    cut = sg.with_segment(df, keys, ts, seconds).select(
        *keys, ts, sg.SEGMENT, F.when(~missing, F.col(ts)).alias("_whole")
    )
    earlier = sg.across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(*keys, sg.SEGMENT)
        .agg(F.max("_whole").alias("_last"))
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
        .drop("_last")
    )
    named = cut.withColumn("_after", F.last("_whole", ignorenulls=True).over(sg.inside(keys, [ts])))
    return (
        sg.attach_carry(named.filter(F.col("_whole").isNull()), carry, keys)
        .groupBy(*keys, F.coalesce("_after", "_carry").alias("_run"))
        .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("n"))
        .drop("_run")
        .withColumn("ndays", F.col("n") / float(steps_per_day))
    )


def gap_summary(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Longest gaps first; gaps of equal length share one line, from first to last."""
    return (
        runs.groupBy(*keys, "ndays")
        .agg(F.min("start").alias("min"), F.max("end").alias("max"))
        .select(
            *keys,
            F.round("ndays", 2).alias("ndays"),
            "min",
            "max",
            tp.year_span(F.year("min"), F.year("max")).alias("years"),
        )
        .orderBy(F.desc("ndays"), *keys)
    )


def gaps_over(runs: DataFrame, days: float, years: list[int] | None = None) -> DataFrame:
    """Gaps of at least ``days`` days, optionally only those touching given years."""
    out = runs.filter(F.col("ndays") >= days)
    if years is not None:
        span = F.sequence(F.year("start"), F.year("end"))
        out = out.filter(F.arrays_overlap(span, F.array(*[F.lit(y) for y in years])))
    return out
