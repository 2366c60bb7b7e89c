"""Gap filling from neighbours in time, other stations and replicate sensors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.functions import values as vl
from fluxloom.operators import segments as sg


def interpolate_linear(
    df: DataFrame, keys: list[str], ts: str, col: str, out: str | None = None, seconds: int = sg.SEGMENT_SECONDS
) -> DataFrame:
    """Straight line between the known neighbours of a gap.

    Leading and trailing gaps stay NULL; there is no longest gap.
    """
    seen = sg.bracket(df, keys, ts, col, sg.own_segment(df, ts, seconds))
    since, gap = tp.seconds_between("_prev_at", ts), tp.seconds_between("_prev_at", "_next_at")
    line = F.col("_prev") + (F.col("_next") - F.col("_prev")) * since / gap
    value = F.coalesce(F.col(col), line)
    return seen.withColumn(out or col, value).drop("_prev_at", "_prev", "_next_at", "_next")


def fill_from(df: DataFrame, col: str, fallback: str, when: Column) -> DataFrame:
    """Missing values taken from the fallback column where the guard holds."""
    return df.withColumn(col, F.when(F.col(col).isNull() & when, F.col(fallback)).otherwise(F.col(col)))


def fill_two_sources(
    df: DataFrame, ids: Sequence[str], role: str, cols: Sequence[str], base: str = "base", fill: str = "fill"
) -> DataFrame:
    """Base series filled from the other one, with a flag per value.

    ``n`` own value, ``s`` substituted, ``m`` missing in both. Roles are set
    side by side by one aggregate over named roles.
    """

    def pick(c: str, r: str) -> Column:
        return F.max(F.when(F.col(role) == r, F.col(c)))

    wide = df.groupBy(*ids).agg(
        *[pick(c, base).alias(f"{c}_base") for c in cols], *[pick(c, fill).alias(f"{c}_fill") for c in cols]
    )
    out: list[Column] = []
    for c in cols:
        own, other = F.col(f"{c}_base"), F.col(f"{c}_fill")
        out.append(F.coalesce(own, other).alias(c))
        out.append(
            F.when(own.isNotNull(), "n").when(other.isNotNull(), "s").otherwise("m").alias(f"{c}_flag")
        )
    return wide.select(*ids, *out)


def fill_priority(df: DataFrame, cols: Sequence[str], labels: Sequence[str], out: str, letter: str) -> DataFrame:
    """First known replicate and the letter it came from."""
    chosen: Column | None = None
    for c, label in zip(cols, labels):
        known = F.col(c).isNotNull()
        chosen = F.when(known, label) if chosen is None else chosen.when(known, label)
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in cols])).withColumn(letter, chosen)


def era_select(
    df: DataFrame, ts: str, boundary: str, before: str, after: Sequence[str], out: str
) -> DataFrame:
    """One probe before the boundary, the mean of several after it.

    A row exactly on the boundary belongs to neither and is dropped. One pass
    with a conditional replaces two filtered reads and a union.
    """
    edge = F.lit(boundary).cast("timestamp_ntz")
    value = F.when(F.col(ts) < edge, F.col(before)).otherwise(vl.row_mean(*after))
    return df.filter(F.col(ts) != edge).withColumn(out, value)


def take_filled(df: DataFrame, ids: Sequence[str], ts: str, suffix: str = "_f", back_seconds: int = 1800) -> DataFrame:
    """Filled columns under their plain names, stamps moved back to interval start."""
    filled = [c for c in df.columns if c.endswith(suffix)]
    return df.select(
        *ids,
        tp.plus_seconds(ts, F.lit(-back_seconds)).alias(ts),
        *[F.col(c).alias(c[: -len(suffix)]) for c in filled],
    )
