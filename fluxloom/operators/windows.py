"""Running, rolling and shifted series without a whole series in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxloom.operators import segments as sg
from fluxloom.operators.attach import attach
from fluxloom.session import settle


def with_group_stats(df: DataFrame, keys: list[str], cols: list[str], suffixes=("_mean", "_sd")) -> DataFrame:
    """Group mean and sample deviation beside every row.

    Groups may be huge and few (season × hour), so the statistics are
    aggregated first and joined back instead of windowed over the rows.
    """
    stats = settle(
        df.groupBy(*keys).agg(
            *[F.avg(c).alias(c + suffixes[0]) for c in cols],
            *[F.stddev_samp(c).alias(c + suffixes[1]) for c in cols],
        )
    )
    return attach(df, stats, keys, null_safe=True)


def rolling_mean(
    df: DataFrame,
    keys: list[str],
    ts: str,
    col: str,
    n: int = 10,
    center: bool = True,
    step: int | None = None,
    out: str | None = None,
    seconds: int = sg.SEGMENT_SECONDS,
) -> DataFrame:
    """Mean of ``n`` consecutive rows, NULL unless all of them are known.

    An even centred window reaches one row further back than ahead. ``step``
    states that the series is a complete grid of that many seconds.
    """
    before = n // 2 if center else n - 1
    after = n - 1 - before
    placed = sg.with_halo(sg.with_position(df, keys, ts, step, seconds), before, after)
    frame = sg.in_block(keys).rowsBetween(-before, after)
    value = F.when(F.count(col).over(frame) == n, F.avg(col).over(frame))
    return sg.keep_core(placed.withColumn(out or col, value))


def cumulative(
    df: DataFrame,
    keys: list[str],
    ts: str,
    col: str,
    scale: float = 1.0,
    out: str | None = None,
    seconds: int = sg.SEGMENT_SECONDS,
) -> DataFrame:
    """Running sum in which a missing value adds nothing."""
    name = out or col
    cut = sg.with_segment(df, keys, ts, seconds)
    amount = F.coalesce(F.col(col), F.lit(0.0)) * F.lit(scale)
    prior = sg.across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(*keys, sg.SEGMENT)
        .agg(F.sum(amount).alias("_total"))
        .withColumn("_carry", F.coalesce(F.sum("_total").over(prior), F.lit(0.0)))
        .drop("_total")
    )
    running = cut.withColumn(
        "_run", F.sum(amount).over(sg.inside(keys, [ts]).rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        sg.attach_carry(running, carry, keys)
        .withColumn(name, F.col("_run") + F.col("_carry"))
        .drop("_run", "_carry", sg.SEGMENT)
    )


def shift(
    df: DataFrame, keys: list[str], ts: str, cols: list[str], n: int = -1, step: int | None = None,
    seconds: int = sg.SEGMENT_SECONDS,
) -> DataFrame:
    """Values moved by ``n`` rows; ``-1`` brings the next row's value, the last is NULL."""
    look = abs(n)
    placed = sg.with_halo(
        sg.with_position(df, keys, ts, step, seconds), look if n > 0 else 0, look if n < 0 else 0
    )
    w = sg.in_block(keys)

    def moved(c: str) -> Column:
        return F.lead(c, look).over(w) if n < 0 else F.lag(c, look).over(w)

    out = placed.select(
        *[moved(c).alias(c) if c in cols else F.col(c) for c in placed.columns]
    )
    return sg.keep_core(out)


def circular_shift(df: DataFrame, keys: list[str], slot: str, cols: list[str], n: int = -12) -> DataFrame:
    """Roll a cycle by ``n`` slots while the slot coordinates stay.

    A cycle is a summary of at most one day of slots per group, so the group
    is small by construction.
    """
    w = Window.partitionBy(*keys).orderBy(slot)
    ranked = df.withColumn("_rn", F.row_number().over(w) - 1).withColumn(
        "_len", F.count(F.lit(1)).over(Window.partitionBy(*keys))
    )
    source = ranked.select(
        *keys, F.pmod(F.col("_rn") + n, F.col("_len")).alias("_rn"), *[F.col(c).alias(c) for c in cols]
    )
    places = ranked.drop(*cols, "_len")
    return places.join(source, [*keys, "_rn"]).drop("_rn").select(*df.columns)


def time_slice(df: DataFrame, keys: list[str], ts: str, start: int, stop: int, seconds: int = sg.SEGMENT_SECONDS) -> DataFrame:
    """Rows ``start`` … ``stop`` - 1 of every series by order."""
    placed = sg.global_position(df, keys, ts, seconds=seconds)
    return placed.filter(F.col(sg.POSITION).between(start, stop - 1)).drop(sg.POSITION)


def first_last(df: DataFrame, keys: list[str], ts: str, cols: list[str]) -> DataFrame:
    """Values at the first and last time of each series."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias(f"first_{ts}"),
        F.max(ts).alias(f"last_{ts}"),
        *[F.min_by(c, ts).alias(f"first_{c}") for c in cols],
        *[F.max_by(c, ts).alias(f"last_{c}") for c in cols],
    )
