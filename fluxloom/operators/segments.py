"""Ordered work on series of any length.

A plain ``Window.partitionBy(series)`` puts a whole series into one task. The
helpers here cut every series into time segments of bounded length, work
inside (series, segment), and pass what has to cross a border through a table
with one row per segment ("carry"). The big table is shuffled on (series,
segment) only, so that one series holding most of the rows still spreads over
many tasks. Only the carry table, smaller by the number of rows per segment,
is ever ordered by series alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxloom.functions.timeparts import bin_time, epoch_seconds
from fluxloom.session import settle_buckets

SEGMENT = "_segment"
POSITION = "_position"
BLOCK = "_block"

#: 32 days: 1,536 half-hour steps per task group.
SEGMENT_SECONDS = 32 * 86_400


def segment_of(ts, seconds: int = SEGMENT_SECONDS) -> Column:
    """Start of the stretch of time that holds ``ts``."""
    return bin_time(ts, seconds)


def stage(df: DataFrame, keys: list[str], ts: str, seconds: int = SEGMENT_SECONDS) -> DataFrame:
    """Write the rows once, in buckets of (series, segment), for any number of ordered operators.

    Operators on series read their rows twice, for the carry and for the work
    inside segments. From a staged table both read buckets: what made the rows
    runs once, and no operator shuffles them again. ``_segment`` is an
    additional column, which the operators' results don't have. Worth its
    writing where rows come from joins or aggregates, or several operators
    follow; a plain table of few columns may as well be scanned twice.
    """
    cut = df.withColumn(SEGMENT, segment_of(ts, seconds))
    marked = cut.withMetadata(SEGMENT, {"seconds": seconds})
    return settle_buckets(marked, [*keys, SEGMENT], [*keys, SEGMENT, ts])


def own_segment(df: DataFrame, ts: str, seconds: int = SEGMENT_SECONDS) -> Column:
    """The segment of each row: the stored one of a staged table, which must have the same length."""
    staged = df.schema[SEGMENT].metadata.get("seconds") if SEGMENT in df.columns else None
    if staged is None:
        return segment_of(ts, seconds)
    if staged != seconds:
        raise ValueError(f"table is staged in segments of {staged} seconds, not {seconds}")
    return F.col(SEGMENT)


def with_segment(df: DataFrame, keys: list[str], ts: str, seconds: int = SEGMENT_SECONDS) -> DataFrame:
    """Add the segment each row belongs to.

    No placement is forced: the window inside segments asks for (keys,
    segment) itself, and the carry is reduced by partial aggregation before
    anything moves.
    """
    return df.withColumn(SEGMENT, own_segment(df, ts, seconds))


def inside(keys: list[str], order: list[str]):
    """Window over the rows of one segment in order."""
    return Window.partitionBy(*keys, SEGMENT).orderBy(*order)


def across(keys: list[str]):
    """Window over the segments of one series in order."""
    return Window.partitionBy(*keys).orderBy(SEGMENT)


def attach_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Bring per-segment values to the rows of their segment.

    The rows already lie by (keys, segment) after the window, so only the carry
    moves. Series keys must be known (not NULL), as for any identified series.
    """
    return df.join(carry, [*keys, SEGMENT], "left")


def global_position(
    df: DataFrame, keys: list[str], ts: str, out: str = POSITION, seconds: int = SEGMENT_SECONDS,
    tie: list[str] | None = None,
) -> DataFrame:
    """Row number (from 0) of each row within its series."""
    cut = with_segment(df, keys, ts, seconds)
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(*keys, SEGMENT)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    numbered = cut.withColumn("_rn", F.row_number().over(inside(keys, [ts, *(tie or [])])))
    return (
        attach_carry(numbered, carry, keys)
        .withColumn(out, F.col("_rn") - 1 + F.col("_before"))
        .drop("_rn", "_before", SEGMENT)
    )


def with_position(
    df: DataFrame, keys: list[str], ts: str, step: int | None, seconds: int = SEGMENT_SECONDS
) -> DataFrame:
    """Order position of each row.

    On a complete grid of ``step`` seconds the position follows from the
    timestamp without any shuffle; otherwise rows are numbered.
    """
    if step:
        return df.withColumn(POSITION, F.floor(epoch_seconds(ts) / step))
    return global_position(df, keys, ts, seconds=seconds)


def with_halo(df: DataFrame, before: int, after: int, block: int = 2048) -> DataFrame:
    """Copy rows into every block whose rows may look at them.

    A row looks ``before`` positions back and ``after`` positions ahead.
    ``_core`` marks the copy in the row's own block, the one to keep.
    """
    p = F.col(POSITION)
    own = F.floor(p / block)
    blocks = F.sequence(F.floor((p - after) / block), F.floor((p + before) / block))
    return (
        df.withColumn("_own", own)
        .withColumn(BLOCK, F.explode(blocks))
        .withColumn("_core", F.col(BLOCK) == F.col("_own"))
        .drop("_own")
    )


def in_block(keys: list[str]):
    return Window.partitionBy(*keys, BLOCK).orderBy(POSITION)


def keep_core(df: DataFrame) -> DataFrame:
    return df.filter("_core").drop("_core", BLOCK, POSITION)


def bracket(df: DataFrame, keys: list[str], order: str, value: str, segment: Column) -> DataFrame:
    """Known neighbours of each row: ``_prev_at``, ``_prev``, ``_next_at``, ``_next``.

    The nearest rows before and after that have a value, with their place in
    the order. Rows with a value come first among equals, so a row without one
    has an equal's value as its ``_prev``. ``segment`` must not decrease along
    ``order``. Both directions come from one sort: lag and lead that skip NULL
    move along with the row.
    """
    known = F.when(F.col(value).isNotNull(), F.col(order))
    cut = df.withColumns({"_known_at": known, "_none": F.col(value).isNull(), SEGMENT: segment})
    ends = cut.groupBy(*keys, SEGMENT).agg(
        F.min("_known_at").alias("_a0"),
        F.min_by(value, "_known_at").alias("_v0"),
        F.max("_known_at").alias("_a1"),
        F.max_by(value, "_known_at").alias("_v1"),
    )
    up = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.desc(SEGMENT)).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *keys,
        SEGMENT,
        F.last("_a1", ignorenulls=True).over(up).alias("_left_at"),
        F.last("_v1", ignorenulls=True).over(up).alias("_left"),
        F.last("_a0", ignorenulls=True).over(down).alias("_right_at"),
        F.last("_v0", ignorenulls=True).over(down).alias("_right"),
    )
    place = ", ".join(f"`{k}`" for k in [*keys, SEGMENT])
    window = f"OVER (PARTITION BY {place} ORDER BY `{order}`, `_none`)"

    def near(direction: str, col: str, beyond: str) -> Column:
        return F.coalesce(F.col(f"_{direction}_{col}"), F.col(beyond))

    seen = cut.select(
        "*",
        *[
            F.expr(f"{fn}(`{col}`) IGNORE NULLS {window}").alias(f"_{fn}_{out}")
            for fn in ("lag", "lead")
            for col, out in (("_known_at", "at"), (value, "v"))
        ],
    )
    joined = attach_carry(seen, carry, keys)
    return joined.select(
        *[c for c in df.columns if c != SEGMENT],
        near("lag", "at", "_left_at").alias("_prev_at"),
        near("lag", "v", "_left").alias("_prev"),
        near("lead", "at", "_right_at").alias("_next_at"),
        near("lead", "v", "_right").alias("_next"),
    )
