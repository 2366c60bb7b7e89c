"""Joins of sources, dimensions and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxloom.functions import values as vl
from fluxloom.operators import segments as sg
from fluxloom.operators.attach import attach, from_rows
from fluxloom.session import settle


def join_sources(base: DataFrame, *others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-joins on shared keys; one shuffle per table, the base's is reused."""
    return reduce(lambda left, right: left.join(right, list(on), "left"), others, base)


def join_fallback(df: DataFrame, other: DataFrame, on: Sequence[str], value: str, out: str) -> DataFrame:
    """A second station's value beside each row."""
    return df.join(other.select(*on, F.col(value).alias(out)), list(on), "left")


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Dimension lookup; a dimension with repeated keys repeats rows."""
    return attach(df, dim, list(on))


def plot_dimension(spark, rows: Sequence[tuple], rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Sensor plot table; the first rule whose text occurs in the long name gives the code."""
    df = from_rows(spark, rows, "plot string, veg_com_long string")
    return classify(df, "veg_com_long", rules, "veg_com")


def classify(df: DataFrame, col: str, rules: Sequence[tuple[str, str]], out: str) -> DataFrame:
    code: Column | None = None
    for text, label in rules:
        test = F.col(col).contains(text)
        code = F.when(test, label) if code is None else code.when(test, label)
    return df.withColumn(out, code if code is not None else F.lit(None).cast("string"))


def full_stack(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join in which missing keys meet, other columns side by side."""
    right = b.withColumnsRenamed({k: f"_r_{k}" for k in on})
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    left = a.withColumn("_l", F.lit(True))
    rest_a = [c for c in a.columns if c not in on]
    rest_b = [c for c in b.columns if c not in on]
    return left.join(right, cond, "full").select(
        *[F.when(F.col("_l").isNotNull(), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in on],
        *rest_a,
        *rest_b,
    )


def align_summaries(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Summary beside summary; both hold one row per key."""
    return left.join(right, list(on), how)


RANGE = "_range"


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in as many ranges of ``order`` as a shuffle has partitions, about equally full, their number in ``RANGE``; a stored table."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()))


def nearest_cell(points: DataFrame, cells: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Nearest grid coordinate of every point, axis by axis (``near_<axis>``).

    The distinct places of the points and the grid's coordinates are laid
    along each axis together, and every place looks at the coordinate before
    and after it: points and cells are never paired off, and a place shared by
    very many points is looked up once. The line is dealt to tasks in ranges
    of equal numbers of places, wherever they lie; what a range passes to the
    next ones goes by its number. Of two coordinates equally near the larger
    one is taken.
    """
    axes = list(axes)

    def places(df: DataFrame) -> DataFrame:
        each = [F.struct(F.lit(a).alias("_axis"), F.col(a).cast("double").alias("_at")) for a in axes]
        long = df.select(F.explode(F.array(*each)).alias("_p")).select("_p.*")
        return long.filter(vl.known("_at")).distinct()

    line = places(points).withColumn("_mark", F.lit(None).cast("double")).unionByName(
        places(cells).withColumn("_mark", F.col("_at"))
    )
    line = in_ranges(line, ["_axis", "_at"])
    seen = sg.bracket(line, ["_axis"], "_at", "_mark", F.col(RANGE))
    back, ahead = F.col("_at") - F.col("_prev"), F.col("_next") - F.col("_at")
    near = F.when(F.col("_next").isNull() | (back < ahead), F.col("_prev")).otherwise(F.col("_next"))
    found = settle(seen.filter(F.col("_mark").isNull()).select("_axis", "_at", near.alias("_near")))
    out = points
    for a in axes:
        side = found.filter(F.col("_axis") == a).select(
            F.col("_at").cast(points.schema[a].dataType).alias(a), F.col("_near").alias(f"near_{a}")
        )
        out = attach(out, side, [a])
    return out.select(*points.columns, *[f"near_{a}" for a in axes])


def case_diff(a: DataFrame, b: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A minus B for every variable where both have the key."""
    right = b.select(*on, *[F.col(c).alias(f"_b_{c}") for c in cols])
    return a.join(right, list(on)).select(*on, *[(F.col(c) - F.col(f"_b_{c}")).alias(c) for c in cols])


def choose_by_key(a: DataFrame, b: DataFrame, on: Sequence[str], cond: Column, cols: Sequence[str]) -> DataFrame:
    """Values from ``a`` where the condition on the key holds, else from ``b``."""
    left = a.select(*on, *[F.col(c).alias(f"_a_{c}") for c in cols])
    right = b.select(*on, *[F.col(c).alias(f"_b_{c}") for c in cols])
    return left.join(right, list(on), "full").select(
        *on, *[F.when(cond, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in cols]
    )


def reindex(df: DataFrame, key: str, values: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows for exactly the listed categories, in that order (``ord``).

    With ``within`` the list is completed inside every group; groups are
    expanded by an array of the listed values.
    """
    if not within:
        index = from_rows(df.sparkSession, list(enumerate(values)), f"ord int, `{key}` string")
    else:
        index = df.select(*within).distinct().select(
            *within, F.posexplode(F.array(*[F.lit(v) for v in values])).alias("ord", key)
        )
    return index.join(df, [*within, key], "left")


def densify(df: DataFrame, k1: str, k2: str, rows: int = 16, cols: int = 8) -> DataFrame:
    """Every combination of the two keys, values NULL where absent.

    The distinct values are dealt into ``rows`` and ``cols`` and meet by an
    equality join on (row, column), so building the product is spread over
    rows × cols tasks whatever the number of values on either side.
    """

    def dealt(key: str, mine: str, n: int, theirs: str, m: int) -> DataFrame:
        every = F.sequence(F.lit(0), F.lit(m - 1))
        return (
            df.select(key)
            .distinct()
            .withColumn(mine, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
            .withColumn(theirs, F.explode(every))
        )

    index = dealt(k1, "_r", rows, "_c", cols).join(dealt(k2, "_c", cols, "_r", rows), ["_r", "_c"])
    return index.drop("_r", "_c").join(df, [k1, k2], "left")
