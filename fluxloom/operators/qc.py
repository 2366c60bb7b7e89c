"""Quality control: sentinels, thresholds, flags, windows of bad data, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxloom.functions import timeparts as tp
from fluxloom.functions import values as vl
from fluxloom.operators.attach import attach
from fluxloom.session import release, settle

SENTINEL = -9999.0


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Columns in their order, some replaced, field metadata kept."""
    meta = {f.name: f.metadata for f in df.schema.fields}
    return df.select(
        *[new[c].alias(c, metadata=meta[c]) if c in new else F.col(c) for c in df.columns],
        *[e.alias(c) for c, e in new.items() if c not in df.columns],
    )


def null_sentinels(df: DataFrame, sentinel: float = SENTINEL, cols: Sequence[str] | None = None) -> DataFrame:
    """Sentinel and NaN to NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def clean(c: str) -> Column:
        ok = F.col(c) != F.lit(sentinel).cast(types[c])
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(c)
        return F.when(ok, F.col(c))

    return _replace(df, {c: clean(c) for c in (cols or _numeric(df))})


def null_to_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})


def clamp(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    return _replace(df, {c: vl.clamp(c, *b) for c, b in bounds.items()})


def null_outside(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    return _replace(df, {c: vl.null_outside(c, *b) for c, b in bounds.items()})


RULE_SCHEMA = "site string, variable string, start date, end date, lower double, upper double"


def rule_stretches(rules: DataFrame, keys: Sequence[str] = ("site", "variable")) -> DataFrame:
    """Rules of each (site, variable) as disjoint stretches of days with the tightest limits: ``site, variable, first, last, lower, upper``.

    ``keys`` name what a rule holds for, if not site and variable.

    A sweep over the days at which rules begin and end: between two of them
    the same rules hold. A rule covers a run of stretches, which is cut into
    blocks of 1, 2, 4 … aligned stretches (at most two of a size); limits are
    gathered per block, and a stretch takes the tightest of the blocks it
    lies in. So the work is (rules × log of their number), also where all
    rules overlap. Rules without a first or last day, without a limit, or of
    no day between them hold nowhere.
    """
    key = list(keys)
    live = rules.select(
        *key, F.date_add("start", 1).alias("_from"), F.col("end").alias("_to"), F.col("lower").cast("double"), F.col("upper").cast("double")
    ).where((F.col("_from") < F.col("_to")) & (F.col("lower").isNotNull() | F.col("upper").isNotNull()))
    edges = live.select(*key, F.explode(F.array("_from", "_to")).alias("_day")).distinct()
    order = Window.partitionBy(*key).orderBy("_day")
    edges = settle(edges.select(*key, "_day", (F.row_number().over(order) - 1).cast("long").alias("_i"), F.lead("_day").over(order).alias("_next")))
    at = lambda day, name: edges.select(*key, F.col("_day").alias(day), F.col("_i").alias(name))
    placed = null_safe(null_safe(live, at("_from", "_a"), [*key, "_from"]), at("_to", "_b"), [*key, "_to"])
    limits = F.max("lower").alias("lower"), F.min("upper").alias("upper")
    # The same run of stretches by several rules is one run.
    placed = settle(placed.groupBy(*key, "_a", "_b").agg(*limits))

    # Blocks of [a, b): from the left as long as sizes grow, from the right as they shrink.
    level = F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("_b") - F.col("_a"))))).alias("_level")
    sized = placed.select(*key, "_a", "_b", "lower", "upper", level).withColumn("_size", F.pow(F.lit(2), F.col("_level")).cast("long"))
    up = lambda x, size: F.ceil(x / size).cast("long")
    down = lambda x, size: F.floor(x / size).cast("long")
    one, two = F.col("_size"), F.col("_size") * 2
    lo, hi = up(F.col("_a"), one), down(F.col("_b"), one)
    in_lo, in_hi = up(F.col("_a"), two) * 2, down(F.col("_b"), two) * 2
    # What blocks twice as large leave over at either end, or the whole if there are none.
    none = in_lo >= in_hi
    taken = F.when(none, F.sequence(lo, hi - 1)).otherwise(F.filter(F.array(F.when(lo < in_lo, lo), F.when(in_hi < hi, in_hi)), lambda x: x.isNotNull()))
    blocks = sized.where(lo < hi).select(*key, "lower", "upper", "_level", F.explode(taken).alias("_block"))
    blocks = settle(blocks.groupBy(*key, "_level", "_block").agg(*limits))
    most = blocks.agg(F.max("_level")).first()[0]
    inside = edges.where("_next is not null").select(*key, "_i", F.explode(F.sequence(F.lit(0), F.lit(most or 0))).alias("_level"))
    inside = inside.withColumn("_block", F.floor(F.col("_i") / F.pow(F.lit(2), F.col("_level"))).cast("long"))
    tight = null_safe(inside, blocks, [*key, "_level", "_block"]).groupBy(*key, "_i").agg(*limits)
    stretch = edges.select(*key, "_i", F.col("_day").alias("first"), F.date_sub("_next", 1).alias("last"))
    out = settle(null_safe(stretch, tight, [*key, "_i"]).select(*key, "first", "last", "lower", "upper"))
    release(edges, placed, blocks)
    return out


def null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which NULL keys meet."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(named, same).drop(*[f"_r_{c}" for c in on])


def range_filter(df: DataFrame, rules: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """NULL the values a rule forbids within its window of days.

    Long form: ``site``, ``variable``, ``ts``, ``value``. Both end days are
    outside the window. A rule without a cutoff on one side does not test that
    side; one without any cutoff tests nothing. Rules become disjoint
    stretches first (``rule_stretches``), found by (site, variable, month) and
    the day inside it: a value meets one stretch at most, however many rules
    there are, and rows are not multiplied.
    """
    month = lambda day: F.year(day) * 12 + F.month(day)
    months = F.explode(F.sequence(month("first"), month("last")))
    limits = rule_stretches(rules).select("site", "variable", months.alias("_month"), *[F.col(c).alias(f"_{c}") for c in ("first", "last", "lower", "upper")])
    day = F.to_date(ts)
    inside = (F.col("_day") >= F.col("_first")) & (F.col("_day") <= F.col("_last"))
    joined = attach(df.withColumn("_day", day).withColumn("_month", month("_day")), limits, ["site", "variable", "_month"], where=inside)
    bad = F.coalesce(F.col(value) > F.col("_upper"), F.lit(False)) | F.coalesce(F.col(value) < F.col("_lower"), F.lit(False))
    return joined.withColumn(value, F.when(~bad, F.col(value))).select(*df.columns)


def range_filter_days(
    df: DataFrame, rules: DataFrame, keys: Sequence[str], variables: Sequence[str], ts: str = "ts"
) -> DataFrame:
    """``range_filter`` on wide columns with rules from a table: ``*keys, variable, start, end, lower, upper``.

    Disjoint stretches, clipped to the days a series has, become one row of
    limits per series and day. A row meets one of them at most: one join
    serves all variables and the wide rows are not melted. NULL keys meet no
    rule, as there. ``df`` is read twice, first for keys and stamps.
    """
    on, day = list(keys), F.to_date(ts)
    spans = df.groupBy(*on).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    held = rule_stretches(rules.where(F.col("variable").isin(list(variables))), [*on, "variable"])
    clipped = held.join(spans, on).select(
        *on, "variable", "lower", "upper", F.greatest("first", "_lo").alias("_from"), F.least("last", "_hi").alias("_to")
    )
    days = clipped.where("_from <= _to").withColumn("_day", F.explode(F.sequence("_from", "_to")))
    limits = settle(
        days.groupBy(*on, "_day").agg(
            *[F.max(F.when(F.col("variable") == v, F.col("lower"))).alias(f"_lower_{i}") for i, v in enumerate(variables)],
            *[F.min(F.when(F.col("variable") == v, F.col("upper"))).alias(f"_upper_{i}") for i, v in enumerate(variables)],
        )
    )
    joined = attach(df.withColumn("_day", day), limits, [*on, "_day"])
    new: dict[str, Column] = {}
    for i, v in enumerate(variables):
        beyond = (F.col(v) > F.col(f"_upper_{i}")) | (F.col(v) < F.col(f"_lower_{i}"))
        new[v] = F.when(~F.coalesce(beyond, F.lit(False)), F.col(v))
    return _replace(joined, new).select(*df.columns)


def range_filter_wide(df: DataFrame, rules: Sequence[tuple], ts: str = "ts", only: Column | None = None) -> DataFrame:
    """The same on wide columns: rules are (variable, start, end, lower, upper).

    ``only`` limits them to some rows, such as those of one tower.
    """
    day = F.to_date(ts)
    new: dict[str, Column] = {}
    for variable, start, end, lower, upper in rules:
        beyond = F.lit(False)
        if upper is not None:
            beyond = beyond | (F.col(variable) > F.lit(float(upper)))
        if lower is not None:
            beyond = beyond | (F.col(variable) < F.lit(float(lower)))
        inside = (day > F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))
        if only is not None:
            inside = inside & only
        hit = F.coalesce(inside & beyond, F.lit(False))
        new[variable] = F.when(~hit, new.get(variable, F.col(variable)))
    return _replace(df, new)


def null_flagged(df: DataFrame, pairs: Mapping[str, str], bad: Sequence[str] | None = ("m", "mq", "q")) -> DataFrame:
    """NULL values whose flag is bad; with ``bad=None`` any flag counts."""

    def keep(flag: str) -> Column:
        f = F.col(flag)
        return f.isNull() if bad is None else (f.isNull() | ~f.isin(*bad))

    return _replace(df, {v: F.when(keep(f), F.col(v)) for v, f in pairs.items()})


def null_where(df: DataFrame, target: str, keep_if: Column) -> DataFrame:
    """Keep ``target`` only where the condition is known to hold."""
    return _replace(df, {target: F.when(keep_if, F.col(target))})


def between_days(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Rows from the start of day ``lo`` to the start of day ``hi``, both included.

    Compares the bare column, so the filter reaches the file scan.
    """
    start = F.lit(lo).cast("date").cast("timestamp_ntz")
    stop = F.lit(hi).cast("date").cast("timestamp_ntz")
    return df.filter((F.col(ts) >= start) & (F.col(ts) <= stop))


def in_categories(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isin(*allowed))


def not_in_categories(df: DataFrame, col: str, refused: Sequence[str]) -> DataFrame:
    """Rows known to lie outside; NULL is dropped."""
    return df.filter(~F.col(col).isin(*refused))


def drop_leap_day(df: DataFrame, date: str) -> DataFrame:
    return df.filter(~tp.is_leap_day(date))


def season_mask(df: DataFrame, ts: str, cols: Sequence[str], lo: int = 135, hi: int = 273, fill: float = 0.0) -> DataFrame:
    """Values outside the open day-of-year interval become ``fill``."""
    doy = F.dayofyear(ts)
    inside = (doy > lo) & (doy < hi)
    return _replace(df, {c: F.when(inside, F.col(c)).otherwise(F.lit(fill)) for c in cols})


def complete_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.filter(vl.known(x) & vl.known(y))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_grid(df: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid steps absent from the data and data rows off the grid."""
    keys = list(keys)
    have, want = df.select(*keys), grid.select(*keys)
    missing = want.join(have, keys, "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(
        have.join(want, keys, "left_anti").withColumn("problem", F.lit("off grid"))
    )


def check_conservation(
    fine: DataFrame, coarse: DataFrame, keys: Sequence[str], value: str, total: str, tol: float = 1e-7
) -> DataFrame:
    """Groups whose fine values do not add up to the coarse total."""
    sums = fine.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    diff = F.coalesce(F.col("_sum"), F.lit(0.0)) - F.coalesce(F.col(total), F.lit(0.0))
    return (
        coarse.join(sums, list(keys), "left")
        .withColumn("difference", diff)
        .filter(F.abs("difference") > tol)
        .drop("_sum")
    )


def check_dims(df: DataFrame, ids: Sequence[str], lengths: Mapping[str, Sequence[int]]) -> DataFrame:
    """Values whose dimensions differ from the declared ones: ``ids, variable, dimension, expected, found``.

    ``lengths`` has a variable's length along each dimension, outermost first.
    One row per value and dimension in which it (or, further in, any part of
    it) has another length; ``found`` is the first such one. A variable that is
    no array along a declared dimension has the length -1 there. Missing values
    and missing parts have no dimensions and pass.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    found: list[Column] = []
    for name, expected in lengths.items():
        kind: T.DataType | None = types[name]
        # All arrays of this depth in one list.
        parts = F.array(F.col(name))
        for k, n in enumerate(expected, 1):
            if isinstance(kind, T.ArrayType):
                off = F.filter(parts, lambda x: x.isNotNull() & (F.size(x) != n))  # noqa: B023
                odd = F.when(F.size(off) > 0, F.size(off[0]))
                kind, parts = kind.elementType, F.flatten(F.filter(parts, lambda x: x.isNotNull()))
            else:
                kind, odd = None, F.when(F.col(name).isNotNull(), -1)
            found.append(F.struct(F.lit(name).alias("variable"), F.lit(k).alias("dimension"), F.lit(n).alias("expected"), odd.alias("found")))
    rows = df.select(*ids, F.explode(F.array(*found)).alias("_d")).select(*ids, "_d.*")
    return rows.filter(F.col("found").isNotNull())


def qc_compare(before: DataFrame, after: DataFrame, cols: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Both states in long form with a ``Filtered`` tag, variables without any value left out."""

    def long(df: DataFrame, tag: str) -> DataFrame:
        return df.unpivot(list(ids), list(cols), "variable", "value").withColumn("Filtered", F.lit(tag))

    both = long(before, "unfiltered").unionByName(long(after, "filtered"))
    # One row per (variable, tag): bounded by the number of columns.
    alive = settle(
        both.groupBy("variable", "Filtered").agg(F.count("value").alias("_n")).filter("_n > 0").drop("_n")
    )
    return attach(both, alive, ["variable", "Filtered"], "left_semi")
