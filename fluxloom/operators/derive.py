"""Derived variables, disaggregation of totals and forcing preparation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators.attach import attach, from_rows
from fluxloom.operators.qc import drop_leap_day

# Precipitation below freezing as a share of the observed, by
# community and month; months not listed take the community's month 0.
REGIMES = [
    ("FF", 0, 0.1),
    ("FF", 3, 0.25),
    ("FF", 4, 0.25),
    ("FF", 5, 0.25),
    ("DM", 0, 0.1),
    ("DM", 3, 0.25),
    ("DM", 4, 0.25),
    ("DM", 5, 0.25),
    ("MM", 0, 1.0),
    ("WM", 0, 0.75),
    ("SB", 0, 2.0),
]
FREEZING_K = 273.15
# Months of blowing snow and the share of the gauge kept in them.
GAUGE_MONTHS = (10, 11, 12, 1, 2, 3, 4, 5)
GAUGE_FACTOR = 0.39


def derive_radnet(df: DataFrame, sw_in: str, sw_out: str, lw_in: str, lw_out: str, out: str = "radNet") -> DataFrame:
    """Net radiation; any missing part makes it NULL."""
    return df.withColumn(out, (F.col(sw_in) - F.col(sw_out)) + (F.col(lw_in) - F.col(lw_out)))


def derive_diff(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(a) - F.col(b))


def derive_sum(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(a) + F.col(b))


def month_factor(
    df: DataFrame, col: str, date: str, months: Sequence[int] = GAUGE_MONTHS, factor: float = GAUGE_FACTOR, out: str | None = None
) -> DataFrame:
    """Scale a gauge in the months of blowing snow."""
    return df.withColumn(
        out or col, F.when(F.month(date).isin(*months), F.col(col) * factor).otherwise(F.col(col))
    )


def disaggregate(
    daily: DataFrame, fine: DataFrame, keys: Sequence[str], date: str, total: str, weight: str, out: str = "amount"
) -> DataFrame:
    """Spread daily totals over the steps of the day in proportion to the weights.

    Note 0: nothing fell. Note 1: the weights are all zero, the total is
    spread evenly over the steps the day really has. Note 2: proportional.
    Days are matched by date, never by position. ``fine`` holds one row per
    step, so a day is a small group (48 half hours); its weights are summed
    where the join has already put the day, without reading ``fine`` again.
    """
    by = [*keys, date]
    joined = fine.join(daily.select(*by, total), by, "left")
    day = Window.partitionBy(*by)
    t, w, n = F.col(total), F.coalesce(F.sum(weight).over(day), F.lit(0.0)), F.count(F.lit(1)).over(day)
    amount = (
        F.when(t == 0, F.lit(0.0))
        .when(F.col("_w") == 0, t / F.col("_n"))
        .otherwise(t * F.coalesce(F.col(weight), F.lit(0.0)) / F.col("_w"))
    )
    note = F.when(t == 0, 0).when(F.col("_w") == 0, 1).when(t.isNotNull(), 2)
    return (
        joined.withColumns({"_w": w, "_n": n})
        .withColumns({out: amount, "note": F.when(t.isNotNull(), note)})
        .drop("_w", "_n")
    )


def apply_regimes(
    df: DataFrame, precip: str, tair: str, ts: str, rules: Sequence[tuple] = REGIMES, threshold: float = FREEZING_K
) -> DataFrame:
    """One row per community with its share of solid precipitation.

    At or above the threshold the amount is unchanged, below it is scaled; an
    unknown temperature gives NULL, except where the community's factor is 1
    all year and the temperature never matters. The rules become one array
    that is exploded beside each row.
    """
    communities = list(dict.fromkeys(r[0] for r in rules))
    entries = []
    for c in communities:
        months = {m: f for name, m, f in rules if name == c}
        factor: Column = F.lit(float(months.get(0, 1.0)))
        for f in sorted({v for m, v in months.items() if m}):
            chosen = [m for m, v in months.items() if m and v == f]
            factor = F.when(F.month(ts).isin(*chosen), F.lit(float(f))).otherwise(factor)
        same = all(f == 1.0 for f in months.values())
        amount = F.col(precip) if same else (
            F.when(F.col(tair) >= threshold, F.col(precip)).when(
                F.col(tair) < threshold, F.col(precip) * factor
            )
        )
        entries.append(F.struct(F.lit(c).alias("community"), amount.alias("amount")))
    rest = [c for c in df.columns if c != precip]
    return df.select(*rest, precip, F.explode(F.array(*entries)).alias("_r")).select(
        *rest, F.col(precip).alias(f"{precip}_observed"), F.col("_r.community").alias("community"),
        F.col("_r.amount").alias(precip),
    )


def select_regime(df: DataFrame, community: str | None, precip: str = "PRECTmms") -> DataFrame:
    """Forcing of one community, or the observed precipitation when none is named."""
    seen = f"{precip}_observed"
    if community is None:
        any_one = df.filter(F.col("community") == "MM")
        return any_one.withColumn(precip, F.col(seen)).drop(seen, "community")
    return df.filter(F.col("community") == community).drop(seen, "community")


def add_series(
    df: DataFrame, other: DataFrame, on: Sequence[str], target: str, value: str, when: Column | None = None, missing: str = "null"
) -> DataFrame:
    """Add another series (runoff) to the target; ``missing='zero'`` keeps unmatched rows."""
    joined = df.join(other.select(*on, F.col(value).alias("_add")), list(on), "left")
    extra = F.coalesce(F.col("_add"), F.lit(0.0)) if missing == "zero" else F.col("_add")
    total = F.col(target) + extra
    if when is not None:
        total = F.when(when, total).otherwise(F.col(target))
    return joined.withColumn(target, total).drop("_add").select(*df.columns)


def model_ready(df: DataFrame, ts: str, offset: str | Column = "-07:00") -> DataFrame:
    """UTC stamps, no 29 February (by UTC date), month label anew.

    ``offset`` of the clock the stamps are on: the same for all rows, or a
    column of hours from UTC.
    """
    utc = df.withColumn(
        ts, tp.shift_zone(ts, offset, "+00:00") if isinstance(offset, str) else tp.plus_seconds(ts, F.round(offset * -3600))
    )
    return drop_leap_day(utc, ts).withColumn("year_mon", tp.year_mon(ts))


def month_time_axis(df: DataFrame, keys: Sequence[str], ts: str, steps_per_day: int = 48, out: str = "time") -> DataFrame:
    """Days since the first step of the month, counted by step.

    Partitions are (series, month): at most 1,488 half-hour rows each.
    """
    w = Window.partitionBy(*keys, "year_mon").orderBy(ts)
    return df.withColumn("year_mon", tp.year_mon(ts)).withColumn(
        out, (F.row_number().over(w) - 1) / float(steps_per_day)
    )


def pick_layer(df: DataFrame, veg: str, cols: Sequence[str], layers: Mapping[str, int], default: int) -> DataFrame:
    """Layer (from 1) matching each community's sensor depth."""
    level: Column = F.lit(default)
    for name, layer in layers.items():
        level = F.when(F.col(veg) == name, F.lit(layer)).otherwise(level)
    return df.select(*[F.get(F.col(c), level - 1).alias(c) if c in cols else F.col(c) for c in df.columns])


def convert_where(
    df: DataFrame, catalog: DataFrame, predicate: Column, factor: float, offset: float, unit: str
) -> DataFrame:
    """Convert the variables whose catalogue entry fits the predicate.

    Long form with ``variable`` and ``value``; ``units`` comes back beside the value.
    """
    entry = catalog.withColumn("_hit", F.coalesce(predicate, F.lit(False))).select("variable", "units", "_hit")
    return (
        attach(df, entry, ["variable"])
        .withColumn("value", F.when(F.col("_hit"), F.col("value") * factor + offset).otherwise(F.col("value")))
        .withColumn("units", F.when(F.col("_hit"), F.lit(unit)).otherwise(F.col("units")))
        .drop("_hit")
    )


def convert_units(df: DataFrame, rules: Sequence[tuple], value: str = "value", unit: str = "units") -> DataFrame:
    """Long form: each row converted by the rule for its unit, other units kept."""
    dim = from_rows(df.sparkSession, rules, f"`{unit}` string, _to string, _f double, _o double")
    return (
        df.join(F.broadcast(dim), unit, "left")
        .withColumn(value, F.col(value) * F.coalesce("_f", F.lit(1.0)) + F.coalesce("_o", F.lit(0.0)))
        .withColumn(unit, F.coalesce("_to", unit))
        .drop("_to", "_f", "_o")
    )


def apply_overrides(params: DataFrame, overrides: DataFrame, on: Sequence[str]) -> DataFrame:
    """Listed cells set (``set``) or scaled (``scale``), all others kept."""
    return (
        attach(params, overrides, list(on))
        .withColumn("value", F.coalesce(F.col("set"), F.col("value") * F.coalesce(F.col("scale"), F.lit(1.0))))
        .drop("set", "scale")
    )


def clone_category(params: DataFrame, key: str, source: int, targets: Sequence[int]) -> DataFrame:
    """Copies of one category under other numbers, replacing what was there."""
    copies = (
        params.filter(F.col(key) == source)
        .withColumn("_to", F.explode(F.array(*[F.lit(t) for t in targets])))
        .withColumn(key, F.col("_to").cast(params.schema[key].dataType))
        .select(*params.columns)
    )
    return params.filter(~F.col(key).isin(*targets)).unionByName(copies)
