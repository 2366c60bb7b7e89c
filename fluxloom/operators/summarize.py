"""Diurnal, seasonal, day-of-year, monthly and annual summaries.

Everything is a hash aggregate over algebraic functions: each task reduces
its rows to one line per group before anything is shuffled, so hot groups
cost no more than cold ones.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxloom.functions import timeparts as tp
from fluxloom.functions import values as vl
from fluxloom.operators import qc


def mean_sd(cols: Sequence[str], mean: str, sd: str, population: bool = False) -> list[Column]:
    dev = F.stddev_pop if population else F.stddev_samp
    return [F.avg(c).alias(c + mean) for c in cols] + [dev(c).alias(c + sd) for c in cols]


def diurnal_seasonal(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str = "ts", hour: Column | None = None) -> DataFrame:
    """Mean and deviation per season and hour."""
    h = tp.decimal_hour(ts) if hour is None else hour
    return df.groupBy(*keys, tp.season(F.month(ts)).alias("season"), h.alias("hour")).agg(
        *mean_sd(cols, "_houravg", "_hoursd")
    )


def doy_climatology(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str = "ts", noleap: bool = True) -> DataFrame:
    """Mean and deviation per day of year, with 29 February left out or raw."""
    doy = tp.noleap_doy(F.to_date(ts)) if noleap else F.dayofyear(ts)
    out = df.groupBy(*keys, doy.alias("doy")).agg(*mean_sd(cols, "_dailyavg", "_dailysd"))
    return out.filter(F.col("doy").isNotNull())


def annual_summary(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys, F.year(ts).alias("year")).agg(*mean_sd(cols, "_yearavg", "_yearsd"))


def mean_annual(annual: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean and deviation of annual values across years."""
    return annual.groupBy(*keys).agg(*mean_sd(cols, "_mean", "_sd"))


def month_diurnal(df: DataFrame, month: int, cols: Sequence[str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Diurnal cycle of one calendar month."""
    return (
        df.filter(F.month(ts) == month)
        .groupBy(*keys, tp.decimal_hour(ts).alias("hour"))
        .agg(*mean_sd(cols, "_houravg", "_hoursd"))
    )


def annual_peak(df: DataFrame, col: str, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Highest value of each year and the mean of these maxima per series."""
    peaks = df.groupBy(*keys, F.year(ts).alias("year")).agg(F.max(col).alias(f"max_{col}"))
    return peaks.withColumn(
        f"mean_max_{col}", F.avg(f"max_{col}").over(Window.partitionBy(*keys))
    )


def daily_total(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys, F.to_date(ts).alias("date")).agg(*[F.sum(c).alias(c) for c in cols])


def community_stats(df: DataFrame, by: Sequence[Column | str], col: str) -> DataFrame:
    """Mean, deviation and count of one measure per group."""
    return df.groupBy(*by).agg(
        F.avg(col).alias(f"{col}_avg"), F.stddev_samp(col).alias(f"{col}_sd"), F.count(col).alias("n")
    )


def group_stats(df: DataFrame, keys: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Mean and deviation of every numeric column."""
    cols = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in (*keys, *skip)
    ]
    return df.groupBy(*keys).agg(*mean_sd(cols, "_mean", "_std"))


def annual_npp(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Productivity per year and community."""
    return df.groupBy(*keys).agg(F.avg(col).alias(f"mean_{col}"), F.stddev_samp(col).alias(f"sd_{col}"))


def precip_totals(
    df: DataFrame, rate: str, keys: Sequence[str], ts: str, level: str, summer_bug: bool = False
) -> DataFrame:
    """Totals from a mean rate per second: per year, month or summer.

    Summer is June to September (122 days). ``summer_bug`` selects October to
    December instead, as one published script does. Means weigh every step alike.
    """
    day = float(tp.DAY_SECONDS)
    if level == "annual":
        by, days = [F.year(ts).alias("year")], F.lit(365.0)
    elif level == "monthly":
        by = [F.year(ts).alias("year"), F.month(ts).alias("month")]
        days = tp.days_in_month(F.col("month")).cast("double")
    else:
        chosen = F.month(ts) > 9 if summer_bug else F.month(ts).between(6, 9)
        df, by, days = df.filter(chosen), [F.year(ts).alias("year")], F.lit(122.0)
    return (
        df.groupBy(*keys, *by).agg(F.avg(rate).alias("_rate"))
        .withColumn("total", F.col("_rate") * day * days)
        .drop("_rate")
    )


def _bin_start(d: Column, freq: str) -> Column:
    return {
        "D": d,
        "M": F.make_date(F.year(d), F.month(d), F.lit(1)),
        "Y": F.make_date(F.year(d), F.lit(1), F.lit(1)),
        "QS-DEC": tp.quarter_from_december(d),
    }[freq]


def resample(df: DataFrame, keys: Sequence[str], ts: str, freq: str, aggs: dict[str, str]) -> DataFrame:
    """Calendar re-binning to days (D), months (M), years (Y) or quarters from December (QS-DEC)."""
    start = _bin_start(F.to_date(ts), freq)
    fns = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}
    return df.groupBy(*keys, start.alias("start")).agg(
        *[fns[how](c).alias(f"{c}_{how}") for c, how in aggs.items()]
    )


def day_cube(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str]) -> DataFrame:
    """One row per series and day with states that merge: number, sum, least and greatest of every column.

    The table is read once, for whatever calendar levels are rolled up from it.
    """
    states = [fn(c).alias(f"{c}_{name}") for c in cols for name, fn in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))]
    return df.groupBy(*keys, F.to_date(ts).alias("date")).agg(*states)


def _merged(c: str, how: str) -> Column:
    total, n = F.sum(f"{c}_sum"), F.sum(f"{c}_n")
    return {"mean": F.try_divide(total, n), "sum": total, "min": F.min(f"{c}_min"), "max": F.max(f"{c}_max")}[how]


def roll_up(cube: DataFrame, keys: Sequence[str], freqs: Sequence[str], aggs: Mapping[str, str]) -> DataFrame:
    """Several calendar levels of a day cube side by side: ``freq, start`` and the aggregates.

    Every day is sent to its bin of each level; levels as in ``resample``.
    """
    bins = [F.struct(F.lit(f).alias("freq"), _bin_start(F.col("date"), f).alias("start")) for f in freqs]
    dealt = cube.withColumn("_bin", F.explode(F.array(*bins)))
    return dealt.groupBy(*keys, F.col("_bin.freq").alias("freq"), F.col("_bin.start").alias("start")).agg(
        *[_merged(c, how).alias(f"{c}_{how}") for c, how in aggs.items()]
    )


def precip_levels(cube: DataFrame, rate: str, keys: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Totals of ``precip_totals`` for several levels of one day cube: ``level, year, month`` (0 above months), ``total``.

    ``autumn`` is what ``summer_bug`` gives.
    """
    date = F.col("date")
    year, month, none = F.year(date), F.month(date), F.lit(0)
    known = {
        "annual": (F.lit(True), none, F.lit(365)),
        "monthly": (F.lit(True), month, tp.days_in_month(month)),
        "summer": (month.between(6, 9), none, F.lit(122)),
        "autumn": (month > 9, none, F.lit(122)),
    }
    bins = [
        F.when(
            known[name][0],
            F.struct(F.lit(name).alias("level"), year.alias("year"), known[name][1].alias("month"), known[name][2].cast("int").alias("days")),
        )
        for name in levels
    ]
    dealt = cube.withColumn("_bin", F.explode(F.array_compact(F.array(*bins)))).select("*", "_bin.*")
    return (
        dealt.groupBy(*keys, "level", "year", "month", "days").agg(_merged(rate, "mean").alias("_rate"))
        .withColumn("total", F.col("_rate") * float(tp.DAY_SECONDS) * F.col("days"))
        .drop("_rate", "days")
    )


def by_season(resampled: DataFrame, month: int) -> DataFrame:
    """Quarters that start in the given month (12, 3, 6 or 9)."""
    return resampled.filter(F.month("start") == month)


def weighted_annual_mean(monthly: DataFrame, keys: Sequence[str], month: str, col: str) -> DataFrame:
    """Mean over each full run of 12 months, weighted by days per month.

    ``monthly`` holds one row per month. The groups of 12 count from the first
    month of the series and an unfinished last group is dropped; the weights
    are those of January … December in the order of the group.
    """
    order = Window.partitionBy(*keys).orderBy(month)
    rn = F.row_number().over(order) - 1
    grouped = monthly.withColumn("_rn", rn).withColumn("_g", F.floor(F.col("_rn") / 12))
    weight = tp.days_in_month(F.col("_rn") % 12 + 1) / 365.0
    return (
        grouped.groupBy(*keys, "_g")
        .agg(
            F.min(month).alias("start"),
            F.sum(F.col(col) * weight).alias(col),
            F.count(col).alias("_known"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter("_n = 12")
        .select(*keys, "start", F.when(F.col("_known") == 12, F.col(col)).alias(col))
    )


def mean_annual_cycle(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Cycle by month-day key with population deviation and the first date seen."""
    return df.groupBy(*keys, tp.monday_key(ts).alias("monday")).agg(
        *mean_sd(cols, "_mean", "_std", population=True), F.min(ts).alias("first_ts")
    )


def diel(df: DataFrame, col: str, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Cycle by hour-minute key within seasons, population deviation."""
    return df.groupBy(
        *keys, tp.season(F.month(ts)).alias("season"), tp.hourmin(ts).alias("hourmin")
    ).agg(*mean_sd([col], "_mean", "_std", population=True))


def month_sum(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys, F.month(ts).alias("month")).agg(*[F.sum(c).alias(c) for c in cols])


def annual_max_vs_sum(
    df: DataFrame, x: str, y: str, keys: Sequence[str], ts: str = "ts", seconds: float = 1800.0
) -> DataFrame:
    return df.groupBy(*keys, F.year(ts).alias("year")).agg(
        F.max(x).alias(f"max_{x}"), (F.sum(y) * seconds).alias(f"sum_{y}")
    )


def corr_by(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """Pearson r over rows where both values are known; NULL where one of them never changes."""
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return qc.complete_pairs(df, x, y).groupBy(*keys).agg(r.alias("r"), F.count(F.lit(1)).alias("n"))


def corr_test(df: DataFrame, x: str, y: str, keys: Sequence[str], z: float = 1.959963984540054) -> DataFrame:
    """r with its t statistic, degrees of freedom and confidence interval (Fisher z)."""
    base = corr_by(df, x, y, keys)
    r, n = F.col("r"), F.col("n")
    usable = (n > 3) & (F.abs(r) < 1)
    centre = F.when(usable, F.atanh(r))
    half = F.when(usable, z / F.sqrt(n - 3))
    return base.select(
        *keys,
        "r",
        "n",
        (n - 2).alias("df"),
        F.when(usable, r * F.sqrt((n - 2) / (1 - r * r))).alias("t"),
        F.tanh(centre - half).alias("ci_low"),
        F.tanh(centre + half).alias("ci_high"),
    )


def _ln_gamma(z: Column) -> Column:
    """Logarithm of the gamma function by Stirling's series, good to 1e-13 from z = 8 on."""
    return (z - 0.5) * F.log(z) - z + math.log(2 * math.pi) / 2 + 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5)))


def _beta_fraction(x: Column, a: Column, b: Column, terms: int) -> Column:
    """Continued fraction of the incomplete beta function, from its ``terms``-th pair of terms to its first."""

    def step(frac: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        return odd / (1 + even / (1 + frac))

    return F.aggregate(F.sequence(F.lit(terms), F.lit(1)), F.lit(0.0), lambda f, m: step(f, m.cast("double")))


def add_p_value(test: DataFrame, t: str = "t", df: str = "df", out: str = "p", terms: int = 200) -> DataFrame:
    """Two-sided p of a t statistic: P(|T| > t) of Student's distribution, NULL where t or df is.

    The incomplete beta function as a continued fraction, taken from the side
    on which it converges fast. Column expressions only.
    """
    n, sq = F.col(df).cast("double"), F.col(t) * F.col(t)
    a, half = n / 2, F.lit(0.5)
    x, y = n / (n + sq), sq / (n + sq)
    # ln B(a, 1/2), with both gammas moved up to where the series is good.
    moved = F.aggregate(
        F.sequence(F.lit(0), F.lit(7)), F.lit(0.0), lambda s, k: s + F.log((a + k) / (a + k + 0.5))
    )
    ln_beta = math.log(math.pi) / 2 - (moved + _ln_gamma(a + 8.5) - _ln_gamma(a + 8))
    front = F.exp(a * F.log(x) + F.log(y) / 2 - ln_beta)
    tail = front / a / (1 + _beta_fraction(x, a, half, terms))
    body = 1 - front / half / (1 + _beta_fraction(y, half, a, terms))
    p = F.when(sq == 0, 1.0).when(x <= (a + 1) / (a + 2.5), tail).otherwise(body)
    return test.withColumn(out, F.when((n > 0) & sq.isNotNull(), p))


def linfit(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """Least-squares line per group."""
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def slice_change(
    df: DataFrame, col: str, keys: Sequence[str], ts: str, slices: Sequence[tuple[str, int, int]]
) -> DataFrame:
    """Day-of-year means per span of years, and their change against the first span."""
    year, (base, *_) = F.year(ts), [s[0] for s in slices]
    means = [
        F.avg(F.when(year.between(lo, hi), F.col(col))).alias(f"mean_{name}") for name, lo, hi in slices
    ]
    out = (
        df.withColumn("doy", tp.noleap_doy(F.to_date(ts)))
        .filter(F.col("doy").isNotNull())
        .groupBy(*keys, "doy")
        .agg(*means)
    )
    changes = [
        (F.col(f"mean_{name}") - F.col(f"mean_{base}")).alias(f"change_{name}") for name, _, _ in slices[1:]
    ]
    return out.select("*", *changes)


def threshold_season(df: DataFrame, col: str, keys: Sequence[str], ts: str, threshold: float = 0.0) -> DataFrame:
    """First and last day of year at or below the threshold and the days between."""
    doy = F.when(F.col(col) <= threshold, F.dayofyear(ts))
    return (
        df.groupBy(*keys, F.year(ts).alias("year"))
        .agg(F.min(doy).alias("first_doy"), F.max(doy).alias("last_doy"))
        .withColumn("duration", F.col("last_doy") - F.col("first_doy"))
    )


def value_bounds(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.min(c).alias(f"min_{c}") for c in cols], *[F.max(c).alias(f"max_{c}") for c in cols]
    )


def note_counts(df: DataFrame, note: str = "note", date: str = "date") -> DataFrame:
    """Days per disaggregation note and calendar month."""
    days = df.select(note, date).distinct()
    return days.groupBy(note, F.month(date).alias("month")).agg(F.count(F.lit(1)).alias("days"))


def year_doy_overlay(
    df: DataFrame, col: str, mask: str, keys: Sequence[str], ts: str, threshold: float = 269.0, n: int = 10
) -> DataFrame:
    """Smoothed day-of-year lines, one per year, cold days masked.

    Daily means come first, so the rolling window runs over at most 366 rows
    per series and year.
    """
    daily = df.groupBy(*keys, F.year(ts).alias("year"), F.dayofyear(ts).alias("doy")).agg(
        F.avg(col).alias(col), F.avg(mask).alias(mask)
    )
    masked = daily.withColumn(col, vl.mask_below(col, mask, threshold))
    before = n // 2
    w = Window.partitionBy(*keys, "year").orderBy("doy").rowsBetween(-before, n - 1 - before)
    smooth = F.when(F.count(col).over(w) == n, F.avg(col).over(w))
    return masked.withColumn(col, smooth).filter(F.col(col).isNotNull()).drop(mask)


def daily_compare(obs: DataFrame, sim: DataFrame, veg: str, obs_col: str, sim_col: str, ts: str, year: int) -> DataFrame:
    """Observed and simulated mean per community and day of one year."""

    def side(df: DataFrame, col: str, out: str) -> DataFrame:
        return (
            df.filter(F.year(ts) == year)
            .groupBy(veg, F.dayofyear(ts).alias("doy"))
            .agg(F.avg(col).alias(out), F.stddev_samp(col).alias(out + "_sd"))
        )

    return side(obs, obs_col, "obs").join(side(sim, sim_col, "sim"), [veg, "doy"], "left")


def gdd(df: DataFrame, col: str, keys: Sequence[str], ts: str, base: float = 0.0) -> DataFrame:
    """Cumulative positive day-of-year mean: climatology, floor at the base, running sum."""
    clim = doy_climatology(df, [col], keys, ts).select(*keys, "doy", F.col(f"{col}_dailyavg").alias(col))
    warm = clim.withColumn("gdd", vl.zero_below(col, base))
    # 365 rows per series at most.
    w = Window.partitionBy(*keys).orderBy("doy").rowsBetween(Window.unboundedPreceding, 0)
    return warm.withColumn("gdd", F.sum("gdd").over(w))


def summarize_by_time(df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str) -> dict[str, DataFrame]:
    """The simulation summary family.

    The hour is set back by half an hour, -0.5 becoming 23.5, while the date
    stays where it was: stamps mark interval ends.
    """
    h = tp.decimal_hour(ts) - 0.5
    hour = F.when(h == -0.5, F.lit(23.5)).otherwise(h)
    return {
        "diurnal": diurnal_seasonal(df, cols, keys, ts, hour=hour),
        "daily": doy_climatology(df, cols, keys, ts, noleap=False),
        "annual": annual_summary(df, cols, keys, ts),
        "all": df.withColumn("hour", hour),
    }


