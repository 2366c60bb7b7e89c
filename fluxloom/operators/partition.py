"""Night-time partitioning of net ecosystem exchange into respiration and uptake.

After Reichstein et al. 2005. Respiration follows temperature as
``Rref * exp(E0 * (1/(Tref - T0) - 1/(T - T0)))`` (Lloyd & Taylor 1994). E0
comes from short windows of night data, Rref from still shorter ones with E0
held, and is interpolated in between.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import segments as sg
from fluxloom.operators.attach import attach
from fluxloom.session import settle

# Fixed values of the published model (°C).
T_REF, T_ZERO = 15.0, -46.02


def sun_elevation_sine(ts, lat: float | Column, lon: float | Column, zone_hours: float | Column) -> Column:
    """Sine of the sun's height for a standard-time stamp; place and zone are numbers or columns."""
    doy = F.dayofyear(ts)
    angle = 2 * math.pi * (doy - 1) / 365.0
    declination = F.radians(F.lit(23.45)) * F.sin(2 * math.pi * (284 + doy) / 365.0)
    minutes = 229.18 * (
        0.000075
        + 0.001868 * F.cos(angle)
        - 0.032077 * F.sin(angle)
        - 0.014615 * F.cos(2 * angle)
        - 0.040849 * F.sin(2 * angle)
    )
    solar_hour = tp.decimal_hour(ts) + (4.0 * (F.lit(lon) - 15.0 * F.lit(zone_hours)) + minutes) / 60.0
    hour_angle = F.radians((solar_hour - 12.0) * 15.0)
    phi = F.radians(F.lit(lat))
    return F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(hour_angle)


def temperature_term(tair) -> Column:
    t = F.col(tair) if isinstance(tair, str) else tair
    return 1.0 / (T_REF - T_ZERO) - 1.0 / (t - T_ZERO)


def window_points(
    night: DataFrame, keys: Sequence[str], ts: str, nee: str, tair: str, half_days: int, step_days: int
) -> DataFrame:
    """One row per (series, window) with its night rows as ``points`` (x, y), the temperature range and their number.

    A window is at most ``2 * half_days + 1`` days of one series: 720 half
    hours by default, whatever the length of the series.
    """
    day = tp.epoch_day(ts)
    first = F.ceil((day - half_days) / step_days)
    last = F.floor((day + half_days) / step_days)
    point = F.struct(temperature_term(tair).alias("x"), F.col(nee).alias("y"))
    return (
        night.select(*keys, F.explode(F.sequence(first, last)).alias("window"), point.alias("_p"), F.col(tair).alias("_t"))
        .groupBy(*keys, "window")
        .agg(
            # In order, so that sums of doubles agree between runs.
            F.array_sort(F.collect_list("_p")).alias("points"),
            (F.max("_t") - F.min("_t")).alias("range"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def _normal_sums(points: Column, e0: Column, then) -> Column:
    """``then(a, b, c, d, e)`` of the sums of s², s·y, x·s², x²·s² and x·s·y, with s = exp(e0·x)."""
    shaped = F.transform(points, lambda p: F.struct(F.exp(e0 * p["x"]).alias("s"), p["x"].alias("x"), p["y"].alias("y")))

    def add(done: Column, p: Column) -> Column:
        s, x, y = p["s"], p["x"], p["y"]
        terms = {"a": s * s, "b": s * y, "c": x * s * s, "d": x * x * s * s, "e": x * s * y}
        return F.struct(*[(done[k] + v).alias(k) for k, v in terms.items()])

    zero = F.struct(*[F.lit(0.0).alias(k) for k in "abcde"])
    return F.aggregate(shaped, zero, add, lambda done: then(*[done[k] for k in "abcde"]))


def _step(points: Column, e0: Column, most: float) -> Column:
    """One Gauss-Newton step of E0 with Rref at its best for the present one: ``e0, move``."""

    def solved(a: Column, b: Column, c: Column, d: Column, e: Column) -> Column:
        rref = F.try_divide(b, a)
        move = F.try_divide(a * (e - rref * c), rref * (a * d - c * c))
        damped = F.greatest(F.lit(-most), F.least(F.lit(most), move))
        # greatest and least pass over NULL: no step at all must stay unknown.
        to = F.when(move.isNotNull() & ~F.isnan(move), F.greatest(F.lit(-1000.0), F.least(F.lit(2000.0), e0 + damped)))
        return F.struct(to.alias("e0"), move.alias("move"))

    return _normal_sums(points, e0, solved)


def window_fits(
    night: DataFrame, keys: Sequence[str], ts: str, nee: str, tair: str, half_days: int, step_days: int, min_rows: int,
    min_range: float, rounds: int, start: float, most_move: float,
) -> DataFrame:
    """Every window's fit as ``f`` (e0, its last move, rref, the parameter's lever and the squared residuals), as one expression."""
    points = F.col("points")
    begin = F.struct(F.lit(start).alias("e0"), F.lit(None).cast("double").alias("move"))

    def ends(state: Column) -> Column:
        return _normal_sums(
            points, state["e0"],
            lambda a, b, c, d, e: F.struct(
                state["e0"].alias("e0"), state["move"].alias("move"), F.try_divide(b, a).alias("rref"), F.try_divide(a, a * d - c * c).alias("lever")
            ),
        )

    def residual(end: Column) -> Column:
        left = F.aggregate(points, F.lit(0.0), lambda done, p: done + (p["y"] - end["rref"] * F.exp(end["e0"] * p["x"])) ** 2)
        return F.struct(*[end[c].alias(c) for c in ("e0", "move", "rref", "lever")], left.alias("left"))

    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begin, lambda state, _: _step(points, state["e0"], most_move), ends)
    usable = (F.col("n") >= min_rows) & (F.col("range") >= min_range)
    # A one-element array names the fit for the expression over it.
    fit = F.when(usable, F.transform(F.array(fitted), residual)[0])
    windows = window_points(night, keys, ts, nee, tair, half_days, step_days)
    return windows.select(*keys, "window", "n", "range", fit.alias("f"))


def sensitivity_windows(
    night: DataFrame, keys: Sequence[str], ts: str, nee: str, tair: str, half_days: int = 7, step_days: int = 5, min_rows: int = 6,
    min_range: float = 5.0, rounds: int = 30, start: float = 100.0, most_move: float = 100.0, tolerance: float = 1e-7,
) -> DataFrame:
    """E0 with its error for every window of night rows: ``window, n, status, e0, e0_sd, rref``.

    Least squares of y = Rref * exp(E0 * x) by ``rounds`` damped Gauss-Newton
    steps (E0 moves by ``most_move`` at most), each from the five sums of the
    normal equations. The rows of a window are brought together once; all
    steps run on them where they are, as one expression. ``status`` is
    ``converged``, ``not converged`` (the last step still moved E0 by more than
    ``tolerance`` of it), ``few rows`` or ``narrow range``; only a converged
    window has values.
    """
    keys = list(keys)
    fits = window_fits(night, keys, ts, nee, tair, half_days, step_days, min_rows, min_range, rounds, start, most_move)
    # Written once, so that no later filter works the fit out again.
    out = settle(fits).select(*keys, "window", "n", "range", "f.*")
    status = (
        F.when(F.col("n") < min_rows, "few rows")
        .when(F.col("range") < min_range, "narrow range")
        .when(F.abs("move") < tolerance * F.greatest(F.lit(1.0), F.abs("e0")), "converged")
        .otherwise("not converged")
    )
    variance = F.col("lever") / (F.col("rref") * F.col("rref")) * F.col("left") / F.greatest(F.col("n") - 2, F.lit(1))
    values = {"e0": F.col("e0"), "e0_sd": F.sqrt(F.greatest(variance, F.lit(0.0))), "rref": F.col("rref")}
    return out.select(*keys, "window", "n", status.alias("status"), *[F.when(status == "converged", v).alias(c) for c, v in values.items()])


def series_sensitivity(
    windows: DataFrame, keys: Sequence[str], best: int = 3, lo: float = 30.0, hi: float = 450.0, max_ratio: float = 0.5
) -> DataFrame:
    """One E0 per series: the mean of its most certain plausible windows."""
    # A fit that has not converged is NULL, which lies in no range.
    ok = windows.filter(F.col("e0").between(lo, hi) & (F.col("e0_sd") <= max_ratio * F.col("e0")))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("e0_sd", "window"))
    return ok.withColumn("_r", rank).filter(F.col("_r") <= best).groupBy(*keys).agg(F.avg("e0").alias("e0"))


def reference_respiration(
    night: DataFrame, keys: Sequence[str], ts: str, nee: str, tair: str, half_days: int = 4, step_days: int = 4, min_rows: int = 2
) -> DataFrame:
    """Rref per window with E0 held: a line through the origin, one aggregate."""
    day = tp.epoch_day(ts)
    first = F.ceil((day - half_days) / step_days)
    last = F.floor((day + half_days) / step_days)
    shape = F.exp(F.col("e0") * temperature_term(tair))
    return (
        night.withColumn("_s", shape)
        .withColumn("window", F.explode(F.sequence(first, last)))
        .groupBy(*keys, "window")
        .agg(
            F.try_divide(F.sum(F.col("_s") * F.col(nee)), F.sum(F.col("_s") * F.col("_s"))).alias("rref"),
            F.avg(tp.epoch_seconds(ts)).alias("_centre"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter((F.col("n") >= min_rows) & (F.col("rref") > 0))
    )


def partition_flux(
    df: DataFrame, keys: Sequence[str], ts: str, lat: float | Column, lon: float | Column, zone_hours: float | Column,
    nee: str = "NEE", nee_filled: str = "NEE_f", tair: str = "Tair_f", rg: str = "Rg", rg_night: float = 10.0,
    sensitivity: DataFrame | None = None, seconds: int = sg.SEGMENT_SECONDS,
) -> DataFrame:
    """Add respiration ``Reco`` and uptake ``GPP`` = Reco - NEE.

    Place and clock (degrees, hours from UTC) tell night from day together
    with the measured radiation; columns give each site its own.
    ``sensitivity`` gives a known E0 per series instead of fitting one.
    """
    keys = list(keys)
    dark = (F.col(rg) < rg_night) & (sun_elevation_sine(ts, lat, lon, zone_hours) < 0)
    # Read twice below: written once, four narrow columns of the dark rows.
    night = settle(df.filter(dark & F.col(nee).isNotNull() & F.col(tair).isNotNull()).select(*keys, ts, nee, tair))
    e0 = sensitivity
    if e0 is None:
        e0 = settle(series_sensitivity(sensitivity_windows(night, keys, ts, nee, tair), keys))
    rref = settle(reference_respiration(attach(night, e0, keys, "inner"), keys, ts, nee, tair))
    # Windows and rows on one time line; rows take the line between windows.
    marks = rref.select(
        *keys, tp.ts_from_seconds(F.floor(F.col("_centre"))).alias(ts), F.col("rref").alias("_mark")
    )
    line = df.withColumn("_row", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    seen = sg.bracket(line, keys, ts, "_mark", sg.segment_of(ts, seconds)).filter("_row")
    since, gap = tp.seconds_between("_prev_at", ts), tp.seconds_between("_prev_at", "_next_at")
    between = F.col("_prev") + (F.col("_next") - F.col("_prev")) * since / gap
    # Before the first and after the last window its value is kept.
    local = F.coalesce(between, F.col("_prev"), F.col("_next"))
    return (
        attach(seen.withColumn("_rref", local), e0, keys)
        .withColumn("Reco", F.col("_rref") * F.exp(F.col("e0") * temperature_term(tair)))
        .withColumn("GPP", F.col("Reco") - F.col(nee_filled))
        .drop("_prev_at", "_prev", "_next_at", "_next", "_rref", "e0", "_row", "_mark")
    )
