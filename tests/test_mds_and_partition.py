"""Gap filling by similar conditions against a direct search; flux partitioning on a known model."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxloom.operators import mds, partition


def weather(days, step, seed):
    rnd = np.random.default_rng(seed)
    n = days * 86400 // step
    hours = np.arange(n) * step / 3600.0
    rg = np.clip(600 * np.sin((hours % 24 - 6) / 12 * math.pi), 0, None) + rnd.normal(0, 15, n)
    ta = 10 + 8 * np.sin((hours % 24 - 9) / 12 * math.pi) + 5 * np.sin(hours / 24 / 20) + rnd.normal(0, 1, n)
    vpd = np.clip(ta - 5 + rnd.normal(0, 3, n), 0, None)
    y = 0.01 * rg + ta + rnd.normal(0, 1, n)
    return rg, vpd, ta, y


def holes(x, rnd, share):
    return [None if rnd.random() < share else float(v) for v in x]


def direct_search(rg, vpd, ta, y, per_day, near):
    """The published procedure, gap by gap."""
    n, out = len(y), {}
    for i in range(n):
        if y[i] is not None:
            continue
        for method, days in mds.STAGES:
            for w in days:
                picks = []
                for j in range(n):
                    if y[j] is None:
                        continue
                    d = j - i
                    if method == mds.DIURNAL:
                        k = round(d / per_day)
                        ok = abs(k) <= w and abs(d - k * per_day) <= near
                    else:
                        ok = abs(d) <= w * per_day and None not in (rg[i], rg[j])
                        ok = ok and abs(rg[j] - rg[i]) < max(min(50.0, rg[i]), 20.0)
                        if ok and method == mds.LOOKUP3:
                            ok = None not in (vpd[i], vpd[j], ta[i], ta[j])
                            ok = ok and abs(vpd[j] - vpd[i]) < 5 and abs(ta[j] - ta[i]) < 2.5
                    if ok:
                        picks.append(y[j])
                if len(picks) >= 2:
                    length = 2 * w + 1 if method == mds.DIURNAL else 2 * w
                    out[i] = (method, length, len(picks), np.mean(picks), np.std(picks, ddof=1))
                    break
            if i in out:
                break
    return out


@pytest.fixture(scope="module")
def gappy():
    step, days = 10800, 75
    rnd = np.random.default_rng(5)
    rg, vpd, ta, y = weather(days, step, 4)
    rg, vpd, ta, y = holes(rg, rnd, 0.15), holes(vpd, rnd, 0.15), holes(ta, rnd, 0.15), holes(y, rnd, 0.3)
    for i in range(15 * 8, 60 * 8):
        y[i] = None
    return step, rg, vpd, ta, y


def test_every_gap_takes_the_donors_of_the_direct_search(spark, gappy):
    step, rg, vpd, ta, y = gappy
    first = dt.datetime(2023, 12, 1)
    rows = [
        ("a", first + dt.timedelta(seconds=step * i), *vals) for i, vals in enumerate(zip(rg, vpd, ta, y))
    ]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, Rg double, VPD double, Tair double, NEE double")
    got = {r.ts: r for r in mds.mds_fill(df, ["site"], "ts", ["NEE"], step=step).collect()}
    want = direct_search(rg, vpd, ta, y, 8, 0)
    assert len(got) == len(y)
    methods = set()
    for i, v in enumerate(y):
        r = got[first + dt.timedelta(seconds=step * i)]
        if v is not None:
            assert (r.filled, r.fqc, r.method) == (v, 0, None)
        elif i in want:
            method, length, n, mean, sd = want[i]
            methods.add((method, length > 14))
            assert (r.method, r.window, r.n) == (method, length, n)
            assert r.filled == pytest.approx(mean) and r.sd == pytest.approx(sd) and r.fqc in (1, 2, 3)
        else:
            assert r.filled is None and r.fqc is None
    assert {(mds.LOOKUP3, False), (mds.LOOKUP3, True), (mds.LOOKUP1, False), (mds.LOOKUP1, True), (mds.DIURNAL, False)} <= methods


def test_fill_all_models_observed_rows_too(spark, gappy):
    step, rg, vpd, ta, y = gappy
    first = dt.datetime(2023, 12, 1)
    rows = [("a", first + dt.timedelta(seconds=step * i), *v) for i, v in enumerate(zip(rg, vpd, ta, y))][:160]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, Rg double, VPD double, Tair double, NEE double")
    out = mds.mds_fill(df, ["site"], "ts", ["NEE"], step=step, fill_all=["NEE"])
    assert out.filter("value is not null and model is not null and filled = value and fqc = 0").count() > 50


def test_respiration_model_is_recovered(spark):
    """Night data made from known E0 and Rref gives them back, also where Rref drifts."""
    step, days = 1800, 40
    rg, _, ta, _ = weather(days, step, 9)
    first = dt.datetime(2024, 6, 1)
    rows = []
    for i, t in enumerate(ta):
        ts = first + dt.timedelta(seconds=step * i)
        term = 1 / (partition.T_REF - partition.T_ZERO) - 1 / (t - partition.T_ZERO)
        rref = 2.0 + 0.02 * i / 48
        reco = rref * math.exp(200.0 * term)
        light = max(0.0, math.sin((ts.hour + ts.minute / 60 - 6) / 12 * math.pi)) * 600
        rows.append(("a", ts, light, float(t), reco - (0.02 * light), reco))
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, Rg double, Tair_f double, NEE double, truth double")
    out = partition.partition_flux(df.withColumn("NEE_f", F.col("NEE")), ["site"], "ts", 40.0, -105.0, -7.0)
    stats = out.agg(
        F.max(F.abs(F.col("Reco") - F.col("truth")) / F.col("truth")).alias("worst"),
        F.max(F.abs(F.col("Reco") - F.col("GPP") - F.col("NEE_f"))).alias("balance"),
        F.count("GPP").alias("n"),
    ).first()
    assert stats.n == len(rows) and stats.balance < 1e-9 and stats.worst < 0.05


def test_fit_that_has_not_converged_gives_nothing(spark):
    first = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(30):
        t = 5.0 + i / 2
        term = 1 / (partition.T_REF - partition.T_ZERO) - 1 / (t - partition.T_ZERO)
        rows.append(("a", first + dt.timedelta(minutes=30 * i), t, 2.0 * math.exp(200.0 * term) * (1 + 0.01 * (i % 3))))
        rows.append(("flat", first + dt.timedelta(minutes=30 * i), 7.0, 2.0))
        rows.append(("zero", first + dt.timedelta(minutes=30 * i), t, 0.0))
    rows += [("few", first, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, Tair double, NEE double")
    fit = lambda rounds: partition.sensitivity_windows(df, ["site"], "ts", "NEE", "Tair", rounds=rounds).collect()
    once = {r.status for r in fit(1) if r.site == "a"}
    assert once == {"not converged"} and all(r.e0 is r.e0_sd is r.rref is None for r in fit(1))
    got = {(r.site, r.status) for r in fit(30)}
    assert got == {("a", "converged"), ("flat", "narrow range"), ("zero", "not converged"), ("few", "few rows")}
    x = np.array([1 / (partition.T_REF - partition.T_ZERO) - 1 / (r[2] - partition.T_ZERO) for r in rows if r[0] == "a"])
    y = np.array([r[3] for r in rows if r[0] == "a"])
    for r in fit(30):
        if r.site == "a":
            s = np.exp(r.e0 * x)
            gradient = np.column_stack([r.rref * x * s, s])
            left = y - r.rref * s
            assert np.abs(gradient.T @ left).max() < 1e-6
            cov = np.linalg.inv(gradient.T @ gradient) * (left @ left) / (len(y) - 2)
            assert r.e0_sd == pytest.approx(math.sqrt(cov[0, 0]), rel=1e-6)


def test_fit_runs_without_python(spark):
    df = spark.createDataFrame([], "site string, ts timestamp_ntz, Tair double, NEE double")
    plan = partition.window_fits(df, ["site"], "ts", "NEE", "Tair", 7, 5, 6, 5.0, 30, 100.0, 100.0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_sun_is_up_at_noon_and_down_at_midnight(spark):
    df = spark.sql("select timestamp_ntz'2024-06-21 12:00:00' as ts union all select timestamp_ntz'2024-06-21 00:00:00'")
    noon, night = [r[0] for r in df.select(partition.sun_elevation_sine("ts", 40.0, -105.5, -7.0)).collect()]
    assert noon == pytest.approx(math.sin(math.radians(90 - 40.0 + 23.44)), abs=0.01) and night < -0.3


def test_clock_time_lines_pair_no_gap_with_a_donor(spark):
    """Half a year without any value: the clock-time lines join moments only, a few a gap, none of their keys hot."""
    step, per_day = 10800, 8
    rows = [("a", "y", day * per_day + clock, float(day + clock)) for day in range(200) for clock in range(per_day)]
    donors = spark.createDataFrame(rows, "site string, variable string, _pos long, _y double")
    gaps = [("a", "y", day * per_day + clock) for day in range(200, 382) for clock in range(per_day)]
    todo = spark.createDataFrame(gaps, "site string, variable string, _pos long")
    days = tuple(range(7, 211, 7))
    got = mds._diurnal_found(todo, donors, ["site", "variable"], days, per_day, 3600 // step).collect()
    want = {}
    for _, _, pos in gaps:
        day, clock = divmod(pos, per_day)
        half = next(d for d in days if day - d <= 198)
        picks = [x + clock for x in range(day - half, 200) if x >= 0]
        want[pos] = half, len(picks), np.mean(picks), np.std(picks, ddof=1)
    assert {r._pos for r in got} == set(want)
    for r in got:
        half, n, mean, sd = want[r._pos]
        assert (r._half, r._n) == (half, n) and r._mean == pytest.approx(mean) and r._sd == pytest.approx(sd)
    # Nodes of windows as wide as these: far fewer than their days, and no node asked for by an eighth of all.
    first, end = F.col("day") - F.col("half"), F.col("day") + F.col("half") + 1
    windows = spark.createDataFrame([(r._pos // per_day, r._pos % per_day, r._half) for r in got], "day long, clock long, half int")
    asked = windows.select("clock", F.explode(mds._aligned(first, end, 8)).alias("x")).select("clock", "x.*")
    total, most = asked.count(), max(r["count"] for r in asked.groupBy("clock", "level", "node").count().collect())
    assert total <= 18 * len(got) and most < total / 8
