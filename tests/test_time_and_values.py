"""Edge cases of calendar, unit and missing-value handling."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.functions import values as vl
from fluxloom.operators import derive as de
from fluxloom.operators import qc
from fluxloom.operators import reshape as rs
from fluxloom.operators import summarize as sm

from .conftest import stamp


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).collect()[0].asDict()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "text, hour, date, doy",
    [
        ("2024-01-01 00:00:00", 24.0, dt.date(2023, 12, 31), 365),
        ("2024-02-29 00:30:00", 0.5, dt.date(2024, 2, 29), 60),
        ("2025-01-01 00:00:00", 24.0, dt.date(2024, 12, 31), 366),
    ],
)
def test_midnight_closes_the_day_before(spark, text, hour, date, doy):
    r = one(spark, h=tp.end_label_hour(ts(text)), d=tp.end_label_date(ts(text)))
    assert (r["h"], r["d"]) == (hour, date)
    back = one(spark, t=tp.ts_from_ydh(F.lit(date.year), F.lit(doy), F.lit(hour)))
    assert back["t"] == stamp(text)


def test_end_bins_and_start_bins(spark):
    r = one(spark, s=tp.bin_time(ts("2024-01-01 00:29:59")), e=tp.bin_time(ts("2024-01-01 00:29:59"), label="end"))
    assert r == {"s": stamp("2024-01-01 00:00:00"), "e": stamp("2024-01-01 00:30:00")}
    assert one(spark, e=tp.bin_time(ts("2024-01-01 00:30:00"), label="end"))["e"] == stamp("2024-01-01 01:00:00")


def test_seconds_before_1970_are_floored(spark):
    r = one(spark, s=tp.epoch_seconds(ts("1969-12-31 23:59:59.5")), m=tp.epoch_micros(ts("1969-12-31 23:59:59.5")))
    assert r == {"s": -1, "m": -500_000}
    assert one(spark, t=tp.ts_from_micros(F.lit(-500_000)))["t"] == stamp("1969-12-31 23:59:59.500000")


def test_results_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Denver")
    try:
        # 02:30 on the day clocks go forward exists on the tower's fixed clock.
        t = ts("2024-03-10 02:30:00")
        r = one(
            spark, s=tp.epoch_seconds(t), b=tp.bin_time(t), d=tp.floor_day(t), z=tp.shift_zone(t), h=tp.decimal_hour(t)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["s"] == int(dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp())
    assert r["b"] == stamp("2024-03-10 02:30:00") and r["h"] == 2.5
    assert r["d"] == stamp("2024-03-10 00:00:00") and r["z"] == stamp("2024-03-09 19:30:00")


def test_noleap_calendar(spark):
    def doy(d):
        return one(spark, n=tp.noleap_doy(F.lit(d).cast("date")))["n"]

    assert [doy(d) for d in ("2024-02-28", "2024-02-29", "2024-03-01", "2024-12-31", "2023-03-01", "1900-03-01")] == [
        59, None, 60, 365, 60, 60,
    ]
    assert one(spark, t=tp.noleap_to_ts(F.lit(2024), F.lit(60), F.lit(1800)))["t"] == stamp("2024-03-01 00:30:00")
    assert one(spark, y=tp.year_plus_frac(ts("2023-07-02 12:00:00")))["y"] == pytest.approx(2023.5)


def test_quarter_year_and_dummy_dates(spark):
    def q(d):
        return str(one(spark, q=tp.quarter_from_december(F.lit(d).cast("date")))["q"])

    assert [q(d) for d in ("2024-01-31", "2024-02-29", "2023-12-01", "2024-03-01", "2024-11-30")] == [
        "2023-12-01", "2023-12-01", "2023-12-01", "2024-03-01", "2024-09-01",
    ]
    assert one(spark, y=tp.year_span(F.lit(2008), F.lit(2010)))["y"] == "2008 | 2009 | 2010"
    assert str(one(spark, d=tp.dummy_date(F.lit(1)))["d"]) == "2000-01-02"


def test_packed_times(spark):
    r = one(
        spark, h=tp.parse_hhmm(F.lit("35")), c=tp.hhmm_clock(F.lit("1205")), d=tp.parse_mcdate(F.lit(80101), F.lit(1800)),
        bad=tp.parse_hhmm(F.lit("xx")),
    )
    assert r["h"] == pytest.approx(35 / 60) and r["c"] == "12:05:00" and r["bad"] is None
    assert r["d"] == stamp("0008-01-01 00:30:00")


def test_missing_values_never_slip_through(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1.0), (2, -9999.0, 0.0), (3, float("nan"), -1.0), (4, 7.0, None)], "id int, v double, temp double"
    )
    clean = qc.null_sentinels(df, cols=["v"])
    assert [r.v for r in clean.orderBy("id").collect()] == [5.0, None, None, 7.0]
    kept = qc.null_where(df, "v", F.col("temp") > 0).orderBy("id").collect()
    assert [r.v for r in kept] == [5.0, None, None, None]
    clamped = qc.clamp(clean, {"v": (6, 6.5)}).orderBy("id").collect()
    assert [r.v for r in clamped] == [6.0, None, None, 6.5]
    assert clean.agg(F.avg("v")).first()[0] == 6.0


def test_single_row_deviation_is_missing_and_population_is_zero(spark, series):
    df = series([3.0])
    assert sm.annual_summary(df, ["v"], ["k"]).first().v_yearsd is None
    assert sm.diel(df, "v", ["k"]).first().v_std == 0.0


def test_all_missing_group_has_no_peak(spark, series):
    assert sm.annual_peak(series([None, None]), "v", ["k"]).first().max_v is None


def test_regimes_at_the_freezing_point(spark):
    df = spark.createDataFrame(
        [(stamp("2024-04-01 00:00:00"), 273.15, 1.0), (stamp("2024-04-01 00:30:00"), 273.14, 1.0),
         (stamp("2024-06-01 00:00:00"), 273.14, 1.0), (stamp("2024-06-01 00:30:00"), None, 1.0)],
        "ts timestamp_ntz, t double, p double",
    )
    out = {(str(r.ts)[5:16], r.community): r.p for r in de.apply_regimes(df, "p", "t", "ts").collect()}
    assert out["04-01 00:00", "FF"] == 1.0 and out["04-01 00:30", "FF"] == 0.25
    assert out["06-01 00:00", "DM"] == 0.1 and out["06-01 00:00", "SB"] == 2.0 and out["06-01 00:00", "WM"] == 0.75
    assert out["06-01 00:30", "MM"] == 1.0 and out["06-01 00:30", "WM"] is None


def test_summer_means_june_to_september_unless_asked_otherwise(spark):
    rows = [("a", dt.datetime(2020, m, 1), float(m)) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, r double")
    good = sm.precip_totals(df, "r", ["k"], "ts", "summer").first().total
    odd = sm.precip_totals(df, "r", ["k"], "ts", "summer", summer_bug=True).first().total
    assert good == pytest.approx(7.5 * 86400 * 122) and odd == pytest.approx(11 * 86400 * 122)


def test_unit_texts(spark):
    texts = ["gC/m^2/s", "unitless", "yr", "gC13/m^2", "kgC gC", "logC", "gC-2"]
    df = spark.createDataFrame([(t,) for t in texts], "u string")
    assert [r.c for r in df.select(vl.clean_units("u").alias("c")).collect()] == [
        "g/m^2/s", "1", "common_year", "g13/m^2", "kg g", "logC", "g-2",
    ]


def test_vapour_pressure_deficit(spark):
    assert one(spark, v=vl.vpd_hpa(F.lit(100.0), F.lit(20.0)))["v"] == 0.0
    assert one(spark, v=vl.vpd_hpa(F.lit(0.0), F.lit(20.0)))["v"] == pytest.approx(23.4, abs=0.1)


def test_range_rules(spark):
    rows = [("s", "T", stamp(f"2024-01-{d:02d} 12:00:00"), v) for d, v in ((1, 99.0), (2, 99.0), (3, None), (4, 99.0))]
    df = spark.createDataFrame(rows, "site string, variable string, ts timestamp_ntz, value double")

    def run(lower, upper):
        rules = spark.createDataFrame(
            [("s", "T", dt.date(2024, 1, 1), dt.date(2024, 1, 4), lower, upper)], qc.RULE_SCHEMA
        )
        return [r.value for r in qc.range_filter(df, rules).orderBy("ts").collect()]

    # Both end days stay; a rule without cutoffs does nothing; one side at a time.
    assert run(None, 50.0) == [99.0, None, None, 99.0]
    assert run(None, None) == [99.0, 99.0, None, 99.0]
    assert run(100.0, None) == [99.0, None, None, 99.0]


def test_p_value_of_a_correlation(spark):
    t = spark.createDataFrame([(2.0, 10), (None, 3), (0.0, 5), (-1.0, 1), (0.01, 1000), (40.0, 2)], "t double, df long")
    got = [r.p for r in sm.add_p_value(t).collect()]
    assert got[0] == pytest.approx(0.07338803, abs=1e-8) and got[1] is None and got[2] == 1
    assert got[3] == pytest.approx(0.5, abs=1e-10) and got[5] == pytest.approx(1 - 40 / 1602**0.5, rel=1e-9)
    assert got[4] == pytest.approx(0.99202, abs=1e-5)


def test_correlation_of_a_constant_is_unknown(spark):
    rows = [("flat", 1.0, float(i)) for i in range(9)] + [("up", float(i), float(i * i)) for i in range(9)]
    got = {r.k: r for r in sm.add_p_value(sm.corr_test(spark.createDataFrame(rows, "k string, x double, y double"), "x", "y", ["k"])).collect()}
    assert got["flat"].r is None and got["flat"].t is None and got["flat"].p is None and got["flat"].n == 9
    # Deviations of i and i * i over 0 … 8: products 480, squares 60 and 4148.
    assert got["up"].r == pytest.approx(480 / (60 * 4148) ** 0.5) and got["up"].p < 1e-4


def test_more_levels_than_declared_end_the_job(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "TSOI array<double>")
    with pytest.raises(Exception, match="has 3 levels"):
        rs.flatten_levels(df, ["TSOI"], 2).collect()


def test_many_overlapping_rules_equal_a_direct_test(spark):
    rng = random.Random(4)
    first = dt.date(2023, 12, 20)
    rules = []
    for _ in range(400):
        a = first + dt.timedelta(days=rng.randrange(60))
        limits = [rng.choice([None, rng.uniform(0, 40)]), rng.choice([None, rng.uniform(60, 100)])]
        rules.append((rng.choice(["a", "b"]), rng.choice(["x", "y"]), a, a + dt.timedelta(days=rng.choice([0, 1, 2, 3, 9, 40])), *limits))
    rules += [("a", "x", None, first, 0.0, 1.0), ("a", "x", first, None, 0.0, 1.0), (None, "x", first, first + dt.timedelta(days=90), None, 0.0)]
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", "y"]), dt.datetime(2023, 12, 10) + dt.timedelta(hours=rng.randrange(24 * 90)), rng.choice([None, rng.uniform(-10, 110)])) for i in range(600)]

    def hit(site, variable, ts, v):
        for s, n, start, end, lower, upper in rules:
            if None not in (v, start, end, site) and (s, n) == (site, variable) and start < ts.date() < end and (lower is not None and v < lower or upper is not None and v > upper):
                return True
        return False

    df = spark.createDataFrame(rows, "id int, site string, variable string, ts timestamp_ntz, value double")
    got = {r.id: r.value for r in qc.range_filter(df, spark.createDataFrame(rules, qc.RULE_SCHEMA)).collect()}
    assert got == {i: None if hit(*rest) else rest[-1] for i, *rest in rows}
    stretches = qc.rule_stretches(spark.createDataFrame(rules, qc.RULE_SCHEMA)).where("site = 'a' and variable = 'x'").orderBy("first").collect()
    assert all(a["last"] < b["first"] for a, b in zip(stretches, stretches[1:], strict=False))
    assert qc.range_filter(df, spark.createDataFrame([], qc.RULE_SCHEMA)).count() == len(rows)


def test_dimensions_are_checked_at_every_depth(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0], [[1, 2], [3, 4]]), (2, [1.0], [[1, 2], [3]]), (3, None, None), (4, [], [None, [1, 2]]), (5, [1.0, 2.0], [[1, 2]])],
        "id int, flat array<double>, nested array<array<int>>",
    )
    got = sorted(map(tuple, qc.check_dims(df, ["id"], {"flat": [2], "nested": [2, 2]}).collect()))
    assert got == [(2, "flat", 1, 2, 1), (2, "nested", 2, 2, 1), (4, "flat", 1, 2, 0), (5, "nested", 1, 2, 1)]
    assert sorted(map(tuple, qc.check_dims(df, ["id"], {"flat": [2, 9]}).where("dimension = 2").collect())) == [(i, "flat", 2, 9, -1) for i in (1, 2, 4, 5)]


def test_too_many_levels_end_the_job_whichever_is_read(spark):
    df = spark.createDataFrame([([1.0] * 10,)], "v array<double>")
    with pytest.raises(Exception, match="10 levels"):
        rs.flatten_levels(df, ["v"], 8).select("v_8").collect()
