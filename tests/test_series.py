"""Series operators on hand-made and random input, small segments and blocks."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fluxloom.operators import attach as at
from fluxloom.operators import fill as fl
from fluxloom.operators import grid as gr
from fluxloom.operators import joins as jn
from fluxloom.operators import qc
from fluxloom.operators import segments as sg
from fluxloom.operators import windows as wn

from .conftest import stamp

HOUR2 = 7200


def values(df, col="v", order=("k", "ts")):
    return [r[col] for r in df.orderBy(*order).collect()]


def brute_runs(vals):
    out, n = [], 0
    for v in [*vals, 1.0]:
        if v is None:
            n += 1
        elif n:
            out.append(n)
            n = 0
    return out


@pytest.mark.parametrize("seed", range(3))
def test_gap_runs_over_segment_borders(series, seed):
    rnd = random.Random(seed)
    vals = [None if rnd.random() < 0.6 else 1.0 for _ in range(60)]
    if seed == 2:
        vals = [None] * 60
    runs = gr.gap_runs(series(vals), ["k"], "ts", ["v"], seconds=HOUR2).orderBy("start").collect()
    assert [r.n for r in runs] == brute_runs(vals)
    assert sum(r.n for r in runs) == sum(v is None for v in vals)
    for r in runs:
        assert (r.end - r.start).total_seconds() == (r.n - 1) * 1800


def test_a_stretch_without_rows_does_not_break_a_run(spark):
    first = stamp("2024-01-01 00:00:00")
    rows = [("a", first + dt.timedelta(hours=h), None) for h in (0, 1, 30, 31)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    (run,) = gr.gap_runs(df, ["k"], "ts", ["v"], seconds=HOUR2).collect()
    assert run.n == 4


def test_gap_summary_merges_gaps_of_equal_length(series):
    df = series([None, 1, None, 1, None, None, 1])
    out = gr.gap_summary(gr.gap_runs(df, ["k"], "ts", ["v"]), ["k"]).collect()
    assert [(r.ndays, r.min, r.max) for r in out] == [
        (0.04, stamp("2024-02-29 00:00:00"), stamp("2024-02-29 00:30:00")),
        (0.02, stamp("2024-02-28 22:00:00"), stamp("2024-02-28 23:00:00")),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_interpolation_reproduces_a_line_inside_and_leaves_the_ends(series, seed):
    rnd = random.Random(seed)
    line = [2.0 * i + 1 for i in range(50)]
    vals = [None if rnd.random() < 0.7 else v for v in line]
    got = values(fl.interpolate_linear(series(vals), ["k"], "ts", "v", seconds=HOUR2))
    known = [i for i, v in enumerate(vals) if v is not None]
    for i, v in enumerate(got):
        if known and known[0] <= i <= known[-1]:
            assert v == pytest.approx(line[i])
        else:
            assert v is None


def test_cumulative_counts_missing_as_zero(series):
    got = values(wn.cumulative(series([1, None, 2, 3, None, 4, 5, 6]), ["k"], "ts", "v", seconds=HOUR2))
    assert got == [1, 1, 3, 6, 6, 10, 15, 21]


@pytest.mark.parametrize("step", [1800, None])
@pytest.mark.parametrize("n", [-1, 1, 3, -5])
def test_shift(series, step, n):
    vals = [float(i) for i in range(20)]
    got = values(wn.shift(series(vals), ["k"], "ts", ["v"], n, step=step))
    want = [vals[i - n] if 0 <= i - n < len(vals) else None for i in range(len(vals))]
    assert got == want


def test_even_centred_window_needs_ten_known_values(series):
    got = values(wn.rolling_mean(series(range(12)), ["k"], "ts", "v", step=1800))
    assert [i for i, v in enumerate(got) if v is not None] == [5, 6, 7]
    assert got[5] == pytest.approx(4.5)
    hole = list(range(12))
    hole[0] = None
    assert values(wn.rolling_mean(series(hole), ["k"], "ts", "v", step=1800))[5] is None


def test_halo_blocks_give_the_same_as_one_block(series, monkeypatch):
    vals = [float(i * i % 17) for i in range(40)]
    whole = values(wn.rolling_mean(series(vals), ["k"], "ts", "v", n=7, step=1800))
    real = sg.with_halo
    monkeypatch.setattr(sg, "with_halo", lambda df, before, after: real(df, before, after, block=3))
    assert values(wn.rolling_mean(series(vals), ["k"], "ts", "v", n=7, step=1800)) == whole
    assert values(wn.rolling_mean(series(vals), ["k"], "ts", "v", n=7)) == whole


def test_global_position_over_segments(series):
    placed = sg.global_position(series(range(30)), ["k"], "ts", out="p", seconds=HOUR2)
    assert values(placed, "p") == list(range(30))
    assert values(wn.time_slice(series(range(30)), ["k"], "ts", 5, 8)) == [5.0, 6.0, 7.0]


def test_circular_shift(spark):
    df = spark.createDataFrame([("a", h / 2, float(h)) for h in range(6)], "k string, slot double, v double")
    got = [r.v for r in wn.circular_shift(df, ["k"], "slot", ["v"], -2).orderBy("slot").collect()]
    assert got == [2.0, 3.0, 4.0, 5.0, 0.0, 1.0]


def test_grid_is_complete_and_unique(spark, series):
    df = series([1, None, 3, 4], start="2024-02-28 23:00:00")
    full = gr.complete_grid(df, ["k"], "ts", inward=False)
    assert full.count() == 2 * 48 and qc.check_unique(full, ["k", "ts"]).isEmpty()
    first, last = full.agg(F.min("ts"), F.max("ts")).first()
    assert (first, last) == (stamp("2024-02-28 00:30:00"), stamp("2024-03-01 00:00:00"))
    assert full.filter("v is not null").count() == 3
    starts = gr.complete_grid(df, ["k"], "ts", inward=False, label="start").agg(F.min("ts"), F.max("ts")).first()
    assert tuple(starts) == (stamp("2024-02-28 00:00:00"), stamp("2024-02-29 23:30:00"))


def test_common_grid_covers_every_series(series):
    df = series([1, 2], key="a").unionByName(series([1], start="2024-03-02 00:00:00", key="b"))
    full = gr.complete_grid(df, ["k"], "ts", inward=False).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in full} == {"a": 3 * 48, "b": 3 * 48}


def test_strict_bin_is_missing_when_any_value_is(series):
    df = series([1, None, 2, 3], start="2024-01-01 00:00:00", step_minutes=15)
    assert values(gr.rebin(df, ["k"], "ts", {"v": "sum"}, null="strict")) == [None, 5.0]
    assert values(gr.rebin(df, ["k"], "ts", {"v": "sum"})) == [1.0, 5.0]


def test_rebinning_in_two_steps_is_the_same(series):
    df = series(range(24), start="2024-01-01 00:00:00", step_minutes=5)
    once = values(gr.rebin(df, ["k"], "ts", {"v": "sum"}, width=3600))
    half = gr.rebin(df, ["k"], "ts", {"v": "sum"}, width=1800)
    assert values(gr.rebin(half, ["k"], "ts", {"v": "sum"}, width=3600)) == once


def test_disaggregation_keeps_totals_and_short_days(spark):
    from fluxloom.operators.derive import disaggregate

    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    daily = spark.createDataFrame(list(zip(days, [0.0, 6.0, 8.0, None])), "date date, total double")
    rows = []
    for i, d in enumerate(days):
        for s in range(3 if i == 1 else 4):
            rows.append((d, s, 0.0 if i == 1 else (None if s == 0 else float(s))))
    fine = spark.createDataFrame(rows, "date date, slot int, w double")
    out = disaggregate(daily, fine, [], "date", "total", "w")
    notes = {str(r.date): r.note for r in out.collect()}
    assert notes == {"2024-01-01": 0, "2024-01-02": 1, "2024-01-03": 2, "2024-01-04": None}
    assert {r.amount for r in out.filter("date = '2024-01-02'").collect()} == {2.0}
    assert qc.check_conservation(out, daily, ["date"], "amount", "total").isEmpty()


def test_era_boundary_is_dropped(spark):
    rows = [(stamp(f"2019-01-01 {h:02d}:00:00") - dt.timedelta(hours=1), 1.0, 2.0, None, 4.0) for h in (0, 1, 2)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, a double, p1 double, p2 double, p3 double")
    got = fl.era_select(df, "ts", "2019-01-01 00:00:00", "a", ["p1", "p2", "p3"], "v").orderBy("ts").collect()
    assert [r.v for r in got] == [1.0, 3.0]


def test_two_source_flags_partition_the_rows(spark):
    rows = [(1, "base", 1.0), (1, "fill", 9.0), (2, "base", None), (2, "fill", 5.0), (3, "base", None), (3, "fill", None)]
    df = spark.createDataFrame(rows, "t int, role string, v double")
    got = fl.fill_two_sources(df, ["t"], "role", ["v"]).orderBy("t").collect()
    assert [(r.v, r.v_flag) for r in got] == [(1.0, "n"), (5.0, "s"), (None, "m")]


def test_nearest_of_two_equal_distances_is_the_larger(spark):
    places = [5.0, -50.0, 99.0, 10.0, None] + [5.0] * 20
    points = spark.createDataFrame(list(enumerate(places)), "id int, lat double")
    cells = spark.createDataFrame([(0.0,), (10.0,), (20.0,)], "lat double")
    got = {r.id: r.near_lat for r in jn.nearest_cell(points, cells, ["lat"]).collect()}
    assert got == {0: 10.0, 1: 0.0, 2: 20.0, 3: 10.0, 4: None, **{i: 10.0 for i in range(5, 25)}}


def test_places_close_together_spread_over_all_ranges(spark):
    """Every point within one unit of the axis: still as many ranges as tasks, none with a quarter of the places."""
    points = spark.range(4000).select("id", (F.col("id") / 4000).alias("lat"))
    sizes = [r["count"] for r in jn.in_ranges(points, ["lat"]).groupBy(jn.RANGE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    cells = spark.createDataFrame([(-5.0,), (0.3,), (0.7,), (44.0,)], "lat double")
    got = jn.nearest_cell(points, cells, ["lat"])
    assert got.count() == 4000 and got.where(F.col("near_lat") != F.when(F.col("lat") < 0.5, 0.3).otherwise(0.7)).isEmpty()


def test_hot_keys_stay_where_they_are(spark):
    """A thousand equal rows meet a side too large to broadcast in the tasks that hold them."""
    big = spark.range(0, 3000, 1, 16).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v"))
    small = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    assert len(at.hot_keys(big, ["k"])) == 1
    got = at.attach(big, small, ["k"], max_rows=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, at.attach(big, small, ["k"]).collect()))
    tasks = got.filter("k = 7").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 8 and sum(r["count"] for r in tasks) == 2000


def test_a_broadcast_side_is_bounded_by_its_bytes(spark):
    small = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit(1), F.lit(2)).alias("a"))
    assert at.is_small(small) and at.is_small(small, max_bytes=120_000) and not at.is_small(small, max_bytes=100_000)


def test_small_side_beyond_the_bound_gives_the_same_rows(spark):
    big = spark.range(200).select((F.col("id") % 3).alias("k"), "id")
    small = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    a = at.attach(big, small, ["k"])
    b = at.attach(big, small, ["k"], max_rows=2)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert "Broadcast" in a._jdf.queryExecution().toString()
    nulls = big.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    side = small.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    for bound in (100, 2):
        got = at.attach(nulls, side, ["k"], max_rows=bound, null_safe=True)
        assert got.filter("x is null").isEmpty() and got.count() == 200


def test_densify_is_the_whole_product(spark):
    df = spark.createDataFrame([(i, f"c{i % 7}", 1.0) for i in range(40)], "a int, b string, v double")
    out = jn.densify(df, "a", "b", rows=3, cols=2)
    assert out.count() == 40 * 7 and out.filter("v is not null").count() == 40
    assert qc.check_unique(out, ["a", "b"]).isEmpty()


def test_repeated_dimension_keys_fan_out(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, c string")
    assert jn.lookup(df, dim, ["k"]).count() == 3
    assert qc.check_unique(dim, ["k"]).count() == 1


def test_rules_from_a_table_on_wide_columns(spark):
    """As the long form does it: open ends, overlaps, a far end day, a NULL station, rules of other columns."""
    rows = [(s, dt.datetime(2024, 1, d, 12), float(d), float(-d)) for s in ("a", "b", None) for d in range(1, 11)]
    wide = spark.createDataFrame(rows, "station string, ts timestamp_ntz, u double, v double")
    rules = spark.createDataFrame(
        [
            ("a", "u", dt.date(2024, 1, 2), dt.date(9999, 12, 31), None, 5.0),
            ("a", "u", dt.date(2023, 12, 1), dt.date(2024, 1, 5), 3.0, None),
            (None, "v", dt.date(2024, 1, 3), dt.date(2024, 1, 6), -4.0, None),
            ("b", "w", dt.date(2024, 1, 1), dt.date(2024, 1, 9), 0.0, 0.0),
            ("b", "u", dt.date(2024, 1, 4), dt.date(2024, 1, 6), None, None),
        ],
        "station string, variable string, start date, end date, lower double, upper double",
    )
    got = qc.range_filter_days(wide, rules, ["station"], ["u", "v"])
    assert got.columns == wide.columns
    long = wide.unpivot(["station", "ts"], ["u", "v"], "variable", "value").withColumnRenamed("station", "site")
    want = qc.range_filter(long, rules.withColumnRenamed("station", "site"))
    key = lambda r: tuple(str(x) for x in r)
    flat = got.unpivot(["station", "ts"], ["u", "v"], "variable", "value")
    assert sorted(map(key, flat.collect())) == sorted(map(key, want.select("site", "ts", "variable", "value").collect()))
    assert {r.ts.day for r in got.where("station = 'a' and u is null").collect()} == {1, 2, 6, 7, 8, 9, 10}


def test_grid_of_groups_with_their_own_span(spark):
    at = dt.datetime
    rows = [("x", "p", at(2024, 1, 1), 1.0), ("x", "p", at(2024, 1, 3), 2.0), ("x", "q", at(2024, 1, 2), 3.0), ("x", "q", at(2024, 1, 4), 4.0), ("y", "p", at(2024, 5, 1), 5.0), ("y", "p", at(2024, 5, 2), 6.0)]
    df = spark.createDataFrame(rows, "station string, site string, ts timestamp_ntz, v double")
    got = gr.complete_grid(df, ["station", "site"], "ts", common=["station"])
    spans = {(r[0], r[1]): (r[2], r[3], r[4]) for r in got.groupBy("station", "site").agg(F.min("ts"), F.max("ts"), F.count("*")).collect()}
    whole = (at(2024, 1, 1, 0, 30), at(2024, 1, 4), 144)
    assert spans == {("x", "p"): whole, ("x", "q"): whole, ("y", "p"): (at(2024, 5, 1, 0, 30), at(2024, 5, 2), 48)}
