"""What the optimizer makes of the queries: no pairing off, no unpartitioned windows, pushed filters."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fluxloom.operators import qc
from fluxloom.operators import segments as sg
from fluxloom.operators import windows as wn
from fluxloom.plans.inputs import Tables

QUERIES = entry.queries()
#: Queries that run jobs while being built are planned in the oracle test already.
STAGED = {"gf6_mds_fill", "gf6_mds_own_driver", "gf7_partition_flux", "gf7_partition_known_sensitivity", "forcing_preparation", "forcing_of_stations"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def unpartitioned(plan: str) -> list[str]:
    """Window definitions that begin with an ordering or a frame instead of a partition column.

    Ordering by segment alone is the carry of one single series: a row per 32 days.
    """
    firsts = re.findall(r"windowspecdefinition\(([^,]*)", plan)
    bare = [f for f in firsts if " ASC" in f or " DESC" in f or "specifiedwindowframe" in f]
    return [f for f in bare if not f.startswith(sg.SEGMENT)]


def test_the_window_check_sees_unpartitioned_windows(spark):
    from pyspark.sql import Window

    df = spark.range(3).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert unpartitioned(plan_of(df))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STAGED))
def test_plan(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    assert not unpartitioned(plan)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plan = plan_of(qc.between_days(t.events, "ts", "2024-01-05", "2024-01-20").select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "struct<event_id:bigint,ts:timestamp_ntz>" in plan
    plan = plan_of(qc.in_categories(t.events, "event_type", ["view", "click"]).select("value"))
    assert "In(event_type" in plan


@pytest.mark.parametrize("name", ["a12_precip_totals", "a13_resample"])
def test_calendar_levels_come_from_one_scan(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) == 1


def test_series_windows_are_cut_into_segments(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plan = plan_of(wn.cumulative(t.sensor(), ["sensor"], "ts", "v"))
    # The rows move once, by series and segment; the carry is reduced before it moves.
    moved = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert any("sensor" in m and sg.SEGMENT in m for m in moved)
    assert "partial_sum" in plan and "REPARTITION" not in plan


def test_group_statistics_do_not_shuffle_the_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    df = wn.with_group_stats(t.obs().withColumn("h", F.hour("ts")), ["h"], ["v"])
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("work", ["cumulative", "interpolate", "rolling", "gaps", "position"])
def test_one_series_is_worked_on_by_many_tasks(spark, series, work):
    """All rows belong to one key; every operator still spreads them."""
    from fluxloom.operators import fill as fl
    from fluxloom.operators import grid as gr

    df = series([float(i) if i % 3 else None for i in range(3000)])
    day = 86_400
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = {
            "cumulative": lambda: wn.cumulative(df, ["k"], "ts", "v", seconds=day),
            "interpolate": lambda: fl.interpolate_linear(df, ["k"], "ts", "v", seconds=day),
            "rolling": lambda: sg.keep_core(
                sg.with_halo(sg.with_position(df, ["k"], "ts", 1800), 5, 4, block=64).withColumn(
                    "v", F.avg("v").over(sg.in_block(["k"]).rowsBetween(-5, 4))
                )
            ),
            "gaps": lambda: gr.gap_runs(df, ["k"], "ts", ["v"], seconds=day),
            "position": lambda: sg.global_position(df, ["k"], "ts", seconds=day),
        }[work]()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(sizes) >= 5 and max(sizes) < 0.5 * sum(sizes)


@pytest.mark.parametrize("work", ["cumulative", "interpolate", "gaps", "position"])
def test_staged_series_are_made_once_and_stay_in_place(spark, series, work):
    """A staged table is read in its buckets: rows don't move again, and results are those of the plain table."""
    from fluxloom.operators import fill as fl
    from fluxloom.operators import grid as gr
    from fluxloom.session import release

    made = spark.sparkContext.accumulator(0)
    plain = series([float(i) if i % 7 else None for i in range(3000)])

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    run = {
        "cumulative": lambda df: wn.cumulative(df, ["k"], "ts", "v"),
        "interpolate": lambda df: fl.interpolate_linear(df, ["k"], "ts", "v"),
        "gaps": lambda df: gr.gap_runs(df, ["k"], "ts", ["v"]),
        "position": lambda df: sg.global_position(df, ["k"], "ts"),
    }[work]
    staged = sg.stage(plain.mapInArrow(count, plain.schema), ["k"], "ts")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = run(staged)
        assert sg.SEGMENT not in out.columns
        assert sorted(out.collect()) == sorted(run(plain).select(*out.columns).collect())
        assert made.value == 3000
        moved = [m for m in re.findall(r"Exchange hashpartitioning\(.*", plan_of(out).split("Initial Plan")[0]) if sg.SEGMENT in m]
        # Only the carry moves by series and segment.
        assert len(moved) <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ValueError, match="staged in segments"):
        gr.gap_runs(staged, ["k"], "ts", ["v"], seconds=86_400)
    tables = spark.catalog.listTables()
    release(staged)
    assert len(spark.catalog.listTables()) == len(tables) - 1


@pytest.mark.parametrize("name", ["j1_complete_grid", "w1_gap_runs", "w5_cumulative", "gf1_interpolate_linear"])
def test_series_queries_read_their_table_once(name, spark, sf_dir):
    """What the last job reads are settled rows, the source isn't among them."""
    assert "events.parquet" not in "".join(QUERIES[name](spark, sf_dir).inputFiles())
