"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of threads.
Every query's whole result is computed and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fluxloom.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "o1_gap_summary",
    "j1_complete_grid",
    "w1_gap_runs",
    "w2_group_stats_on_rows",
    "w3_rolling_mean",
    "w5_cumulative",
    "w6_shift",
    "gf1_interpolate_linear",
    "gf3_fill_two_sources",
    "gf6_mds_fill",
    "gf7_partition_flux",
    "q1_range_filter",
    "q2_null_flagged",
    "a1_diurnal_seasonal",
    "a2_doy_climatology",
    "a6_rebin_sum_strict",
    "a10_group_stats",
    "a13_resample",
    "a16_diel",
    "a19_correlation",
    "a20_linear_fit",
    "a21_slice_change",
    "a25_year_doy_overlay",
    "d1_regimes_by_month",
    "d2_disaggregate",
    "j2_join_sources",
    "j8_nearest_cell",
    "j9_case_diff",
    "j12_densify",
    "k3_write_forcing",
    "s1_read_units_table",
    "s6_read_history",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    QUERIES["p9_season"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
