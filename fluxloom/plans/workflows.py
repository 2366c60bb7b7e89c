"""Whole processing runs put together from the operators.

Each is one chain of DataFrames from tables to a table; nothing is handed over
by file inside a run, except the stages the gap filling writes for itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.functions import values as vl
from fluxloom.operators import derive as de
from fluxloom.operators import fill as fl
from fluxloom.operators import grid as gr
from fluxloom.operators import joins as jn
from fluxloom.operators import mds, partition, qc
from fluxloom.operators import reshape as rs
from fluxloom.operators import segments as sg
from fluxloom.operators import summarize as sm
from fluxloom.operators.attach import attach, from_rows
from fluxloom.session import settle

# Variables a two-tower record carries, in the order they are filled.
TOWER_VARIABLES = ("NEE", "LE", "H", "Ustar", "Tair", "VPD", "rH", "U", "P", "Rg", "PRECTmms", "FLDS", "radNet", "Tsoil")
# Variables also modelled where observed, to know their uncertainty.
UNCERTAIN = ("NEE", "LE", "H", "Ustar")


def clean_towers(
    towers: DataFrame,
    variables: Sequence[str],
    rules: Mapping[str, Sequence[tuple]],
    station: DataFrame,
    station_value: str,
    fill_variable: str = "Tair",
    fill_after: str = "2016-01-01 00:00:00",
) -> DataFrame:
    """Towers on a common grid, bad stretches removed, temperature filled from a station.

    ``rules`` holds per tower (variable, start, end, lower, upper); the station
    is hourly and brought to the grid by interpolation.
    """
    raw = qc.null_sentinels(towers, cols=variables)
    grid = gr.complete_grid(raw, ["site"], "ts")
    clean = grid
    for site, listed in rules.items():
        clean = qc.range_filter_wide(clean, listed, only=F.col("site") == site)
    hours = station.select(F.lit("station").alias("_s"), "ts", F.col(station_value).alias("_v"))
    steps = grid.select("ts").distinct().select(F.lit("station").alias("_s"), "ts")
    line = fl.interpolate_linear(steps.join(hours, ["_s", "ts"], "left"), ["_s"], "ts", "_v")
    joined = jn.join_fallback(clean, line, ["ts"], "_v", "_fallback")
    guard = F.col("ts") > F.lit(fill_after).cast("timestamp_ntz")
    return fl.fill_from(joined, fill_variable, "_fallback", guard).drop("_fallback")


def clean_stations(
    towers: DataFrame,
    variables: Sequence[str],
    rules: DataFrame,
    readings: DataFrame,
    value: str,
    stations: DataFrame,
    fill_variable: str = "Tair",
    seconds: int = sg.SEGMENT_SECONDS,
) -> DataFrame:
    """``clean_towers`` for the towers of many stations, each with its own span, rules and weather station.

    ``towers`` and ``rules`` name ``station`` and ``site``, ``readings`` the
    ``station``. ``stations`` gives ``fill_after``, from when a station's own
    readings may stand for ``fill_variable``; without it, or without a row
    there, nothing is filled. Towers of a station lie on one grid.
    """
    on = ["station", "ts"]
    raw = settle(qc.null_sentinels(towers, cols=variables))
    grid = settle(gr.complete_grid(raw, ["station", "site"], "ts", common=["station"]))
    clean = qc.range_filter_days(grid, rules, ["station", "site"], variables)
    steps = grid.select(*on).distinct().join(readings.select(*on, F.col(value).alias("_v")), on, "left")
    line = fl.interpolate_linear(sg.stage(steps, ["station"], "ts", seconds), ["station"], "ts", "_v", seconds=seconds)
    joined = attach(jn.join_fallback(clean, line, on, "_v", "_fallback"), stations.select("station", "fill_after"), ["station"])
    guard = F.col("ts") > F.col("fill_after")
    return fl.fill_from(joined, fill_variable, "_fallback", guard).drop("_fallback", "fill_after")


def half_hour_precipitation(
    daily: DataFrame, fine: DataFrame, total: str, weight: str, keys: Sequence[str] = (), step: int = 1800,
    repeats: bool = True,
) -> DataFrame:
    """Corrected daily gauge spread over steps of ``step`` seconds, as a rate per second.

    A day without any fine row gets all its steps at weight 0, so its total is
    spread evenly and not lost. ``keys`` name the gauges of a table that holds
    several. Without ``repeats`` rows of ``fine`` that agree in all columns, as
    where files overlap, count once.
    """
    keys = list(keys)
    if not repeats:
        fine = fine.distinct()
    corrected = qc.null_to_zero(de.month_factor(daily, total, "date"), [total])
    bins = qc.null_to_zero(gr.rebin(fine, keys, "ts", {weight: "sum"}, width=step, null="strict"), [weight])
    bins = bins.withColumn("date", F.to_date("ts"))
    bare = corrected.select(*keys, "date").join(bins.select(*keys, "date").distinct(), [*keys, "date"], "left_anti")
    midnight = F.col("date").cast("timestamp_ntz")
    slots = F.sequence(F.lit(0), F.lit(tp.DAY_SECONDS // step - 1))
    steps = bare.select(*keys, "date", F.explode(slots).alias("_slot")).select(
        *keys, "date", tp.plus_seconds(midnight, F.col("_slot") * step).alias("ts"), F.lit(0.0).alias(weight)
    )
    spread = de.disaggregate(corrected, bins.unionByName(steps), keys, "date", total, weight)
    return spread.select(*keys, "ts", (F.col("amount") / float(step)).alias("PRECTmms"))


def prepare_forcing(
    towers: DataFrame,
    precipitation: DataFrame,
    radiation: DataFrame,
    base: str,
    lat: float,
    lon: float,
    zone_hours: float = -7.0,
    variables: Sequence[str] = TOWER_VARIABLES,
    runoff: DataFrame | None = None,
) -> DataFrame:
    """The forcing of one pair of towers, ``prepare_forcings`` with a single station."""
    one = lambda df: df.withColumn("station", F.lit("both"))
    stations = from_rows(
        towers.sparkSession, [("both", base, float(lat), float(lon), float(zone_hours))],
        "station string, base string, lat double, lon double, zone_hours double",
    )
    out = prepare_forcings(
        one(towers), one(precipitation), one(radiation), stations, variables, None if runoff is None else one(runoff)
    )
    return out.drop("station")


def prepare_forcings(
    towers: DataFrame,
    precipitation: DataFrame,
    radiation: DataFrame,
    stations: DataFrame,
    variables: Sequence[str] = TOWER_VARIABLES,
    runoff: DataFrame | None = None,
) -> DataFrame:
    """Cleaned towers of many stations to model forcing, one row per station, community and step.

    Joins rain and radiation, fills the base tower from the other ones, fills
    the rest by similar conditions, splits the flux, converts units, derives
    the communities' precipitation and moves to UTC without leap days. All
    tables name the ``station``; ``stations`` gives each one's ``base`` tower,
    ``lat``, ``lon`` and ``zone_hours`` (its fixed clock, hours from UTC), and
    towers of a station it does not name are left out. ``runoff`` is stamped
    in UTC, to the minute.
    """
    on = ["station", "ts"]
    joined = jn.join_sources(towers, precipitation, radiation, on=on)
    have = [v for v in variables if v in joined.columns]
    known = attach(joined, stations.select("station", "base"), ["station"], "inner")
    roles = known.withColumn("role", F.when(F.col("site") == F.col("base"), "base").otherwise("fill"))
    merged = fl.fill_two_sources(roles, on, "role", have).select(*on, *have)
    bounded = qc.null_outside(qc.clamp(merged, {"rH": (None, 100), "Rg": (0, 1200)}), {"NEE": (-100, 100)})
    if "VPD" not in have:
        bounded = bounded.withColumn("VPD", vl.vpd_hpa("rH", "Tair"))
        have.append("VPD")
    bounded = settle(bounded)
    long = mds.mds_fill(
        bounded, ["station"], "ts", have, fill_all=[v for v in UNCERTAIN if v in have]
    )
    filled = rs.widen(long, on, "variable", have, ["filled"])
    named = filled.withColumnsRenamed({f"filled_{v}": f"{v}_f" for v in have})
    seen = bounded.select(*on, F.col("NEE").alias("NEE_seen"), F.col("Rg").alias("Rg_seen"))
    placed = attach(named.join(seen, on), stations.select("station", "lat", "lon", "zone_hours"), ["station"])
    split = partition.partition_flux(
        placed, ["station"], "ts", F.col("lat"), F.col("lon"), F.col("zone_hours"), "NEE_seen", "NEE_f", "Tair_f", "Rg_seen"
    )
    out = fl.take_filled(split.withColumnRenamed("GPP", "GPP_f"), ["station", "zone_hours"], "ts")
    out = out.withColumns({"Tair": vl.convert("Tair", "degC", "K"), "P": vl.convert("P", "kPa", "Pa")})
    out = rs.tag(out, ZBOT=2.0)
    by_community = de.apply_regimes(out, "PRECTmms", "Tair", "ts")
    if runoff is not None:
        # On the station's clock, as the rows still are.
        clock = attach(runoff, stations.select("station", "zone_hours"), ["station"], "inner")
        local = tp.plus_seconds("ts", F.round(F.col("zone_hours") * 3600) + 30)
        runoff = clock.withColumn("ts", tp.bin_time(local, 60))
        by_community = de.add_series(
            by_community, runoff, on, "PRECTmms", "QRUNOFF", when=F.col("community") == "WM", missing="zero"
        )
    return de.model_ready(by_community, "ts", F.col("zone_hours")).drop("zone_hours")


def soil_half_hours(
    sensors: DataFrame, plots: DataFrame, depths: Sequence[str], letters: Sequence[str] = ("a", "b", "c")
) -> DataFrame:
    """Ten-minute soil sensors to half-hour values per plot and community.

    Flagged values and moisture of frozen soil are dropped before averaging;
    of the replicate probes the first known one is taken; ratios become percent.
    """
    temps = {f"soiltemp_{d}": f"flag_soiltemp_{d}" for d in depths}
    moist = {f"soilmoisture_{x}_{d}": f"flag_soilmoisture_{x}_{d}" for d in depths for x in letters}
    df = qc.null_flagged(sensors, {**temps, **moist}, bad=None)
    for d in depths:
        for x in letters:
            df = qc.null_where(df, f"soilmoisture_{x}_{d}", F.col(f"soiltemp_{d}") > 0)
    means = gr.rebin(df, ["plot"], "ts", {c: "mean" for c in [*temps, *moist]})
    known = jn.lookup(means, plots, ["plot"]).filter(F.col("veg_com").isNotNull() & (F.col("veg_com") != "SA"))
    for d in depths:
        cols = [f"soilmoisture_{x}_{d}" for x in letters]
        known = fl.fill_priority(known, cols, letters, f"soilmoisture_{d}", f"letter_{d}").withColumn(
            f"soilmoisture_{d}", vl.convert(f"soilmoisture_{d}", "ratio", "%")
        )
    keep = ["plot", "veg_com", "ts"]
    for d in depths:
        keep += [f"soiltemp_{d}", f"soilmoisture_{d}", f"letter_{d}"]
    return known.select(*keep)


def daily_observations(soil: DataFrame, flux: DataFrame, snow: DataFrame, soil_cols: Sequence[str]) -> DataFrame:
    """Day-of-year summary of soil, carbon uptake and snow per community, side by side."""
    keys = ["doy", "veg_com"]
    ground = sm.doy_climatology(soil, list(soil_cols), ["veg_com"])
    uptake = sm.doy_climatology(flux, ["GPP"], ["veg_com"])
    depth = sm.community_stats(snow.withColumn("doy", F.dayofyear("date")), keys, "snow_depth").drop("n")
    return jn.align_summaries(jn.align_summaries(ground, uptake, keys), depth, keys)


def simulation_summaries(
    history: DataFrame, single: Sequence[str], layered: Sequence[str], layers: Mapping[str, int], lower: int = 5, default: int = 2
) -> dict[str, DataFrame]:
    """Diurnal, daily and annual summaries of a simulation at the sensors' depths.

    Model stamps are UTC and are moved to the tower's clock. Each community is
    compared at its own upper layer.
    """
    stamped = history.withColumn("ts", tp.shift_zone(tp.parse_mcdate("mcdate", "mcsec")))
    deep = {f"{c}_lower": F.get(F.col(c), F.lit(lower - 1)) for c in layered}
    upper = de.pick_layer(stamped.withColumns(deep), "veg_com", list(layered), layers, default)
    both = upper.withColumnsRenamed({c: f"{c}_upper" for c in layered})
    cols = [*single, *[f"{c}_{side}" for c in layered for side in ("upper", "lower")]]
    return sm.summarize_by_time(both, cols, ["veg_com"], "ts")


def compare_diurnal(obs: DataFrame, sim: DataFrame, metrics: Sequence[str], on: Sequence[str] = ("veg_com", "season", "hour")) -> DataFrame:
    """Observed and simulated cycles in long form with bands of one deviation."""

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = rs.melt_pairs(df, list(on), list(metrics), "_houravg", "_hoursd")
        return rs.tag(pairs, ObsSim=name)

    return rs.band(rs.stack_rows(long(obs, "Obs"), long(sim, "Sim")), "mean", "sd")
