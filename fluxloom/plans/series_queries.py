"""Registered queries: windows, order, reshaping, filling, derivation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import derive as de
from fluxloom.operators import fill as fl
from fluxloom.operators import grid as gr
from fluxloom.operators import mds, partition
from fluxloom.operators import qc
from fluxloom.operators import reshape as rs
from fluxloom.operators import summarize as sm
from fluxloom.operators import windows as wn
from fluxloom.operators.attach import from_rows
from fluxloom.plans.inputs import KINDS, mds_sql, noleap_sql, season_sql, sun_sql
from fluxloom.plans.registry import query
from fluxloom.sources.sinks import forcing_table

#: Segment length for these one-month series: several segments per series.
FIVE_DAYS = 5 * 86_400

# --- windows ---------------------------------------------------------------

_RUNS = (
    "SELECT sensor, min(ts) AS start, max(ts) AS \"end\", count(*) AS n, count(*)/48e0 AS ndays FROM "
    "(SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY ts) - row_number() OVER (PARTITION BY sensor, v IS NULL ORDER BY ts) AS g FROM grid) "
    "WHERE v IS NULL GROUP BY sensor, g"
)


def _runs(t):
    return gr.gap_runs(t.segments(FIVE_DAYS), ["sensor"], "ts", ["v"], seconds=FIVE_DAYS)


@query("w1_gap_runs", "sensor:s start:t end:t n:i ndays:6", _RUNS, "grid")
def _(t):
    return _runs(t)


@query(
    "o1_gap_summary",
    "sensor:s ndays:2 min:t max:t years:s",
    'SELECT sensor, round(ndays,2) AS ndays, min(start) AS "min", max("end") AS "max", '
    "array_to_string(generate_series(year(min(start)),year(max(\"end\"))),' | ') AS years "
    f"FROM ({_RUNS}) GROUP BY sensor, ndays",
    "grid",
)
def _(t):
    return gr.gap_summary(_runs(t), ["sensor"])


@query(
    "o4_gaps_over",
    "sensor:s start:t end:t n:i",
    f"SELECT sensor, start, \"end\", n FROM ({_RUNS}) WHERE ndays >= 0.0625 AND year(start)<=2024 AND year(\"end\")>=2024",
    "grid",
)
def _(t):
    return gr.gaps_over(_runs(t), 0.0625, [2024])


@query(
    "w2_group_stats_on_rows",
    "id:i v:6 v_mean:6 v_sd:6",
    f"SELECT id, v, avg(v) OVER w AS v_mean, stddev_samp(v) OVER w AS v_sd FROM (SELECT *, {season_sql()} AS season, hour(ts) AS h FROM obs) "
    "WINDOW w AS (PARTITION BY season, h)",
    "obs",
)
def _(t):
    df = t.obs().withColumns({"season": tp.season(F.month("ts")), "h": F.hour("ts")})
    return wn.with_group_stats(df, ["season", "h"], ["v"])


_ROLL = "CASE WHEN count({c}) OVER w = {n} THEN avg({c}) OVER w END"


@query(
    "w3_rolling_mean",
    "sensor:s ts:t v:6",
    f"SELECT sensor, ts, {_ROLL.format(c='v', n=10)} AS v FROM (SELECT sensor, ts, coalesce(v, CASE WHEN minute(ts)=0 THEN 1e0 END) AS v FROM grid) "
    "WINDOW w AS (PARTITION BY sensor ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)",
    "grid",
)
def _(t):
    series = t.grid().withColumn("v", F.coalesce("v", F.when(F.minute("ts") == 0, 1.0)))
    return wn.rolling_mean(series, ["sensor"], "ts", "v", step=1800)


@query(
    "w4_trailing_window",
    "veg:s date:d v:6",
    f"SELECT veg, date, {_ROLL.format(c='v', n=12)} AS v FROM daily WINDOW w AS (PARTITION BY veg ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)",
    "daily",
)
def _(t):
    # Days without an observation are absent, so rows are counted, not days.
    return wn.rolling_mean(t.daily_ts(), ["veg"], "ts", "v", n=12, center=False).withColumn("date", F.to_date("ts"))


@query(
    "w5_cumulative",
    "sensor:s ts:t total:4",
    "SELECT sensor, ts, sum(coalesce(v,0)*1800e0/1000e0) OVER (PARTITION BY sensor ORDER BY ts) AS total FROM grid",
    "grid",
)
def _(t):
    return wn.cumulative(t.segments(FIVE_DAYS), ["sensor"], "ts", "v", 1800.0 / 1000.0, "total", seconds=FIVE_DAYS)


@query(
    "w6_shift",
    "sensor:s ts:t v:6 back:6",
    "SELECT sensor, ts, lead(v) OVER (PARTITION BY sensor ORDER BY ts) AS v, lag(v,3) OVER (PARTITION BY sensor ORDER BY ts) AS back FROM grid",
    "grid",
)
def _(t):
    g = t.grid().withColumn("back", F.col("v"))
    return wn.shift(wn.shift(g, ["sensor"], "ts", ["v"], -1, step=1800), ["sensor"], "ts", ["back"], 3, step=1800)


@query(
    "w6_shift_by_rows",
    "sensor:s ts:t v:6",
    "SELECT sensor, ts, lead(v,2) OVER (PARTITION BY sensor ORDER BY ts) AS v FROM sensor",
    "sensor",
)
def _(t):
    return wn.shift(t.sensor(), ["sensor"], "ts", ["v"], -2)


@query(
    "w7_circular_shift",
    "case:s hourmin:3 y:6",
    'SELECT a."case", a.h AS hourmin, b.y FROM d a JOIN d b ON a."case"=b."case" AND b.r=(a.r+12)%a.n',
    "d",
)
def _(t):
    cycle = t.sim().groupBy("case", tp.hourmin("ts").alias("hourmin")).agg(F.avg("y").alias("y"))
    return wn.circular_shift(cycle, ["case"], "hourmin", ["y"], -12)


@query(
    "w8_degree_sum",
    "veg:s doy:i gdd:4",
    f"SELECT veg, doy, sum(CASE WHEN m>0 THEN m ELSE 0 END) OVER (PARTITION BY veg ORDER BY doy) AS gdd FROM (SELECT veg, doy, avg(w) AS m FROM "
    f"(SELECT *, {noleap_sql('ts')} AS doy FROM obs) WHERE doy IS NOT NULL GROUP BY ALL)",
    "obs",
)
def _(t):
    return sm.gdd(t.obs(), "w", ["veg"], "ts")


@query(
    "w9_cumulative_by_year",
    "veg:s year:i date:d v:4",
    "SELECT veg, year(date) AS year, date, sum(v) OVER (PARTITION BY veg, year(date) ORDER BY date) AS v FROM daily",
    "daily",
)
def _(t):
    days = t.daily_ts().withColumn("year", F.year("ts"))
    return wn.cumulative(days, ["veg", "year"], "ts", "v").withColumn("date", F.to_date("ts"))


@query(
    "o2_distinct",
    "season:s hour:i v_mean:6",
    f"SELECT {season_sql()} AS season, hour(ts) AS hour, avg(v) AS v_mean FROM obs GROUP BY ALL",
    "obs",
)
def _(t):
    df = t.obs().withColumns({"season": tp.season(F.month("ts")), "hour": F.hour("ts")})
    return wn.with_group_stats(df, ["season", "hour"], ["v"]).select("season", "hour", F.round("v_mean", 9).alias("v_mean")).distinct()


@query(
    "o3_first_last",
    "sensor:s first_ts:t last_ts:t first_v:6 last_v:6",
    "SELECT sensor, min(ts) AS first_ts, max(ts) AS last_ts, arg_min(v,ts) AS first_v, arg_max(v,ts) AS last_v FROM sensor GROUP BY sensor",
    "sensor",
)
def _(t):
    return wn.first_last(t.sensor(), ["sensor"], "ts", ["v"])


@query(
    "o6_time_slice",
    "sensor:s ts:t v:6",
    "SELECT sensor, ts, v FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY ts) AS rn FROM sensor) WHERE rn>300 AND rn<=700",
    "sensor",
)
def _(t):
    return wn.time_slice(t.sensor(), ["sensor"], "ts", 300, 700)


# --- reshape ---------------------------------------------------------------


@query(
    "u1_stack_rows",
    "site:s ts:t v:6 a:6",
    "SELECT 'East' AS site, ts, \"view\" AS v, CAST(NULL AS DOUBLE) AS a FROM towers WHERE site='East' UNION ALL "
    "SELECT 'West', ts, \"view\", click FROM towers WHERE site='West'",
    "towers",
)
def _(t):
    sides = rs.split_by(t.towers(), "site", ["East", "West"])
    return rs.stack_rows(
        sides["East"].select("site", "ts", F.col("view").alias("v")),
        sides["West"].select("site", "ts", F.col("view").alias("v"), F.col("click").alias("a")),
    )


@query(
    "u2_concat_cases",
    "run:s ts:t x:6",
    "SELECT CASE \"case\" WHEN 'A' THEN 'base' WHEN 'R' THEN 'future' ELSE 'nitrogen' END AS run, ts, x FROM sim",
    "sim",
)
def _(t):
    sides = rs.split_by(t.sim(), "case", ["A", "R", "N"])
    return rs.concat_cases({"base": sides["A"], "future": sides["R"], "nitrogen": sides["N"]}, "run").select("run", "ts", "x")


@query(
    "u3_melt",
    "site:s ts:t variable:s value:6",
    " UNION ALL ".join(f"SELECT site, ts, '{k}' AS variable, \"{k}\" AS value FROM tgrid" for k in KINDS),
    "tgrid",
)
def _(t):
    return rs.melt(t.tower_grid(), ["site", "ts"], KINDS)


@query(
    "u4_melt_pairs",
    "case:s metric:s mean:6 sd:6",
    " UNION ALL ".join(
        f"SELECT \"case\", '{m}' AS metric, avg({m}) AS mean, stddev_samp({m}) AS sd FROM sim GROUP BY ALL" for m in "xyz"
    ),
    "sim",
)
def _(t):
    wide = t.sim().groupBy("case").agg(*sm.mean_sd(["x", "y", "z"], "_avg", "_sd"))
    return rs.melt_pairs(wide, ["case"], ["x", "y", "z"])


@query(
    "u5_widen",
    "ts:t view_East:6 view_West:6 click_East:6 click_West:6",
    "SELECT ts, max(\"view\") FILTER (WHERE site='East') AS \"view_East\", max(\"view\") FILTER (WHERE site='West') AS \"view_West\", "
    "max(click) FILTER (WHERE site='East') AS \"click_East\", max(click) FILTER (WHERE site='West') AS \"click_West\" FROM tgrid GROUP BY ts",
    "tgrid",
)
def _(t):
    return rs.widen(t.tower_grid(), ["ts"], "site", ["East", "West"], ["view", "click"])


@query(
    "u6_split",
    "site:s n:i v:6",
    "SELECT site, count(*) AS n, avg(\"view\") AS v FROM tgrid GROUP BY site",
    "tgrid",
)
def _(t):
    sides = rs.split_by(t.tower_grid(), "site", ["East", "West"])
    east, west = (df.groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.avg("view").alias("v")) for df in sides.values())
    return east.unionByName(west)


@query(
    "u7_cyclic_point",
    "lat:i lon:6 v:6",
    "SELECT lat, lon, v FROM (SELECT s_nationkey AS lat, s_suppkey*7%360*1e0 AS lon, s_acctbal AS v FROM supplier) UNION ALL "
    "SELECT lat, lon+360, v FROM (SELECT s_nationkey AS lat, s_suppkey*7%360*1e0 AS lon, s_acctbal AS v, "
    "min(s_suppkey*7%360*1e0) OVER (PARTITION BY s_nationkey) AS f FROM supplier) WHERE lon=f",
)
def _(t):
    cells = t.supplier.select(
        F.col("s_nationkey").alias("lat"), (F.col("s_suppkey") * 7 % 360).cast("double").alias("lon"),
        F.col("s_acctbal").alias("v"),
    )
    return rs.cyclic_point(cells, ["lat"], "lon")


@query(
    "s7_flatten_levels",
    "vec_id:i " + " ".join(f"embedding_{j}:6" for j in range(1, 65)),
    "SELECT vec_id, " + ", ".join(f"embedding[{j}] AS embedding_{j}" for j in range(1, 65)) + " FROM embeddings",
)
def _(t):
    return rs.flatten_levels(t.embeddings, ["embedding"], 64)


@query(
    "s8_drop_short_variables",
    "variable:s n:i",
    "SELECT event_type AS variable, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= (SELECT count(*)/5 FROM events)",
)
def _(t):
    long = t.events.select(F.col("event_type").alias("variable"), "ts")
    n = t.events.count() / 5
    return rs.drop_short_variables(long, "variable", n).groupBy("variable").agg(F.count(F.lit(1)).alias("n"))


@query("s9_select_existing", "event_id:i value:6 absent:s", "SELECT event_id, value, 'T99' AS absent FROM events")
def _(t):
    df, absent = rs.select_existing(t.events, ["event_id", "value", "T99"])
    return df.withColumn("absent", F.lit(",".join(absent)))


# --- filling ---------------------------------------------------------------


@query(
    "gf1_interpolate_linear",
    "sensor:s ts:t v:6",
    "SELECT sensor, ts, CASE WHEN v IS NOT NULL THEN v ELSE v0+(v1-v0)*(epoch(ts)-epoch(t0))/(epoch(t1)-epoch(t0)) END AS v FROM (SELECT *, "
    "last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0, "
    "first_value(v IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER f AS t1 FROM grid "
    "WINDOW b AS (PARTITION BY sensor ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "f AS (PARTITION BY sensor ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))",
    "grid",
)
def _(t):
    return fl.interpolate_linear(t.segments(FIVE_DAYS), ["sensor"], "ts", "v", seconds=FIVE_DAYS)


@query(
    "gf2_fill_from",
    "site:s ts:t click:6",
    "SELECT g.site, g.ts, CASE WHEN g.click IS NULL AND g.ts>TIMESTAMP '2024-01-16' THEN s.v ELSE g.click END AS click FROM tgrid g "
    "LEFT JOIN sensor s ON s.ts=g.ts AND s.sensor='error'",
    "tgrid",
)
def _(t):
    from fluxloom.operators.joins import join_fallback

    station = t.sensor().filter(F.col("sensor") == "error")
    joined = join_fallback(t.tower_grid(), station, ["ts"], "v", "other")
    return fl.fill_from(joined, "click", "other", F.col("ts") > F.lit("2024-01-16").cast("timestamp_ntz"))


@query(
    "gf3_fill_two_sources",
    "ts:t " + " ".join(f"{k}:6 {k}_flag:s" for k in KINDS),
    "SELECT b.ts, "
    + ", ".join(
        f'coalesce(b."{k}",f."{k}") AS "{k}", CASE WHEN b."{k}" IS NOT NULL THEN \'n\' WHEN f."{k}" IS NOT NULL THEN \'s\' ELSE \'m\' END AS {k}_flag'
        for k in KINDS
    )
    + " FROM tgrid b JOIN tgrid f ON b.ts=f.ts AND b.site='East' AND f.site='West'",
    "tgrid",
)
def _(t):
    roles = t.tower_grid().withColumn("role", F.when(F.col("site") == "East", "base").otherwise("fill"))
    return fl.fill_two_sources(roles, ["ts"], "role", KINDS)


@query(
    "gf4_fill_priority",
    "site:s ts:t v:6 letter:s",
    "SELECT site, ts, coalesce(\"view\",click,signup) AS v, CASE WHEN \"view\" IS NOT NULL THEN 'a' WHEN click IS NOT NULL THEN 'b' "
    "WHEN signup IS NOT NULL THEN 'c' END AS letter FROM tgrid",
    "tgrid",
)
def _(t):
    return fl.fill_priority(t.tower_grid(), ["view", "click", "signup"], ["a", "b", "c"], "v", "letter")


@query(
    "gf5_era_select",
    "site:s ts:t v:6",
    "SELECT site, ts, CASE WHEN ts<TIMESTAMP '2024-01-15' THEN \"view\" ELSE list_avg(list_filter([click,signup,error], lambda x: x IS NOT NULL)) END AS v "
    "FROM tgrid WHERE ts<>TIMESTAMP '2024-01-15'",
    "tgrid",
)
def _(t):
    return fl.era_select(t.tower_grid(), "ts", "2024-01-15", "view", ["click", "signup", "error"], "v")


def _weather(t):
    """Tower grid with radiation, moisture deficit and temperature of usual size."""
    return t.tower_grid().select(
        "site", "ts", (F.col("view") * 4).alias("Rg"), (F.col("signup") / 10).alias("VPD"),
        (F.col("click") / 10).alias("Tair"), "purchase", "error",
    )


@query(
    "gf6_mds_fill",
    "site:s variable:s ts:t value:6 filled:6 model:6 method:i window:i n:i sd:6 fqc:i",
    mds_sql("mdsbase", "'error'"),
    "mdsbase",
)
def _(t):
    return mds.mds_fill(_weather(t), ["site"], "ts", ["purchase", "error"], fill_all=["error"])


@query(
    "gf6_mds_own_driver",
    "site:s ts:t filled:6 method:i window:i fqc:i",
    mds_sql("mdsown"),
    "mdsown",
)
def _(t):
    return mds.mds_fill(_weather(t).withColumn("T", F.col("Tair")), ["site"], "ts", ["T"])


def _exchange(t):
    """Respiration of known sensitivity, disturbed by another sensor."""
    term = partition.temperature_term(F.col("click") / 10)
    df = t.tower_grid().select(
        "site", "ts", (F.col("view") * 2 - 80).alias("Rg"), F.coalesce(F.col("click") / 10, F.lit(5.0)).alias("Tair_f"),
        (2.0 * F.exp(200.0 * term) * (1 + (F.col("purchase") - 50) / 500)).alias("NEE"),
    )
    return fl.interpolate_linear(df, ["site"], "ts", "NEE", "NEE_f")


@query(
    "gf7_partition_flux",
    "site:s ts:t Reco:6 GPP:6 nee:6",
    "SELECT site, ts, reco AS \"Reco\", reco-nee_f AS \"GPP\", nee_f AS nee FROM (SELECT r.site, r.ts, r.nee_f, exp(s.e0*(1e0/61.02e0-1e0/(r.ta+46.02e0)))*"
    "CASE WHEN a.ts IS NULL THEN b.rref WHEN b.ts IS NULL THEN a.rref ELSE a.rref+(b.rref-a.rref)*(epoch(r.ts)-epoch(a.ts))/(epoch(b.ts)-epoch(a.ts)) END AS reco "
    "FROM exchange r LEFT JOIN e0s s ON s.site=r.site ASOF LEFT JOIN rrefsfit a ON r.site=a.site AND r.ts>=a.ts ASOF LEFT JOIN rrefsfit b ON r.site=b.site AND r.ts<b.ts)",
    "exchange e0s rrefsfit",
)
def _(t):
    return partition.partition_flux(_exchange(t), ["site"], "ts", 40.0, -105.5, -7.0).withColumn("nee", F.col("NEE_f"))


@query(
    "gf7_sensitivity_windows",
    "site:s window:i e0:4 e0_sd:4 rref:6 n:i",
    'SELECT site, k AS "window", e0, sd AS e0_sd, rref, n FROM fits',
    "fits",
)
def _(t):
    rows = _exchange(t)
    dark = (F.col("Rg") < 10) & (partition.sun_elevation_sine("ts", 40.0, -105.5, -7.0) < 0)
    night = qc.complete_pairs(rows.filter(dark), "Tair_f", "NEE")
    return partition.sensitivity_windows(night, ["site"], "ts", "NEE", "Tair_f").filter("status = 'converged'")


@query(
    "gf7_partition_known_sensitivity",
    "site:s ts:t Reco:6 GPP:6",
    "SELECT site, ts, reco AS \"Reco\", reco-nee_f AS \"GPP\" FROM (SELECT r.site, r.ts, r.nee_f, exp(200e0*(1e0/61.02e0-1e0/(r.ta+46.02e0)))*"
    "CASE WHEN a.ts IS NULL THEN b.rref WHEN b.ts IS NULL THEN a.rref ELSE a.rref+(b.rref-a.rref)*(epoch(r.ts)-epoch(a.ts))/(epoch(b.ts)-epoch(a.ts)) END AS reco "
    "FROM exchange r ASOF LEFT JOIN rrefs a ON r.site=a.site AND r.ts>=a.ts ASOF LEFT JOIN rrefs b ON r.site=b.site AND r.ts<b.ts)",
    "rrefs",
)
def _(t):
    e0 = from_rows(t.spark, [("East", 200.0), ("West", 200.0)], "site string, e0 double")
    return partition.partition_flux(_exchange(t), ["site"], "ts", 40.0, -105.5, -7.0, sensitivity=e0)


@query(
    "gf7_night_rows",
    "site:s ts:t light:b sine:6",
    f"SELECT site, ts, sine >= 0 AS light, sine FROM (SELECT site, ts, {sun_sql()} AS sine FROM tgrid)",
    "tgrid",
)
def _(t):
    sine = partition.sun_elevation_sine("ts", 40.0, -105.5, -7.0)
    return t.tower_grid().select("site", "ts", sine.alias("sine")).withColumn("light", F.col("sine") >= 0)


@query(
    "gf7_reference_respiration",
    "site:s window:i rref:6 n:i",
    'SELECT site, k AS "window", sum(s*nee)/sum(s*s) AS rref, count(*) AS n FROM (SELECT site, ts, purchase/25e0 AS nee, '
    "exp(120e0*(1e0/(15e0+46.02e0)-1e0/(click/5e0+46.02e0))) AS s, CAST(epoch(ts) AS BIGINT)//86400 AS d FROM tgrid WHERE click IS NOT NULL AND purchase IS NOT NULL) x "
    "JOIN (SELECT unnest(generate_series(4900,5000)) AS k) w ON x.d BETWEEN 4*k-4 AND 4*k+4 GROUP BY ALL HAVING count(*)>=2 AND sum(s*nee)>0",
    "tgrid",
)
def _(t):
    rows = t.tower_grid().select(
        "site", "ts", (F.col("click") / 5).alias("Tair"), (F.col("purchase") / 25).alias("NEE"), F.lit(120.0).alias("e0")
    )
    known = qc.complete_pairs(rows, "Tair", "NEE")
    return partition.reference_respiration(known, ["site"], "ts", "NEE", "Tair")


@query(
    "gf8_take_filled",
    "site:s ts:t view:6 click:6",
    'SELECT site, ts - INTERVAL 30 MINUTE AS ts, "view", click FROM tgrid',
    "tgrid",
)
def _(t):
    g = t.tower_grid().withColumnsRenamed({"view": "view_f", "click": "click_f"})
    return fl.take_filled(g, ["site"], "ts")


# --- derivation ------------------------------------------------------------


@query(
    "d1_precipitation_regimes",
    "ts:t site:s community:s p_observed:6 p:6",
    "SELECT site, ts, c.community, p AS p_observed, CASE WHEN c.community='MM' THEN p WHEN ta>=273.15 THEN p WHEN ta<273.15 THEN p*"
    "CASE c.community WHEN 'WM' THEN 0.75e0 WHEN 'SB' THEN 2e0 ELSE CASE WHEN month(ts) IN (3,4,5) THEN 0.25e0 ELSE 0.1e0 END END END AS p "
    "FROM (SELECT site, ts, \"view\" AS p, click-50+273.15e0 AS ta FROM tgrid), (VALUES ('FF'),('DM'),('MM'),('WM'),('SB')) c(community)",
    "tgrid",
)
def _(t):
    g = t.tower_grid().select("site", "ts", F.col("view").alias("p"), (F.col("click") - 50 + 273.15).alias("Tair"))
    return de.apply_regimes(g, "p", "Tair", "ts")


@query(
    "d1_regimes_by_month",
    "id:i community:s p:6",
    "SELECT id, c.community, CASE WHEN c.community='MM' THEN v WHEN w>=0 THEN v ELSE v*CASE c.community WHEN 'WM' THEN 0.75e0 WHEN 'SB' THEN 2e0 "
    "ELSE CASE WHEN month(ts) IN (3,4,5) THEN 0.25e0 ELSE 0.1e0 END END END AS p FROM obs, (VALUES ('FF'),('DM'),('MM'),('WM'),('SB')) c(community)",
    "obs",
)
def _(t):
    return de.apply_regimes(t.obs().withColumnRenamed("v", "p"), "p", "w", "ts", threshold=0.0)


_DISAGG = (
    "SELECT f.date, f.ts, CASE WHEN d.total=0 THEN 0 WHEN s.w=0 THEN d.total/s.n ELSE d.total*f.w/s.w END AS amount, "
    "CASE WHEN d.total=0 THEN 0 WHEN s.w=0 THEN 1 ELSE 2 END AS note FROM fine f JOIN "
    "(SELECT CAST(ts AS DATE) AS date, CASE WHEN day(ts)%6=0 THEN 0 ELSE sum(value) END AS total FROM events WHERE event_type='purchase' GROUP BY CAST(ts AS DATE), day(ts)%6=0) d USING (date) "
    "JOIN (SELECT date, sum(w) AS w, count(*) AS n FROM fine GROUP BY date) s USING (date)"
)


def _fine(t):
    """Half-hour weights; every fifth day has none."""
    heavy = F.when((F.col("event_type") == "view") & (F.col("value") > 30), F.col("value"))
    bins = gr.rebin(t.events.select("ts", heavy.alias("w")), [], "ts", {"w": "sum"})
    weight = F.when(F.day("ts") % 5 != 0, F.coalesce("w", F.lit(0.0))).otherwise(F.lit(0.0))
    return bins.select(F.to_date("ts").alias("date"), "ts", weight.alias("w"))


def _daily_totals(t):
    bought = t.events.filter(F.col("event_type") == "purchase")
    total = F.when(F.day("date") % 6 == 0, 0.0).otherwise(F.col("value"))
    return sm.daily_total(bought, ["value"], []).select("date", total.alias("total"))


def _spread(t):
    return de.disaggregate(_daily_totals(t), _fine(t), [], "date", "total", "w")


@query("d2_disaggregate", "date:d ts:t amount:6 note:i", _DISAGG, "fine")
def _(t):
    return _spread(t)


@query(
    "a24_note_counts",
    "note:i month:i days:i",
    f"SELECT note, month(date) AS month, count(DISTINCT date) AS days FROM ({_DISAGG}) GROUP BY ALL",
    "fine",
)
def _(t):
    return sm.note_counts(_spread(t))


@query(
    "d3_month_factor",
    "id:i v:6",
    "SELECT id, CASE WHEN month(ts) IN (10,11,12,1,2,3,4,5) THEN v*0.39e0 ELSE v END AS v FROM obs",
    "obs",
)
def _(t):
    return de.month_factor(t.obs(), "v", "ts")


@query(
    "d4_add_series",
    "site:s ts:t strict:6 lenient:6",
    "SELECT g.site, g.ts, g.\"view\"+s.v AS strict, g.\"view\"+coalesce(s.v,0) AS lenient FROM tgrid g LEFT JOIN sensor s ON s.ts=g.ts AND s.sensor='error'",
    "tgrid",
)
def _(t):
    runoff = t.sensor().filter("sensor = 'error'").select("ts", F.col("v").alias("q"))
    g = t.tower_grid().select("site", "ts", F.col("view").alias("strict"), F.col("view").alias("lenient"))
    return de.add_series(de.add_series(g, runoff, ["ts"], "strict", "q"), runoff, ["ts"], "lenient", "q", missing="zero")


@query(
    "d5_select_regime",
    "id:i p:6",
    "SELECT id, CASE WHEN w>=0 THEN v ELSE v*0.75e0 END AS p FROM obs",
    "obs",
)
def _(t):
    every = de.apply_regimes(t.obs().withColumnRenamed("v", "p"), "p", "w", "ts", threshold=0.0)
    return de.select_regime(every, "WM", "p")


@query(
    "d6_model_ready",
    "id:i ts:t year_mon:s zbot:2",
    "SELECT id, ts + INTERVAL 7 HOUR AS ts, strftime(ts + INTERVAL 7 HOUR,'%Y-%m') AS year_mon, 2e0 AS zbot FROM obs "
    "WHERE strftime(ts + INTERVAL 7 HOUR,'%m-%d')<>'02-29'",
    "obs",
)
def _(t):
    return rs.tag(de.model_ready(t.obs(), "ts"), zbot=2.0)


@query(
    "d7_constant_height",
    "site:s ts:t ZBOT:2",
    'SELECT site, ts, 2e0 AS "ZBOT" FROM tgrid',
    "tgrid",
)
def _(t):
    return rs.tag(t.tower_grid(), ZBOT=2.0)


@query(
    "d8_pick_layer",
    "vec_id:i label:i embedding:6",
    "SELECT vec_id, label, CAST(CASE WHEN label=1 THEN embedding[3] ELSE embedding[2] END AS DOUBLE) AS embedding FROM embeddings",
)
def _(t):
    return de.pick_layer(t.embeddings, "label", ["embedding"], {1: 3}, 2)


@query(
    "d9_parameter_edits",
    "param:s pft:i value:6",
    "SELECT param, pft, CASE WHEN pft=3 AND param='price' THEN 1.5e0 WHEN pft=4 AND param='size' THEN value*2 ELSE value END AS value FROM "
    "(SELECT 'price' AS param, p_partkey AS pft, p_retailprice AS value FROM part UNION ALL SELECT 'size', p_partkey, p_size*1e0 FROM part) WHERE pft NOT IN (7,8) "
    "UNION ALL SELECT param, k, value FROM (SELECT 'price' AS param, p_partkey AS pft, p_retailprice AS value FROM part UNION ALL "
    "SELECT 'size', p_partkey, p_size*1e0 FROM part), (VALUES (7),(8)) c(k) WHERE pft=5",
)
def _(t):
    wide = t.part.select(
        F.col("p_partkey").alias("pft"), F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size")
    )
    params = rs.melt(wide, ["pft"], ["price", "size"], "param")
    edits = from_rows(
        t.spark, [("price", 3, 1.5, None), ("size", 4, None, 2.0)], "param string, pft bigint, set double, scale double"
    )
    return de.clone_category(de.apply_overrides(params, edits, ["param", "pft"]), "pft", 5, [7, 8])


@query(
    "k3_month_time_axis",
    "site:s ts:t year_mon:s time:6 FSDS:6",
    "SELECT site, ts, strftime(ts,'%Y-%m') AS year_mon, (row_number() OVER (PARTITION BY site, strftime(ts,'%Y-%m') ORDER BY ts)-1)/48e0 AS time, "
    '"view" AS "FSDS" FROM tgrid',
    "tgrid",
)
def _(t):
    return forcing_table(t.tower_grid().withColumnRenamed("view", "Rg"), ["site"], "ts")
