"""Registered queries: whole runs over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import partition, qc
from fluxloom.operators import summarize as sm
from fluxloom.operators.attach import from_rows
from fluxloom.operators.joins import classify
from fluxloom.plans import workflows as wf
from fluxloom.plans.inputs import bin_sql, season_sql
from fluxloom.plans.registry import query, scratch
from fluxloom.streaming.rebin import rebin_available


@query(
    "tower_cleaning",
    "site:s ts:t view:6 click:6",
    "SELECT g.site, g.ts, CASE WHEN g.site='East' AND d>DATE '2024-01-03' AND d<DATE '2024-01-12' AND (g.\"view\">80 OR g.\"view\"<5) THEN NULL ELSE g.\"view\" END AS \"view\", "
    "CASE WHEN c IS NULL AND g.ts>TIMESTAMP '2024-01-10' THEN CASE WHEN f.v IS NOT NULL THEN f.v ELSE f.v0+(f.v1-f.v0)*(epoch(f.ts)-epoch(f.t0))/(epoch(f.t1)-epoch(f.t0)) END ELSE c END AS click "
    "FROM (SELECT *, CAST(ts AS DATE) AS d, CASE WHEN site='West' AND CAST(ts AS DATE)>DATE '2024-01-05' AND CAST(ts AS DATE)<DATE '2024-01-25' AND click<20 THEN NULL ELSE click END AS c FROM tgrid) g "
    "LEFT JOIN (SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0, "
    "first_value(v IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER f AS t1 FROM "
    "(SELECT ts, CASE WHEN minute(ts)=0 THEN v END AS v FROM grid WHERE sensor='error') WINDOW b AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "f AS (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) f ON f.ts=g.ts",
    "tgrid grid",
)
def _(t):
    rules = {
        "East": [("view", "2024-01-03", "2024-01-12", 5.0, 80.0)],
        "West": [("click", "2024-01-05", "2024-01-25", 20.0, None)],
    }
    station = t.sensor().filter((F.col("sensor") == "error") & (F.minute("ts") == 0))
    return wf.clean_towers(
        t.towers(), ["view", "click"], rules, station, "v", "click", "2024-01-10 00:00:00"
    )


@query(
    "station_cleaning",
    "station:i site:s ts:t view:6 click:6",
    "SELECT g.station, g.site, g.ts, CASE WHEN EXISTS (SELECT 1 FROM strules r WHERE r.variable='view' AND r.station=g.station AND r.site=g.site AND CAST(g.ts AS DATE)>r.a AND CAST(g.ts AS DATE)<r.b "
    "AND (g.\"view\">r.hi OR g.\"view\"<r.lo)) THEN NULL ELSE g.\"view\" END AS \"view\", "
    "CASE WHEN (g.click IS NULL OR EXISTS (SELECT 1 FROM strules r WHERE r.variable='click' AND r.station=g.station AND r.site=g.site AND CAST(g.ts AS DATE)>r.a AND CAST(g.ts AS DATE)<r.b "
    "AND (g.click>r.hi OR g.click<r.lo))) THEN CASE WHEN g.station=0 AND g.ts>TIMESTAMP '2024-01-10' OR g.station=1 AND g.ts>TIMESTAMP '2024-01-20' THEN "
    "CASE WHEN f.v IS NOT NULL THEN f.v ELSE f.v0+(f.v1-f.v0)*(epoch(f.ts)-epoch(f.t0))/(epoch(f.t1)-epoch(f.t0)) END END ELSE g.click END AS click "
    "FROM stgrid g LEFT JOIN (SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0, "
    "first_value(v IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER f AS t1 FROM "
    "(SELECT s.station, s.ts, h.v FROM (SELECT DISTINCT station, ts FROM stgrid) s LEFT JOIN strows h ON h.site='all' AND h.station=s.station AND h.ts=s.ts) "
    "WINDOW b AS (PARTITION BY station ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "f AS (PARTITION BY station ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) f ON f.station=g.station AND f.ts=g.ts",
    "stgrid strules strows",
)
def _(t):
    towers, readings = t.station_towers()
    # A rule per purchase, for its day and the two behind it.
    day = F.to_date("ts")
    rules = t.stationed().where("event_type = 'purchase'").select(
        "station", "site", F.when(F.col("user_id") % 5 < 3, "view").otherwise("click").alias("variable"),
        F.date_sub(day, 1).alias("start"), F.date_add(day, 3).alias("end"),
        (F.col("value") / 10).alias("lower"), (100 - F.col("value") / 10).alias("upper"),
    )
    stations = from_rows(
        t.spark, [(0, "2024-01-10 00:00:00"), (1, "2024-01-20 00:00:00")], "station long, fill_after string"
    ).withColumn("fill_after", F.col("fill_after").cast("timestamp_ntz"))
    return wf.clean_stations(towers, ["view", "click"], rules, readings, "v", stations, "click")


@query(
    "rain_to_half_hours",
    "ts:t PRECTmms:9",
    "SELECT f.ts, CASE WHEN d.total=0 THEN 0 WHEN s.w=0 THEN d.total/s.n ELSE d.total*f.w/s.w END/1800e0 AS \"PRECTmms\" FROM rainfine f JOIN "
    "(SELECT CAST(ts AS DATE) AS date, sum(value)*0.39e0 AS total FROM events WHERE event_type='purchase' GROUP BY 1) d USING (date) "
    "JOIN (SELECT date, sum(w) AS w, count(*) AS n FROM rainfine GROUP BY date) s USING (date)",
    "rainfine",
)
def _(t):
    daily = t.events.filter("event_type = 'purchase'").groupBy(F.to_date("ts").alias("date")).agg(F.sum("value").alias("ppt"))
    fine = t.events.filter("event_type <> 'purchase'").select("ts", F.when(F.col("value") > 1, F.col("value")).alias("w"))
    return wf.half_hour_precipitation(daily, fine, "ppt", "w")


@query(
    "rain_conserved",
    "date:d steps:i amount:6",
    "SELECT d.date, CASE WHEN day(d.date)%5=0 THEN 48 ELSE n END AS steps, total AS amount FROM "
    "(SELECT CAST(ts AS DATE) AS date, sum(value)*0.39e0 AS total FROM events WHERE event_type='purchase' GROUP BY 1) d "
    "LEFT JOIN (SELECT date, count(*) AS n FROM rainfine GROUP BY date) s USING (date)",
    "rainfine",
)
def _(t):
    # Every fifth day the fine gauge was out: the total must not go with it.
    daily = t.events.filter("event_type = 'purchase'").groupBy(F.to_date("ts").alias("date")).agg(F.sum("value").alias("ppt"))
    gauge = t.events.filter("event_type <> 'purchase'").filter(F.day("ts") % 5 != 0)
    fine = gauge.select("ts", F.when(F.col("value") > 1, F.col("value")).alias("w"))
    rain = wf.half_hour_precipitation(daily, fine, "ppt", "w")
    return rain.groupBy(F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("steps"), (F.sum("PRECTmms") * 1800).alias("amount")
    )


@query(
    "forcing_preparation",
    "community:s ts:t year_mon:s PRECTmms:9 Tair:6 Rg:6 NEE:6 VPD:6",
    "SELECT k.community, w.ts + INTERVAL 390 MINUTE AS ts, strftime(w.ts + INTERVAL 390 MINUTE,'%Y-%m') AS year_mon, \"Rg\", \"NEE\", \"VPD\", tk AS \"Tair\", "
    "CASE WHEN k.community='MM' OR tk>=273.15 THEN p WHEN tk<273.15 THEN p*CASE k.community WHEN 'WM' THEN 0.75e0 WHEN 'SB' THEN 2e0 ELSE 0.1e0 END END "
    "+ CASE WHEN k.community='WM' THEN coalesce(q.v/1e5,0) ELSE 0 END AS \"PRECTmms\" FROM "
    "(SELECT ts, max(filled) FILTER (WHERE variable='NEE') AS \"NEE\", max(filled) FILTER (WHERE variable='Tair')+273.15e0 AS tk, "
    "max(filled) FILTER (WHERE variable='PRECTmms') AS p, max(filled) FILTER (WHERE variable='Rg') AS \"Rg\", max(filled) FILTER (WHERE variable='VPD') AS \"VPD\" "
    "FROM flowfilled GROUP BY ts) w CROSS JOIN (VALUES ('FF'),('DM'),('MM'),('WM'),('SB')) k(community) LEFT JOIN grid q ON q.ts=w.ts AND q.sensor='error'",
    "flowfilled grid",
)
def _(t):
    runoff = t.sensor().filter("sensor = 'error'").select(
        # UTC, some seconds off the minute.
        tp.plus_seconds("ts", F.lit(7 * 3600 - 1800) + F.dayofmonth("ts") - 16).alias("ts"), (F.col("v") / 1e5).alias("QRUNOFF")
    )
    return wf.prepare_forcing(_flux_towers(t), _rain(t), _light(t, 4, -80), "East", 40.0, -105.5, runoff=runoff)


def _flux_towers(t):
    # Respiration of known sensitivity to temperature, disturbed by another sensor.
    celsius = F.col("click") / 10 - 5
    term = partition.temperature_term(celsius)
    nee = 2.0 * F.exp(200.0 * term) * (1 + (F.col("purchase") - 50) / 500)
    cols = {"NEE": nee, "Tair": celsius, "rH": F.col("signup"), "P": F.col("error") / 10 + 60}
    return t.tower_grid().select("site", "ts", *[c.alias(n) for n, c in cols.items()])


def _rain(t):
    return t.sensor().filter("sensor = 'purchase'").select("ts", (F.col("v") / 1800).alias("PRECTmms"))


def _light(t, factor: int, offset: int):
    return t.sensor().filter("sensor = 'view'").select("ts", (F.col("v") * factor + offset).alias("Rg"))


@query(
    "forcing_of_stations",
    "station:s community:s ts:t year_mon:s PRECTmms:9 Tair:6 Rg:6 NEE:6 VPD:6",
    "SELECT station, community, ts, strftime(ts,'%Y-%m') AS year_mon, \"Rg\", \"NEE\", \"VPD\", tk AS \"Tair\", "
    "CASE WHEN community='MM' OR tk>=273.15 THEN p WHEN tk<273.15 THEN p*CASE community WHEN 'WM' THEN 0.75e0 WHEN 'SB' THEN 2e0 ELSE 0.1e0 END END "
    "+ CASE WHEN community='WM' AND station='north' THEN coalesce(q/1e5,0) ELSE 0 END AS \"PRECTmms\" FROM "
    "(SELECT w.*, k.community, g.error AS q, w.own + CASE w.station WHEN 'north' THEN INTERVAL 390 MINUTE ELSE INTERVAL (-90) MINUTE END AS ts FROM "
    "(SELECT site AS station, ts AS own, max(filled) FILTER (WHERE variable='NEE') AS \"NEE\", max(filled) FILTER (WHERE variable='Tair')+273.15e0 AS tk, "
    "max(filled) FILTER (WHERE variable='PRECTmms') AS p, max(filled) FILTER (WHERE variable='Rg') AS \"Rg\", max(filled) FILTER (WHERE variable='VPD') AS \"VPD\" "
    "FROM stationfilled GROUP BY site, ts) w CROSS JOIN (VALUES ('FF'),('DM'),('MM'),('WM'),('SB')) k(community) LEFT JOIN kinds g ON g.ts=w.own)",
    "stationfilled kinds",
)
def _(t):
    # Two stations on clocks eight hours apart; either tower is the base of one of them.
    def at(station: str, df):
        return df.withColumn("station", F.lit(station))

    stations = from_rows(
        t.spark, [("north", "East", 40.0, -105.5, -7.0), ("south", "West", 45.0, 7.0, 1.0)],
        "station string, base string, lat double, lon double, zone_hours double",
    )
    both = F.explode(F.array(F.lit("north"), F.lit("south"))).alias("station")
    light = at("north", _light(t, 4, -80)).unionByName(at("south", _light(t, 3, -40)))
    runoff = t.sensor().filter("sensor = 'error'").select(
        F.lit("north").alias("station"), tp.plus_seconds("ts", F.lit(7 * 3600 - 1800)).alias("ts"), (F.col("v") / 1e5).alias("QRUNOFF")
    )
    return wf.prepare_forcings(_flux_towers(t).select("*", both), _rain(t).select("*", both), light, stations, runoff=runoff)


@query(
    "rain_of_gauges",
    "gauge:s ts:t PRECTmms:9",
    "SELECT f.gauge, f.ts, CASE WHEN d.total=0 THEN 0 WHEN s.w=0 THEN d.total/s.n ELSE d.total*f.w/s.w END/3600e0 AS \"PRECTmms\" FROM "
    "(SELECT user_id%3 AS gauge, CAST(ts AS DATE) AS date, date_trunc('hour',ts) AS ts, coalesce(CASE WHEN count(*) FILTER (WHERE value<=1)=0 "
    "THEN sum(value) END, 0) AS w FROM events WHERE event_type<>'purchase' AND user_id%3<>2 GROUP BY ALL UNION ALL "
    "SELECT 2, date, unnest(generate_series(date + INTERVAL 0 HOUR, date + INTERVAL 23 HOUR, INTERVAL 1 HOUR)), 0 FROM "
    "(SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE event_type='purchase' AND user_id%3=2)) f JOIN "
    "(SELECT user_id%3 AS gauge, CAST(ts AS DATE) AS date, sum(value)*0.39e0 AS total FROM events WHERE event_type='purchase' GROUP BY ALL) d USING (gauge, date) "
    "JOIN (SELECT gauge, date, sum(w) AS w, count(*) AS n FROM (SELECT user_id%3 AS gauge, CAST(ts AS DATE) AS date, date_trunc('hour',ts) AS h, "
    "coalesce(CASE WHEN count(*) FILTER (WHERE value<=1)=0 THEN sum(value) END, 0) AS w FROM events WHERE event_type<>'purchase' AND user_id%3<>2 GROUP BY ALL) GROUP BY ALL "
    "UNION ALL SELECT DISTINCT 2, CAST(ts AS DATE), 0, 24 FROM events WHERE event_type='purchase' AND user_id%3=2) s USING (gauge, date)",
)
def _(t):
    # Hourly steps; records of every third number came twice, and the last gauge's fine sensor was out.
    gauge = (F.col("user_id") % 3).alias("gauge")
    daily = t.events.filter("event_type = 'purchase'").groupBy(gauge, F.to_date("ts").alias("date")).agg(F.sum("value").alias("ppt"))
    read = t.events.filter("event_type <> 'purchase' AND user_id % 3 <> 2")
    fine = read.union(read.filter("event_id % 3 = 0")).select(gauge, "event_id", "ts", F.when(F.col("value") > 1, F.col("value")).alias("w"))
    rain = wf.half_hour_precipitation(daily, fine, "ppt", "w", ["gauge"], step=3600, repeats=False)
    return rain.filter(F.col("PRECTmms").isNotNull())


@query(
    "a6_rebin_stream",
    "sensor:s ts:t v:6",
    f"SELECT sensor, ts, coalesce(v,0) AS v FROM (SELECT event_type AS sensor, {bin_sql('start')} AS ts, "
    "CASE WHEN count(*) FILTER (WHERE value<1)=0 THEN sum(value) END AS v FROM events GROUP BY ALL)",
)
def _(t):
    # The feed comes in four parts; the stream is stopped after each and goes on from its checkpoint.
    place = scratch(t, "feed")
    feed = qc.null_outside(t.events.select(F.col("event_type").alias("sensor"), F.col("ts").cast("timestamp_ntz"), F.col("value").alias("v")), {"v": (1, None)})
    ends = feed.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    session = t.spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", t.spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [ends["first"] + (ends["last"] - ends["first"]) * i / 4 for i in range(1, 4)]
    # A row of another day closes the last bins.
    closing = t.spark.range(1).select(F.lit(None).cast("string").alias("sensor"), (F.lit(ends["last"]).cast("timestamp_ntz") + F.expr("INTERVAL 2 DAYS")).alias("ts"), F.lit(None).cast("double").alias("v"))
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:]):
        part = feed
        if low is not None:
            part = part.filter(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            part = part.filter(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        (part if high is not None else part.union(closing)).write.mode("append").parquet(f"{place}/in")
        rebin_available(
            session, f"{place}/in", "sensor string, ts timestamp_ntz, v double", f"{place}/out", f"{place}/state", ["sensor"], "ts", {"v": "sum"}, null="strict"
        )
    return qc.null_to_zero(t.spark.read.schema("sensor string, ts timestamp_ntz, v double").parquet(f"{place}/out"), ["v"])


@query(
    "soil_sensors_to_half_hours",
    "plot:s veg_com:s ts:t soiltemp_5cm:6 soilmoisture_5cm:6 letter_5cm:s",
    "SELECT plot, veg_com, ts, st AS soiltemp_5cm, coalesce(a,b,c)*100 AS soilmoisture_5cm, CASE WHEN a IS NOT NULL THEN 'a' WHEN b IS NOT NULL THEN 'b' WHEN c IS NOT NULL THEN 'c' END AS letter_5cm FROM ("
    "SELECT plot, ts, CASE WHEN CAST(plot AS INT)%3=0 THEN 'DM' ELSE 'MM' END AS veg_com, avg(st) AS st, "
    "avg(CASE WHEN st>0 THEN a END) AS a, avg(CASE WHEN st>0 THEN b END) AS b, avg(CASE WHEN st>0 THEN c END) AS c FROM ("
    f"SELECT CAST(user_id%10 AS VARCHAR) AS plot, {bin_sql('start')} AS ts, CASE WHEN event_id%7=0 THEN NULL ELSE value-10 END AS st, "
    "CASE WHEN event_type='view' THEN value/1000e0 END AS a, CASE WHEN event_type IN ('click','error') THEN value/1000e0 END AS b, "
    "CASE WHEN event_type IN ('signup') THEN value/1000e0 END AS c FROM events) GROUP BY plot, ts) WHERE CAST(plot AS INT)%4<>0",
)
def _(t):
    def probe(*kinds: str):
        return F.when(F.col("event_type").isin(*kinds), F.col("value") / 1000)

    none = F.lit(None).cast("string")
    sensors = t.events.select(
        (F.col("user_id") % 10).cast("string").alias("plot"), "ts",
        (F.col("value") - 10).alias("soiltemp_5cm"), F.when(F.col("event_id") % 7 == 0, "q").alias("flag_soiltemp_5cm"),
        probe("view").alias("soilmoisture_a_5cm"), probe("click", "error").alias("soilmoisture_b_5cm"),
        probe("signup").alias("soilmoisture_c_5cm"), *[none.alias(f"flag_soilmoisture_{x}_5cm") for x in "abc"],
    )
    names = [(str(i), "Subalpine" if i % 4 == 0 else "Dry Meadow" if i % 3 == 0 else "Moist Meadow") for i in range(10)]
    plots = classify(
        from_rows(t.spark, names, "plot string, long string"), "long",
        [("Dry", "DM"), ("Moist", "MM"), ("Subalpine", "SA")], "veg_com",
    ).drop("long")
    return wf.soil_half_hours(sensors, plots, ["5cm"])


@query(
    "observed_days",
    "veg_com:s doy:i soil_dailyavg:6 GPP_dailyavg:6 snow_depth_avg:6",
    "SELECT a.veg AS veg_com, a.doy, a.m AS soil_dailyavg, b.m AS \"GPP_dailyavg\", c.m AS snow_depth_avg FROM "
    "(SELECT veg, doy, avg(v) AS m FROM obsdoy WHERE doy IS NOT NULL GROUP BY ALL) a "
    "LEFT JOIN (SELECT veg, doy, avg(w) AS m FROM obsdoy WHERE doy IS NOT NULL GROUP BY ALL) b USING (veg, doy) "
    "LEFT JOIN (SELECT veg, dayofyear(ts) AS doy, avg(v) AS m FROM obs GROUP BY ALL) c USING (veg, doy)",
    "obsdoy",
)
def _(t):
    obs = t.obs().withColumnRenamed("veg", "veg_com")
    soil = obs.withColumnRenamed("v", "soil")
    flux = obs.withColumnRenamed("w", "GPP")
    snow = obs.select("veg_com", F.to_date("ts").alias("date"), F.col("v").alias("snow_depth"))
    return wf.daily_observations(soil, flux, snow, ["soil"])


_SIM_TS = "(ts - INTERVAL 7 HOUR)"


@query(
    "simulated_and_observed_cycles",
    "veg_com:s season:s hour:3 metric:s ObsSim:s mean:6 lo:6 hi:6",
    "SELECT veg AS veg_com, season, hour, metric, \"ObsSim\", m AS mean, m - CASE WHEN s=0 THEN 1e-12 ELSE s END AS lo, m + CASE WHEN s=0 THEN 1e-12 ELSE s END AS hi FROM ("
    f"SELECT veg, {season_sql()} AS season, hour(ts)+minute(ts)/60e0 AS hour, 'FSH' AS metric, 'Obs' AS \"ObsSim\", avg(x) AS m, stddev_samp(x) AS s FROM sim WHERE \"case\"='A' GROUP BY ALL "
    f"UNION ALL SELECT veg, {season_sql(_SIM_TS)}, CASE WHEN hour{_SIM_TS}=0 AND minute{_SIM_TS}=0 THEN 23.5e0 ELSE hour{_SIM_TS}+minute{_SIM_TS}/60e0-0.5e0 END, 'FSH', 'Sim', avg(x), stddev_samp(x) FROM sim WHERE \"case\"<>'A' GROUP BY ALL "
    f"UNION ALL SELECT veg, {season_sql()}, hour(ts)+minute(ts)/60e0, 'TSOI_upper', 'Obs', avg(y), stddev_samp(y) FROM sim WHERE \"case\"='A' GROUP BY ALL "
    f"UNION ALL SELECT veg, {season_sql(_SIM_TS)}, CASE WHEN hour{_SIM_TS}=0 AND minute{_SIM_TS}=0 THEN 23.5e0 ELSE hour{_SIM_TS}+minute{_SIM_TS}/60e0-0.5e0 END, 'TSOI_upper', 'Sim', "
    "avg(CASE WHEN veg='F' THEN z ELSE y END), stddev_samp(CASE WHEN veg='F' THEN z ELSE y END) FROM sim WHERE \"case\"<>'A' GROUP BY ALL)",
    "sim",
)
def _(t):
    sim = t.sim().withColumnRenamed("veg", "veg_com")
    seen = sim.filter("case = 'A'").select("veg_com", "ts", F.col("x").alias("FSH"), F.col("y").alias("TSOI_upper"))
    obs = sm.diurnal_seasonal(seen, ["FSH", "TSOI_upper"], ["veg_com"])
    history = sim.filter("case <> 'A'").select(
        "veg_com",
        (F.year("ts") * 10000 + F.month("ts") * 100 + F.day("ts")).alias("mcdate"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60).alias("mcsec"),
        F.col("x").alias("FSH"), F.array("x", "y", "z", "x", "y").alias("TSOI"),
    )
    parts = wf.simulation_summaries(history, ["FSH"], ["TSOI"], {"F": 3})
    return wf.compare_diurnal(obs, parts["diurnal"], ["FSH", "TSOI_upper"])
