"""Registered queries: joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import grid as gr
from fluxloom.operators import joins as jn
from fluxloom.operators import qc
from fluxloom.operators import reshape as rs
from fluxloom.operators import summarize as sm
from fluxloom.plans.inputs import bin_sql, noleap_sql, season_sql
from fluxloom.plans.registry import query

# --- joins -----------------------------------------------------------------


@query("j1_complete_grid", "sensor:s ts:t v:6", "SELECT sensor, ts, v FROM grid", "grid")
def _(t):
    return t.grid()


@query(
    "j2_join_sources",
    "site:s ts:t view:6 flow:6 light:6",
    'SELECT g.site, g.ts, g."view", p.v AS flow, c.v AS light FROM tgrid g '
    "LEFT JOIN (SELECT ts, CAST(ts AS DATE) AS d, v FROM sensor WHERE sensor='purchase') p ON p.ts=g.ts "
    "LEFT JOIN (SELECT ts, v FROM sensor WHERE sensor='click') c ON c.ts=g.ts",
    "tgrid",
)
def _(t):
    def side(kind: str, out: str):
        return t.sensor().filter(F.col("sensor") == kind).select(*_stamp(), "ts", F.col("v").alias(out))

    base = t.tower_grid().select("site", *_stamp(), "ts", "view")
    return jn.join_sources(base, side("purchase", "flow"), side("click", "light"), on=["hour", "date", "ts"])


def _stamp():
    return tp.end_label_hour("ts").alias("hour"), tp.end_label_date("ts").alias("date")


@query(
    "j3_join_fallback",
    "site:s ts:t click:6 other:6",
    "SELECT g.site, g.ts, g.click, s.v AS other FROM tgrid g LEFT JOIN sensor s ON s.ts=g.ts AND s.sensor='error'",
    "tgrid",
)
def _(t):
    station = t.sensor().filter(F.col("sensor") == "error")
    return jn.join_fallback(t.tower_grid(), station, ["ts"], "v", "other")


@query(
    "j4_lookup",
    "s_suppkey:i nation:s region:s",
    "SELECT s_suppkey, n_name AS nation, r_name AS region FROM supplier LEFT JOIN nation ON s_nationkey=n_nationkey "
    "LEFT JOIN region ON n_regionkey=r_regionkey",
)
def _(t):
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"), "n_regionkey")
    region = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return jn.lookup(jn.lookup(t.supplier, nation, ["s_nationkey"]), region, ["n_regionkey"])


@query(
    "j5_full_stack",
    "ts:t v:6 a:6 b:6",
    'SELECT coalesce(x.ts,y.ts) AS ts, CASE WHEN x.ts IS NULL THEN y.v ELSE x.v END AS v, x.click AS a, y.signup AS b '
    "FROM (SELECT ts, \"view\" AS v, click FROM tgrid WHERE site='East') x FULL JOIN "
    "(SELECT ts, \"view\" AS v, signup FROM tgrid WHERE site='West') y ON x.ts=y.ts AND x.v IS NOT DISTINCT FROM y.v",
    "tgrid",
)
def _(t):
    g = t.tower_grid()
    east = g.filter("site = 'East'").select("ts", F.col("view").alias("v"), F.col("click").alias("a"))
    west = g.filter("site = 'West'").select("ts", F.col("view").alias("v"), F.col("signup").alias("b"))
    return jn.full_stack(east, west, ["ts", "v"])


@query(
    "j6_right_join",
    "year:i mean_v:6 total:6",
    "SELECT p.year, n.mean_v, p.total FROM (SELECT year(ts)+1 AS year, avg(v) AS mean_v FROM obs GROUP BY 1) n "
    "RIGHT JOIN (SELECT year(ts) AS year, avg(y)*365e0 AS total FROM sim GROUP BY 1) p ON n.year=p.year",
    "obs sim",
)
def _(t):
    # The year before beside each year's rain: the first year has none.
    npp = sm.annual_npp(t.obs().withColumn("year", F.year("ts") + 1), "v", ["year"]).select("year", F.col("mean_v"))
    rain = t.sim().groupBy(F.year("ts").alias("year")).agg((F.avg("y") * 365.0).alias("total"))
    return jn.align_summaries(npp, rain, ["year"], "right")


@query(
    "j7_align_summaries",
    "doy:i veg:s obs_mean:6 sim_mean:6 sim_sd:6",
    "SELECT o.doy, o.veg, o.m AS obs_mean, s.m AS sim_mean, s.sd AS sim_sd FROM "
    f"(SELECT doy, CASE veg WHEN '1-URGENT' THEN 'F' WHEN '2-HIGH' THEN 'O' ELSE veg END AS veg, avg(v) AS m FROM (SELECT {noleap_sql('ts')} AS doy, veg, v FROM obs) WHERE doy IS NOT NULL GROUP BY ALL) o "
    f"LEFT JOIN (SELECT doy, veg, avg(y) AS m, stddev_samp(y) AS sd FROM (SELECT {noleap_sql('ts')} AS doy, veg, y FROM sim) WHERE doy IS NOT NULL GROUP BY ALL) s "
    "ON o.doy=s.doy AND o.veg=s.veg",
    "obs sim",
)
def _(t):
    veg = F.when(F.col("veg") == "1-URGENT", "F").when(F.col("veg") == "2-HIGH", "O").otherwise(F.col("veg"))
    obs = sm.doy_climatology(t.obs().withColumn("veg", veg), ["v"], ["veg"])
    sim = sm.doy_climatology(t.sim(), ["y"], ["veg"])
    return jn.align_summaries(obs, sim, ["doy", "veg"]).select(
        "doy", "veg", F.col("v_dailyavg").alias("obs_mean"), F.col("y_dailyavg").alias("sim_mean"),
        F.col("y_dailysd").alias("sim_sd"),
    )


@query(
    "j8_nearest_cell",
    "id:i near_lat:6 near_lon:6",
    "SELECT id, (SELECT min_by(lat, (abs(lat-p.lat), -lat)) FROM cells) AS near_lat, "
    "(SELECT min_by(lon, (abs(lon-p.lon), -lon)) FROM cells) AS near_lon FROM pts p",
    "pts cells",
)
def _(t):
    points = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("lat"),
        (F.col("c_custkey") * 37 % 360 + 0.5).cast("double").alias("lon"),
    )
    cells = t.supplier.select(
        F.col("s_acctbal").alias("lat"), (F.col("s_suppkey") * 7 % 360).cast("double").alias("lon")
    )
    return jn.nearest_cell(points, cells, ["lat", "lon"])


@query(
    "j9_case_diff",
    "ts:t x:6 rain_snow:6",
    "SELECT a.ts, a.x-b.x AS x, (a.y+a.z)-(b.y+b.z) AS rain_snow FROM "
    '(SELECT ts, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM sim WHERE "case"=\'A\' GROUP BY ts) a JOIN '
    '(SELECT ts, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM sim WHERE "case"=\'R\' GROUP BY ts) b USING (ts)',
    "sim",
)
def _(t):
    step = t.sim().groupBy("case", "ts").agg(F.avg("x").alias("x"), (F.avg("y") + F.avg("z")).alias("rain_snow"))
    sides = rs.split_by(step, "case", ["A", "R"])
    return jn.case_diff(sides["A"], sides["R"], ["ts"], ["x", "rain_snow"])


@query(
    "j10_choose_by_key",
    "ts:t col:i x:6",
    "SELECT coalesce(a.ts,b.ts) AS ts, coalesce(a.col,b.col) AS col, CASE WHEN coalesce(a.col,b.col)=2 THEN a.x ELSE b.x END AS x FROM "
    '(SELECT CAST(ts AS DATE) AS ts, hour(ts)%4 AS col, avg(x) AS x FROM sim WHERE "case"=\'A\' GROUP BY ALL) a FULL JOIN '
    '(SELECT CAST(ts AS DATE) AS ts, hour(ts)%4 AS col, avg(x) AS x FROM sim WHERE "case"=\'N\' GROUP BY ALL) b ON a.ts=b.ts AND a.col=b.col',
    "sim",
)
def _(t):
    step = t.sim().groupBy("case", F.to_date("ts").cast("timestamp_ntz").alias("ts"), (F.hour("ts") % 4).alias("col")).agg(
        F.avg("x").alias("x")
    )
    sides = rs.split_by(step, "case", ["A", "N"])
    return jn.choose_by_key(sides["A"], sides["N"], ["ts", "col"], F.col("col") == 2, ["x"])


_LISTED = ["5-LOW", "0-NONE", "2-HIGH", "1-URGENT"]


@query(
    "j11_reindex",
    "year:i ord:i veg:s v:6",
    "SELECT y.year, l.ord, l.veg, a.v FROM (SELECT DISTINCT year(ts) AS year FROM obs) y CROSS JOIN "
    "(VALUES (0,'5-LOW'),(1,'0-NONE'),(2,'2-HIGH'),(3,'1-URGENT')) l(ord,veg) LEFT JOIN "
    "(SELECT year(ts) AS year, veg, avg(v) AS v FROM obs GROUP BY ALL) a ON a.year=y.year AND a.veg=l.veg",
    "obs",
)
def _(t):
    annual = t.obs().groupBy(F.year("ts").alias("year"), "veg").agg(F.avg("v").alias("v"))
    return jn.reindex(annual, "veg", _LISTED, within=["year"])


@query(
    "o5_category_order",
    "ord:i veg:s n:i",
    "SELECT l.ord, l.veg, a.n FROM (VALUES (0,'5-LOW'),(1,'0-NONE'),(2,'2-HIGH'),(3,'1-URGENT')) l(ord,veg) "
    "LEFT JOIN (SELECT veg, count(*) AS n FROM obs GROUP BY veg) a USING (veg)",
    "obs",
)
def _(t):
    counts = t.obs().groupBy("veg").agg(F.count(F.lit(1)).alias("n"))
    return jn.reindex(counts, "veg", _LISTED).orderBy("ord")


@query(
    "j12_densify",
    "date:d veg:s v:6",
    "SELECT d.date, k.veg, x.v FROM (SELECT DISTINCT date FROM daily) d CROSS JOIN (SELECT DISTINCT veg FROM daily) k "
    "LEFT JOIN daily x ON x.date=d.date AND x.veg=k.veg",
    "daily",
)
def _(t):
    return jn.densify(t.daily(), "date", "veg")


# --- aggregations ----------------------------------------------------------


@query(
    "a1_diurnal_seasonal",
    "veg:s season:s hour:6 v_houravg:6 v_hoursd:6 w_houravg:6 w_hoursd:6",
    f"SELECT veg, {season_sql()} AS season, hour(ts)+minute(ts)/60e0 AS hour, avg(v) AS v_houravg, stddev_samp(v) AS v_hoursd, "
    "avg(w) AS w_houravg, stddev_samp(w) AS w_hoursd FROM obs GROUP BY ALL",
    "obs",
)
def _(t):
    return sm.diurnal_seasonal(t.obs(), ["v", "w"], ["veg"])


@query(
    "a2_doy_climatology",
    "veg:s doy:i v_dailyavg:6 v_dailysd:6",
    f"SELECT veg, doy, avg(v) AS v_dailyavg, stddev_samp(v) AS v_dailysd FROM (SELECT *, {noleap_sql('ts')} AS doy FROM obs) "
    "WHERE doy IS NOT NULL GROUP BY ALL",
    "obs",
)
def _(t):
    return sm.doy_climatology(t.obs(), ["v"], ["veg"])


@query(
    "a3_annual_summary",
    "veg:s year:i v_yearavg:6 v_yearsd:6",
    "SELECT veg, year(ts) AS year, avg(v) AS v_yearavg, stddev_samp(v) AS v_yearsd FROM obs GROUP BY ALL",
    "obs",
)
def _(t):
    return sm.annual_summary(t.obs(), ["v"], ["veg"])


@query(
    "a3_mean_annual",
    "veg:s v_yearavg_mean:6 v_yearavg_sd:6",
    "SELECT veg, avg(m) AS v_yearavg_mean, stddev_samp(m) AS v_yearavg_sd FROM "
    "(SELECT veg, year(ts) AS y, avg(v) AS m FROM obs GROUP BY ALL) GROUP BY veg",
    "obs",
)
def _(t):
    return sm.mean_annual(sm.annual_summary(t.obs(), ["v"], ["veg"]), ["veg"], ["v_yearavg"])


@query(
    "a4_july_diurnal",
    "veg:s hour:6 v_houravg:6 v_hoursd:6",
    "SELECT veg, hour(ts)+minute(ts)/60e0 AS hour, avg(v) AS v_houravg, stddev_samp(v) AS v_hoursd FROM obs WHERE month(ts)=7 GROUP BY ALL",
    "obs",
)
def _(t):
    return sm.month_diurnal(t.obs(), 7, ["v"], ["veg"])


@query(
    "a5_annual_peak",
    "veg:s year:i max_v:6 mean_max_v:6",
    "SELECT veg, year, max_v, avg(max_v) OVER (PARTITION BY veg) AS mean_max_v FROM "
    "(SELECT veg, year(ts) AS year, max(v) AS max_v FROM obs GROUP BY ALL)",
    "obs",
)
def _(t):
    return sm.annual_peak(t.obs(), "v", ["veg"])


@query(
    "a6_rebin_sum_strict",
    "sensor:s ts:t v:6",
    f"SELECT sensor, ts, coalesce(v,0) AS v FROM (SELECT event_type AS sensor, {bin_sql('start')} AS ts, "
    "CASE WHEN count(*) FILTER (WHERE value<1)=0 THEN sum(value) END AS v FROM events GROUP BY ALL)",
)
def _(t):
    raw = t.events.select(F.col("event_type").alias("sensor"), "ts", F.col("value").alias("v"))
    gauge = qc.null_outside(raw, {"v": (1, None)})
    return qc.null_to_zero(gr.rebin(gauge, ["sensor"], "ts", {"v": "sum"}, null="strict"), ["v"])


@query(
    "a7_rebin_mean",
    "sensor:s ts:t v:6",
    f"SELECT event_type AS sensor, {bin_sql('start')} AS ts, avg(CASE WHEN value>=1 THEN value END) AS v FROM events GROUP BY ALL",
)
def _(t):
    raw = t.events.select(F.col("event_type").alias("sensor"), "ts", F.col("value").alias("v"))
    return gr.rebin(qc.null_outside(raw, {"v": (1, None)}), ["sensor"], "ts", {"v": "mean"})


@query(
    "a8_daily_total",
    "sensor:s date:d month:i v:4",
    "SELECT event_type AS sensor, CAST(ts AS DATE) AS date, month(ts) AS month, sum(value) AS v FROM events GROUP BY ALL",
)
def _(t):
    raw = t.events.select(F.col("event_type").alias("sensor"), "ts", F.col("value").alias("v"))
    return sm.daily_total(raw, ["v"], ["sensor"]).withColumn("month", F.month("date"))


@query(
    "a9_community_stats",
    "veg:s date:d v_avg:6 v_sd:6 n:i doy_avg:6",
    "SELECT a.veg, a.date, a.v_avg, a.v_sd, a.n, b.m AS doy_avg FROM (SELECT veg, CAST(ts AS DATE) AS date, avg(v) AS v_avg, "
    "stddev_samp(v) AS v_sd, count(v) AS n FROM obs GROUP BY ALL) a JOIN "
    "(SELECT veg, dayofyear(ts) AS doy, avg(v) AS m FROM obs GROUP BY ALL) b ON a.veg=b.veg AND b.doy=dayofyear(a.date)",
    "obs",
)
def _(t):
    obs = t.obs()
    by_date = sm.community_stats(obs, ["veg", F.to_date("ts").alias("date")], "v").withColumn("doy", F.dayofyear("date"))
    by_doy = sm.community_stats(obs, ["veg", F.dayofyear("ts").alias("doy")], "v")
    return by_date.join(by_doy.select("veg", "doy", F.col("v_avg").alias("doy_avg")), ["veg", "doy"])


@query(
    "a10_group_stats",
    "date:d case:s x_mean:6 x_std:6 y_mean:6 y_std:6 z_mean:6 z_std:6",
    'SELECT CAST(ts AS DATE) AS date, "case", avg(x) AS x_mean, stddev_samp(x) AS x_std, avg(y) AS y_mean, stddev_samp(y) AS y_std, '
    "avg(z) AS z_mean, stddev_samp(z) AS z_std FROM sim GROUP BY ALL",
    "sim",
)
def _(t):
    return sm.group_stats(t.sim().withColumn("date", F.to_date("ts")), ["date", "case"])


@query(
    "a11_annual_npp",
    "year:i veg:s mean_v:6 sd_v:6",
    "SELECT year(ts) AS year, veg, avg(v) AS mean_v, stddev_samp(v) AS sd_v FROM obs GROUP BY ALL",
    "obs",
)
def _(t):
    return sm.annual_npp(t.obs().withColumn("year", F.year("ts")), "v", ["year", "veg"])


_DAYS = "CASE WHEN month IN (1,3,5,7,8,10,12) THEN 31 WHEN month=2 THEN 28 ELSE 30 END"


@query(
    "a12_precip_totals",
    "level:s veg:s year:i month:i total:2",
    "SELECT 'annual' AS level, veg, year(ts) AS year, 0 AS month, avg(v)*86400e0*365 AS total FROM obs GROUP BY ALL UNION ALL "
    f"SELECT 'monthly', veg, year, month, r*86400e0*{_DAYS} FROM (SELECT veg, year(ts) AS year, month(ts) AS month, avg(v) AS r FROM obs GROUP BY ALL) UNION ALL "
    "SELECT 'summer', veg, year(ts), 0, avg(v)*86400e0*122 FROM obs WHERE month(ts) BETWEEN 6 AND 9 GROUP BY ALL UNION ALL "
    "SELECT 'autumn', veg, year(ts), 0, avg(v)*86400e0*122 FROM obs WHERE month(ts)>9 GROUP BY ALL",
    "obs",
)
def _(t):
    cube = sm.day_cube(t.obs(), ["veg"], "ts", ["v"])
    return sm.precip_levels(cube, "v", ["veg"], ["annual", "monthly", "summer", "autumn"])


@query(
    "a13_resample",
    "freq:s veg:s start:d v_mean:6 w_max:6",
    "SELECT 'D' AS freq, veg, CAST(ts AS DATE) AS start, avg(v) AS v_mean, max(w) AS w_max FROM obs GROUP BY ALL UNION ALL "
    "SELECT 'M', veg, CAST(date_trunc('month',ts) AS DATE), avg(v), max(w) FROM obs GROUP BY ALL UNION ALL "
    "SELECT 'Y', veg, CAST(date_trunc('year',ts) AS DATE), avg(v), max(w) FROM obs GROUP BY ALL UNION ALL "
    "SELECT 'QS-DEC', veg, CAST(date_trunc('quarter',ts + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE), avg(v), max(w) FROM obs GROUP BY ALL",
    "obs",
)
def _(t):
    cube = sm.day_cube(t.obs(), ["veg"], "ts", ["v", "w"])
    return sm.roll_up(cube, ["veg"], ["D", "M", "Y", "QS-DEC"], {"v": "mean", "w": "max"})


@query(
    "w10_by_season",
    "veg:s start:d v_mean:6",
    "SELECT * FROM (SELECT veg, CAST(date_trunc('quarter',ts + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE) AS start, avg(v) AS v_mean "
    "FROM obs GROUP BY ALL) WHERE month(start)=6",
    "obs",
)
def _(t):
    return sm.by_season(sm.resample(t.obs(), ["veg"], "ts", "QS-DEC", {"v": "mean"}), 6)


@query(
    "a14_weighted_annual_mean",
    "veg:s start:d v:6",
    "SELECT veg, min(m) AS start, sum(v*d)/365e0 AS v FROM (SELECT *, (rn-1)//12 AS g, "
    "[31,28,31,30,31,30,31,31,30,31,30,31][1+CAST((rn-1)%12 AS INT)] AS d FROM (SELECT veg, m, v, row_number() OVER (PARTITION BY veg ORDER BY m) AS rn "
    "FROM (SELECT veg, CAST(date_trunc('month',ts) AS DATE) AS m, avg(v) AS v FROM obs GROUP BY ALL))) GROUP BY veg, g HAVING count(*)=12",
    "obs",
)
def _(t):
    monthly = sm.resample(t.obs(), ["veg"], "ts", "M", {"v": "mean"}).withColumnsRenamed({"v_mean": "v", "start": "month"})
    return sm.weighted_annual_mean(monthly, ["veg"], "month", "v")


@query(
    "a15_mean_annual_cycle",
    "case:s monday:4 x_mean:6 x_std:6 first_ts:t",
    'SELECT "case", round(month(ts)+day(ts)/100e0,2) AS monday, avg(x) AS x_mean, stddev_pop(x) AS x_std, min(ts) AS first_ts FROM sim GROUP BY ALL',
    "sim",
)
def _(t):
    return sm.mean_annual_cycle(t.sim(), ["x"], ["case"])


@query(
    "a16_diel",
    "case:s season:s hourmin:3 y_mean:6 y_std:6",
    f'SELECT "case", {season_sql()} AS season, round(hour(ts)+minute(ts)/60e0,1) AS hourmin, avg(y) AS y_mean, stddev_pop(y) AS y_std FROM sim GROUP BY ALL',
    "sim",
)
def _(t):
    return sm.diel(t.sim(), "y", ["case"])


@query(
    "a17_month_sum",
    "month:i x:4",
    "SELECT month(a.ts) AS month, sum(a.x-b.x) AS x FROM (SELECT ts, avg(x) AS x FROM sim WHERE \"case\"='A' GROUP BY ts) a JOIN "
    "(SELECT ts, avg(x) AS x FROM sim WHERE \"case\"='R' GROUP BY ts) b USING (ts) GROUP BY 1",
    "sim",
)
def _(t):
    step = t.sim().groupBy("case", "ts").agg(F.avg("x").alias("x"))
    sides = rs.split_by(step, "case", ["A", "R"])
    return sm.month_sum(jn.case_diff(sides["A"], sides["R"], ["ts"], ["x"]), ["x"], [])


@query(
    "a18_max_vs_sum",
    "case:s year:i max_x:6 sum_z:3",
    'SELECT "case", year(ts) AS year, max(x) AS max_x, sum(z)*1800e0 AS sum_z FROM sim GROUP BY ALL',
    "sim",
)
def _(t):
    return sm.annual_max_vs_sum(t.sim(), "x", "z", ["case"])


@query(
    "a19_correlation",
    "case:s season:s r:8 n:i df:i t:6 ci_low:8 ci_high:8 p:8",
    'SELECT "case", season, r, n, n-2 AS df, t, tanh(atanh(r)-1.959963984540054e0/sqrt(n-3)) AS ci_low, tanh(atanh(r)+1.959963984540054e0/sqrt(n-3)) AS ci_high, '
    "CASE WHEN t IS NOT NULL THEN 1 - (CASE WHEN (n-2)%2=1 THEN (h + CASE WHEN n>3 THEN sin(h)*(SELECT sum(exp((2*k+1)*ln(cos(h)) + lgamma(k+1) - lgamma(k+1.5e0)))*sqrt(pi())/2 "
    "FROM (SELECT unnest(range(0,(n-3)//2)) AS k)) ELSE 0 END)*2/pi() "
    "ELSE sin(h)*(SELECT sum(exp(2*k*ln(cos(h)) + lgamma(k+0.5e0) - lgamma(k+1)))/sqrt(pi()) FROM (SELECT unnest(range(0,(n-2)//2)) AS k)) END) END AS p FROM "
    "(SELECT *, atan(abs(t)/sqrt(n-2)) AS h FROM (SELECT *, r*sqrt((n-2)/(1-r*r)) AS t FROM "
    f"(SELECT \"case\", season, CASE WHEN min(x)<max(x) AND min(y)<max(y) THEN corr(y,x) END AS r, count(*) AS n FROM (SELECT * REPLACE (CASE WHEN \"case\"='N' AND season='MAM' THEN 5 ELSE x END AS x) FROM (SELECT *, {season_sql()} AS season FROM sim)) GROUP BY ALL)))",
    "sim",
)
def _(t):
    sim = t.sim().withColumn("season", tp.season(F.month("ts")))
    flat = (F.col("case") == "N") & (F.col("season") == "MAM")
    return sm.add_p_value(sm.corr_test(sim.withColumn("x", F.when(flat, 5.0).otherwise(F.col("x"))), "x", "y", ["case", "season"]))


@query(
    "a19_tower_correlation",
    "n:i r:8",
    "SELECT count(*) AS n, corr(s.v, g.click) AS r FROM tgrid g JOIN sensor s ON s.ts=g.ts AND s.sensor='error' WHERE g.click IS NOT NULL",
    "tgrid",
)
def _(t):
    station = t.sensor().filter(F.col("sensor") == "error")
    return sm.corr_by(jn.join_fallback(t.tower_grid(), station, ["ts"], "v", "other"), "click", "other", [])


@query(
    "a20_linear_fit",
    "case:s veg:s slope:8 intercept:6 r2:8 n:i",
    'SELECT "case", veg, regr_slope(y,x) AS slope, regr_intercept(y,x) AS intercept, regr_r2(y,x) AS r2, regr_count(y,x) AS n FROM sim GROUP BY ALL',
    "sim",
)
def _(t):
    return sm.linfit(t.sim(), "x", "y", ["case", "veg"])


@query(
    "a21_slice_change",
    "veg:s doy:i mean_early:6 mean_late:6 change_late:6",
    f"SELECT veg, doy, e AS mean_early, l AS mean_late, l-e AS change_late FROM (SELECT veg, doy, avg(v) FILTER (WHERE year(ts) BETWEEN 1996 AND 1997) AS e, "
    f"avg(v) FILTER (WHERE year(ts) BETWEEN 1999 AND 2000) AS l FROM (SELECT *, {noleap_sql('ts')} AS doy FROM obs) WHERE doy IS NOT NULL GROUP BY ALL)",
    "obs",
)
def _(t):
    return sm.slice_change(t.obs(), "v", ["veg"], "ts", [("early", 1996, 1997), ("late", 1999, 2000)])


@query(
    "a22_threshold_season",
    "veg:s year:i first_doy:i last_doy:i duration:i",
    "SELECT veg, year, a AS first_doy, b AS last_doy, b-a AS duration FROM (SELECT veg, year(ts) AS year, min(dayofyear(ts)) FILTER (WHERE v<=100) AS a, "
    "max(dayofyear(ts)) FILTER (WHERE v<=100) AS b FROM obs GROUP BY ALL)",
    "obs",
)
def _(t):
    return sm.threshold_season(t.obs(), "v", ["veg"], "ts", 100.0)


@query(
    "a23_value_bounds",
    "case:s min_ts:t max_ts:t min_y:6 max_y:6",
    'SELECT "case", min(ts) AS min_ts, max(ts) AS max_ts, min(y) AS min_y, max(y) AS max_y FROM sim GROUP BY ALL',
    "sim",
)
def _(t):
    return sm.value_bounds(t.sim(), ["ts", "y"], ["case"])


@query(
    "a25_year_doy_overlay",
    "case:s year:i doy:i y:6",
    'SELECT "case", year, doy, m AS y FROM (SELECT *, avg(y) OVER w AS m, count(y) OVER w AS k FROM (SELECT "case", year(ts) AS year, dayofyear(ts) AS doy, '
    "CASE WHEN avg(x)>20 THEN avg(y) END AS y FROM sim GROUP BY ALL) WINDOW w AS (PARTITION BY \"case\", year ORDER BY doy ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)) WHERE k=10",
    "sim",
)
def _(t):
    return sm.year_doy_overlay(t.sim(), "y", "x", ["case"], "ts", threshold=20.0)


@query(
    "a26_daily_compare",
    "veg:s doy:i obs:6 obs_sd:6 sim:6",
    "SELECT o.veg, o.doy, o.m AS obs, o.s AS obs_sd, s.m AS sim FROM (SELECT veg, dayofyear(ts) AS doy, avg(y) AS m, stddev_samp(y) AS s FROM sim WHERE \"case\"='A' AND year(ts)=1998 GROUP BY ALL) o "
    "LEFT JOIN (SELECT veg, dayofyear(ts) AS doy, avg(z*100-273.15e0) AS m FROM sim WHERE \"case\"='R' AND year(ts)=1998 GROUP BY ALL) s USING (veg, doy)",
    "sim",
)
def _(t):
    obs = t.sim().filter("case = 'A'")
    model = t.sim().filter("case = 'R'").withColumn("z", F.col("z") * 100 - 273.15)
    return sm.daily_compare(obs, model, "veg", "y", "z", "ts", 1998)


@query(
    "time_summaries",
    "part:s veg:s season:s hour:3 doy:i year:i v_avg:6 v_sd:6",
    f"SELECT 'diurnal' AS part, veg, {season_sql()} AS season, CASE WHEN hour(ts)=0 AND minute(ts)=0 THEN 23.5e0 ELSE hour(ts)+minute(ts)/60e0-0.5e0 END AS hour, "
    "0 AS doy, 0 AS year, avg(v) AS v_avg, stddev_samp(v) AS v_sd FROM obs GROUP BY ALL UNION ALL "
    "SELECT 'daily', veg, '', 0e0, dayofyear(ts), 0, avg(v), stddev_samp(v) FROM obs GROUP BY ALL UNION ALL "
    "SELECT 'annual', veg, '', 0e0, 0, year(ts), avg(v), stddev_samp(v) FROM obs GROUP BY ALL",
    "obs",
)
def _(t):
    parts = sm.summarize_by_time(t.obs(), ["v"], ["veg"], "ts")
    none = {"season": F.lit(""), "hour": F.lit(0.0), "doy": F.lit(0), "year": F.lit(0)}

    def level(name: str, suffix: str):
        df = parts[name]
        return df.select(
            F.lit(name).alias("part"),
            "veg",
            *[F.col(c) if c in df.columns else none[c].alias(c) for c in none],
            F.col(f"v_{suffix}avg").alias("v_avg"),
            F.col(f"v_{suffix}sd").alias("v_sd"),
        )

    return rs.stack_rows(level("diurnal", "hour"), level("daily", "daily"), level("annual", "year"))


