"""Registered queries: expressions, renames, quality control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.functions import values as vl
from fluxloom.operators import derive as de
from fluxloom.operators import grid as gr
from fluxloom.operators import qc
from fluxloom.operators import reshape as rs
from fluxloom.operators.attach import from_rows
from fluxloom.plans.inputs import Tables, bin_sql, noleap_sql, season_sql
from fluxloom.plans.registry import query


@query(
    "p1_null_sentinels",
    "event_id:i v:6 w:6",
    "SELECT event_id, CASE WHEN user_id%7=0 OR user_id%11=0 THEN NULL ELSE value END AS v, "
    "CASE WHEN user_id%5=0 THEN NULL ELSE value END AS w FROM events",
)
def _(t: Tables) -> DataFrame:
    raw = t.events.select(
        "event_id",
        F.when(F.col("user_id") % 7 == 0, -9999.0)
        .when(F.col("user_id") % 11 == 0, float("nan"))
        .otherwise(F.col("value"))
        .alias("v"),
        F.when(F.col("user_id") % 5 == 0, -9999.0).otherwise(F.col("value")).alias("w"),
    )
    return qc.null_sentinels(raw)


@query("p2_null_to_zero", "sensor:s ts:t v:6", "SELECT sensor, ts, coalesce(v,0) AS v FROM grid", "grid")
def _(t):
    return qc.null_to_zero(t.grid(), ["v"])


@query(
    "p3_ts_from_ydh",
    "id:i ts:t",
    "SELECT o_orderkey AS id, o_orderdate + to_minutes(CAST((o_orderkey%48+1)*30 AS BIGINT)) AS ts FROM orders",
)
def _(t):
    parts = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("y"),
        F.dayofyear("o_orderdate").alias("d"),
        ((F.col("o_orderkey") % 48 + 1) / 2.0).alias("h"),
    )
    return parts.select("id", tp.ts_from_ydh("y", "d", "h").alias("ts"))


@query(
    "p4_civil_parts",
    "sensor:s ts:t hour:6 date:d doy:i year:i",
    "SELECT sensor, ts, CASE WHEN hour(ts)=0 AND minute(ts)=0 THEN 24 ELSE hour(ts)+minute(ts)/60e0 END AS hour, "
    "d AS date, dayofyear(d) AS doy, year(d) AS year FROM (SELECT *, CAST(ts - INTERVAL 1 SECOND AS DATE) AS d FROM sensor)",
    "sensor",
)
def _(t):
    return t.sensor().select(
        "sensor", "ts", tp.end_label_hour("ts").alias("hour"), tp.end_label_date("ts").alias("date")
    ).select("*", F.dayofyear("date").alias("doy"), F.year("date").alias("year"))


@query(
    "p5_packed_time",
    "event_id:i hour:6 clock:s date:d stamp:t model:t",
    "SELECT event_id, hour(ts)+minute(ts)/60e0 AS hour, strftime(ts,'%H:%M:00') AS clock, CAST(ts AS DATE) AS date, "
    "date_trunc('minute',ts) AS stamp, date_trunc('second',ts) AS model FROM events",
)
def _(t):
    ymd = F.year("ts") * 10000 + F.month("ts") * 100 + F.day("ts")
    hm = F.hour("ts") * 100 + F.minute("ts")
    raw = t.events.select(
        "event_id",
        hm.cast("string").alias("hhmm"),
        ymd.alias("mcdate"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).alias("mcsec"),
        F.concat(ymd.cast("string"), F.lpad(hm.cast("string"), 4, "0")).alias("packed"),
    )
    return raw.select(
        "event_id",
        tp.parse_hhmm("hhmm").alias("hour"),
        tp.hhmm_clock("hhmm").alias("clock"),
        tp.parse_yyyymmdd("mcdate").alias("date"),
        tp.parse_yyyymmddhhmm("packed").alias("stamp"),
        tp.parse_mcdate("mcdate", "mcsec").alias("model"),
    )


@query(
    "p6_halfhour_floor",
    "event_id:i hour:6 start:t end:t",
    f"SELECT event_id, hour(ts) + CASE WHEN minute(ts)>=30 THEN 0.5e0 ELSE 0e0 END AS hour, {bin_sql('start')} AS start, "
    f'{bin_sql("end")} AS "end" FROM events',
)
def _(t):
    return t.events.select(
        "event_id",
        tp.floor_halfhour(tp.decimal_hour("ts")).alias("hour"),
        tp.bin_time("ts", label="start").alias("start"),
        tp.bin_time("ts", label="end").alias("end"),
    )


@query(
    "p7_series_bounds",
    "sensor:s start:t end:t",
    "SELECT sensor, CASE WHEN min(ts)=date_trunc('day',min(ts)) THEN min(ts) ELSE date_trunc('day',min(ts)) + INTERVAL 1 DAY END "
    "AS start, date_trunc('day',max(ts)) AS \"end\" FROM sensor GROUP BY sensor",
    "sensor",
)
def _(t):
    return gr.series_bounds(t.sensor(), ["sensor"], "ts")


@query(
    "p8_zone_shift",
    "event_id:i local:t back:t",
    "SELECT event_id, date_trunc('second',ts) - INTERVAL 7 HOUR AS local, date_trunc('second',ts) AS back FROM events",
)
def _(t):
    whole = t.events.select("event_id", tp.ts_from_seconds(tp.epoch_seconds("ts")).alias("ts"))
    local = whole.withColumn("local", tp.shift_zone("ts"))
    return local.withColumn("back", tp.shift_zone("local", "-07:00", "+00:00"))


@query("p9_season", "id:i season:s", f"SELECT id, {season_sql()} AS season FROM obs", "obs")
def _(t):
    return t.obs().select("id", tp.season(F.month("ts")).alias("season"))


@query("p10_noleap_doy", "id:i doy:i", f"SELECT * FROM (SELECT id, {noleap_sql('ts')} AS doy FROM obs) WHERE doy IS NOT NULL", "obs")
def _(t):
    return t.obs().select("id", tp.noleap_doy(F.to_date("ts")).alias("doy")).filter(F.col("doy").isNotNull())


@query(
    "p11_hourmin_monday",
    "id:i hourmin:3 quarter:3 monday:4",
    "SELECT id, round_even((hour(ts)+minute(ts)/60e0)*10,0)/10 AS hourmin, round_even((hour(q)+minute(q)/60e0)*10,0)/10 AS quarter, "
    "round(month(ts)+day(ts)/100e0,2) AS monday FROM (SELECT *, ts + (id%4) * INTERVAL 15 MINUTE AS q FROM obs)",
    "obs",
)
def _(t):
    quarter = tp.plus_seconds("ts", F.col("id") % 4 * 900)
    return t.obs().select(
        "id", tp.hourmin("ts").alias("hourmin"), tp.hourmin(quarter).alias("quarter"), tp.monday_key("ts").alias("monday")
    )


@query("p12_year_mon", "id:i year_mon:s", "SELECT id, strftime(ts,'%Y-%m') AS year_mon FROM obs", "obs")
def _(t):
    return t.obs().select("id", tp.year_mon("ts").alias("year_mon"))


_UNIT_OF = {"view": "degC", "click": "kPa", "signup": "umol/m2/s", "purchase": "ratio", "error": "none"}


@query(
    "p13_convert_units",
    "event_id:i value:9 units:s carbon:9",
    "SELECT event_id, CASE event_type WHEN 'view' THEN value+273.15e0 WHEN 'click' THEN value*1000e0 "
    "WHEN 'signup' THEN value*1e-6*12.01e0 WHEN 'purchase' THEN value*100e0 ELSE value END AS value, "
    "CASE event_type WHEN 'view' THEN 'K' WHEN 'click' THEN 'Pa' WHEN 'signup' THEN 'gC/m2/s' WHEN 'purchase' THEN '%' "
    "ELSE 'none' END AS units, value*1e-6*12e0 AS carbon FROM events",
)
def _(t):
    unit = F.create_map(*[F.lit(x) for kv in _UNIT_OF.items() for x in kv])[F.col("event_type")]
    long = t.events.select("event_id", "value", unit.alias("units"), F.col("value").alias("raw"))
    rules = [r for r in vl.UNIT_RULES if r[0] in _UNIT_OF.values()]
    return de.convert_units(long, rules).select(
        "event_id", "value", "units", vl.carbon_grams("raw", 12.0).alias("carbon")
    )


@query(
    "p14_convert_by_rule",
    "event_id:i value:6 units:s",
    "SELECT event_id, CASE WHEN event_type IN ('view','click') THEN value-273.15e0 WHEN event_type='signup' THEN value*100e0 "
    "ELSE value END AS value, CASE WHEN event_type IN ('view','click') THEN 'C' WHEN event_type='signup' THEN '% mm/mm' "
    "WHEN event_type='purchase' THEN 'degC' ELSE 'W/m^2' END AS units FROM events",
)
def _(t):
    catalog = from_rows(
        t.spark,
        [
            ("view", "K", "soil temperature at level 2"),
            ("click", "K", "2m air temperature"),
            ("signup", "mm3/mm3", "volumetric soil water H2OSOI_2"),
            ("purchase", "degC", "canopy temperature"),
            ("error", "W/m^2", "sensible heat"),
        ],
        "variable string, units string, long_name string",
    )
    long = t.events.select("event_id", F.col("event_type").alias("variable"), "value")
    warm = F.col("long_name").contains("temperature") & F.col("units").contains("K")
    step1 = de.convert_where(long, catalog, warm, 1.0, -273.15, "C").withColumnRenamed("units", "u1")
    step2 = de.convert_where(step1, catalog, F.col("long_name").contains("H2OSOI"), 100.0, 0.0, "% mm/mm")
    return step2.withColumn("units", F.when(F.col("u1") == "C", "C").otherwise(F.col("units")))


_UNIT_TEXTS = [
    "gC/m^2/s", "kgC m-2", "unitless", "years since 1", "gN/yr", "meq/m^3", "neq(m^2)", "gC13/m^2", "mol/m3", "gC14 yr-1",
]


def _unit_sql(x: str) -> str:
    for token, spelling in vl.UNIT_TOKENS.items():
        x = f"regexp_replace({x}, '(^|[ ()^*/0-9]){token}($|[ ()^*/0-9]|-[0-9])', '\\1{spelling}\\2', 'g')"
    return x


@query(
    "p15_clean_units",
    "id:i units:s",
    "SELECT p_partkey AS id, "
    + _unit_sql("[" + ",".join(f"'{u}'" for u in _UNIT_TEXTS) + f"][1+CAST(p_partkey%{len(_UNIT_TEXTS)} AS INT)]")
    + " AS units FROM part",
)
def _(t):
    pick = F.get(F.array(*[F.lit(u) for u in _UNIT_TEXTS]), (F.col("p_partkey") % len(_UNIT_TEXTS)).cast("int"))
    return t.part.select(F.col("p_partkey").alias("id"), vl.clean_units(pick).alias("units"))


@query(
    "p16_derived_fluxes",
    "site:s ts:t radNet:6 ppt:6 rnet:6",
    'SELECT site, ts, ("view"-click)+(signup-purchase) AS "radNet", "view"+click AS ppt, signup-error AS rnet FROM tgrid',
    "tgrid",
)
def _(t):
    df = de.derive_radnet(t.tower_grid(), "view", "click", "signup", "purchase")
    return de.derive_diff(de.derive_sum(df, "view", "click", "ppt"), "signup", "error", "rnet")


@query(
    "p17_vpd",
    "site:s ts:t vpd:6",
    "SELECT site, ts, 6.1078e0*exp(17.08085e0*(click-50)/(234.175e0+(click-50)))*(1-CASE WHEN signup>100 THEN 100 ELSE signup END/100e0) AS vpd FROM tgrid",
    "tgrid",
)
def _(t):
    return t.tower_grid().select("site", "ts", vl.vpd_hpa(vl.clamp("signup", hi=100), F.col("click") - 50).alias("vpd"))


@query(
    "p18_rename",
    "veg:s T_upper_avg:6 T_lower_avg:6 FSH:6",
    'SELECT veg, avg(v) AS "T_upper_avg", avg(w) AS "T_lower_avg", max(v) AS "FSH" FROM obs GROUP BY veg',
    "obs",
)
def _(t):
    df = t.obs().groupBy("veg").agg(F.avg("v").alias("T_2_avg"), F.avg("w").alias("T_5_avg"), F.max("v").alias("H"))
    return rs.rename_map(rs.rename_regex(df, [("_5_", "_lower_"), ("_3_|_2_", "_upper_")]), {"H": "FSH"})


@query(
    "p19_select_like",
    "site:s ts:t signup:6 view:6",
    'SELECT site, ts, signup, "view" FROM towers',
    "towers",
)
def _(t):
    return rs.select_like(t.towers(), include=["^s", "w$", "ts"], exclude=["err"], first=["site", "ts"])


@query(
    "p20_tag_provenance",
    "site:s ts:t obs_sim:s depth:i info:s",
    "SELECT site, ts, 'Obs' AS obs_sim, 5 AS depth, 'data = ' || site || ' | letter = ' || "
    "CASE WHEN \"view\" IS NOT NULL THEN 'a' WHEN click IS NOT NULL THEN 'b' ELSE 'NA' END AS info FROM tgrid",
    "tgrid",
)
def _(t):
    df = rs.tag(t.tower_grid(), obs_sim="Obs", depth=5)
    letter = F.when(F.col("view").isNotNull(), "a").when(F.col("click").isNotNull(), "b")
    return df.withColumn("info", rs.provenance([("data", "site"), ("letter", letter)]))


@query(
    "p21_year_span",
    "veg:s years:s",
    "SELECT veg, array_to_string(generate_series(min(year(ts)),max(year(ts))),' | ') AS years FROM obs GROUP BY veg",
    "obs",
)
def _(t):
    return t.obs().groupBy("veg").agg(F.min(F.year("ts")).alias("a"), F.max(F.year("ts")).alias("b")).select(
        "veg", tp.year_span("a", "b").alias("years")
    )


@query(
    "p22_year_plus_frac",
    "id:i frac:9",
    f"SELECT id, year(ts)+({noleap_sql('ts')}-1+(hour(ts)*3600+minute(ts)*60+second(ts))/86400e0)/365e0 AS frac FROM obs",
    "obs",
)
def _(t):
    return t.obs().select("id", tp.year_plus_frac("ts").alias("frac"))


@query(
    "p23_time_mid",
    "id:i mid:t",
    "SELECT id, ts + INTERVAL 15 MINUTE + to_seconds(id%100) AS mid FROM obs",
    "obs",
)
def _(t):
    hi = tp.plus_seconds("ts", (F.col("id") % 100 * 2 + 1800).cast("int"))
    return t.obs().select("id", tp.time_mid(F.col("ts"), hi).alias("mid"))


@query(
    "p24_dummy_date",
    "id:i date:d",
    "SELECT id, DATE '2000-01-01' + CAST(dayofyear(ts) AS INT) AS date FROM obs",
    "obs",
)
def _(t):
    return t.obs().select("id", tp.dummy_date(F.dayofyear("ts")).alias("date"))


@query(
    "p25_clamp",
    "site:s ts:t view:6 click:6 signup:6",
    'SELECT site, ts, CASE WHEN "view">100 THEN 100 ELSE "view" END AS "view", CASE WHEN click<20 THEN 20 WHEN click>60 THEN 60 ELSE click END AS click, '
    "CASE WHEN signup BETWEEN 10 AND 90 THEN signup END AS signup FROM tgrid",
    "tgrid",
)
def _(t):
    df = qc.clamp(t.tower_grid(), {"view": (None, 100), "click": (20, 60)})
    return qc.null_outside(df, {"signup": (10, 90)})


@query(
    "p26_zero_and_mask",
    "site:s ts:t z:6 m:6",
    'SELECT site, ts, CASE WHEN click-50>0 THEN click-50 ELSE 0 END AS z, CASE WHEN click>40 THEN "view" END AS m FROM tgrid',
    "tgrid",
)
def _(t):
    return t.tower_grid().select(
        "site", "ts", vl.zero_below(F.col("click") - 50).alias("z"), vl.mask_below("view", "click", 40).alias("m")
    )


@query(
    "p27_depth",
    "id:i level:i depth:4 value:6",
    "SELECT vec_id AS id, i-1 AS level, -(i-1)*0.05e0 AS depth, CAST(embedding[i] AS DOUBLE) AS value "
    "FROM embeddings, (SELECT unnest(generate_series(1,64)) AS i)",
)
def _(t):
    df = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    return rs.attach_depth(df, "embedding", [0.05 * i for i in range(64)], sign=-1)


@query(
    "p28_row_mean",
    "site:s ts:t m:6",
    'SELECT site, ts, list_avg(list_filter(["view",click,signup], lambda x: x IS NOT NULL)) AS m FROM tgrid',
    "tgrid",
)
def _(t):
    return t.tower_grid().select("site", "ts", vl.row_mean("view", "click", "signup").alias("m"))


@query(
    "p29_band",
    "veg:s doy:i lo:6 hi:6",
    "SELECT veg, doy, m-CASE WHEN s=0 THEN 1e-12 ELSE s END AS lo, m+CASE WHEN s=0 THEN 1e-12 ELSE s END AS hi FROM "
    "(SELECT veg, dayofyear(ts) AS doy, avg(v) AS m, stddev_samp(v) AS s FROM obs GROUP BY ALL)",
    "obs",
)
def _(t):
    stats = t.obs().groupBy("veg", F.dayofyear("ts").alias("doy")).agg(
        F.avg("v").alias("m"), F.stddev_samp("v").alias("s")
    )
    return rs.band(stats, "m", "s")


@query(
    "p30_at_index",
    "vec_id:i embedding:6",
    "SELECT vec_id, CAST(embedding[4] AS DOUBLE) AS embedding FROM embeddings",
)
def _(t):
    return rs.at_index(t.embeddings, ["embedding"], 3)


@query(
    "p31_noleap_to_ts",
    "id:i ts:t",
    f"SELECT id, ts FROM obs WHERE {noleap_sql('ts')} IS NOT NULL",
    "obs",
)
def _(t):
    stamp = t.obs().select(
        "id",
        F.year("ts").alias("y"),
        tp.noleap_doy(F.to_date("ts")).alias("d"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60).alias("s"),
    )
    return stamp.filter(F.col("d").isNotNull()).select("id", tp.noleap_to_ts("y", "d", "s").alias("ts"))


_RULES = [
    ("East", "view", "2024-01-03", "2024-01-12", 5.0, 80.0),
    ("East", "view", "2024-01-10", "2024-01-20", None, 60.0),
    ("West", "click", "2024-01-05", "2024-01-25", 20.0, None),
    ("West", "error", "2024-01-01", "2024-01-31", None, None),
]


@query(
    "q1_range_filter",
    "event_id:i value:6",
    "SELECT event_id, CASE WHEN "
    "(user_id%2=0 AND event_type='view' AND CAST(ts AS DATE)>DATE '2024-01-03' AND CAST(ts AS DATE)<DATE '2024-01-12' AND (value>80 OR value<5)) "
    "OR (user_id%2=0 AND event_type='view' AND CAST(ts AS DATE)>DATE '2024-01-10' AND CAST(ts AS DATE)<DATE '2024-01-20' AND value>60) "
    "OR (user_id%2=1 AND event_type='click' AND CAST(ts AS DATE)>DATE '2024-01-05' AND CAST(ts AS DATE)<DATE '2024-01-25' AND value<20) "
    "THEN NULL ELSE value END AS value FROM events",
)
def _(t):
    long = t.events.select(
        "event_id",
        F.when(F.col("user_id") % 2 == 0, "East").otherwise("West").alias("site"),
        F.col("event_type").alias("variable"),
        "ts",
        "value",
    )
    rules = from_rows(
        t.spark, _RULES, "site string, variable string, start string, end string, lower double, upper double"
    ).withColumns({"start": F.col("start").cast("date"), "end": F.col("end").cast("date")})
    return qc.range_filter(long, rules)


@query(
    "q1_many_rules",
    "event_id:i value:6",
    "SELECT event_id, CASE WHEN value>u OR value<l THEN NULL ELSE value END AS value FROM events LEFT JOIN (SELECT d, max(lo) AS l, min(hi) AS u FROM "
    "(SELECT DATE '2023-12-20'+CAST(l_orderkey%45 AS INT) AS s, DATE '2023-12-20'+CAST(l_orderkey%45+l_linenumber AS INT) AS e, "
    "CASE WHEN l_partkey%3<>0 THEN l_orderkey%45+l_suppkey%7*1e0 END AS lo, CASE WHEN l_partkey%3<>1 THEN 96e0-l_suppkey%11*l_linenumber END AS hi FROM lineitem) r "
    "JOIN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) x ON x.d>s AND x.d<e GROUP BY d) t ON CAST(ts AS DATE)=t.d AND event_type='view'",
)
def _(t):
    """A rule for every line item, all on one sensor."""
    start = F.lit("2023-12-20").cast("date")
    day = (F.col("l_orderkey") % 45).cast("int")
    rules = t.lineitem.select(
        F.lit("all").alias("site"),
        F.lit("view").alias("variable"),
        F.date_add(start, day).alias("start"),
        F.date_add(start, day + F.col("l_linenumber").cast("int")).alias("end"),
        F.when(F.col("l_partkey") % 3 != 0, (day + F.col("l_suppkey") % 7).cast("double")).alias("lower"),
        F.when(F.col("l_partkey") % 3 != 1, (96 - F.col("l_suppkey") % 11 * F.col("l_linenumber")).cast("double")).alias("upper"),
    )
    rows = t.events.select("event_id", F.lit("all").alias("site"), F.col("event_type").alias("variable"), "ts", "value")
    return qc.range_filter(rows, rules)


@query(
    "q1_range_filter_wide",
    "site:s ts:t view:6 click:6",
    "SELECT site, ts, CASE WHEN (d>DATE '2024-01-03' AND d<DATE '2024-01-12' AND (\"view\">80 OR \"view\"<5)) OR "
    "(d>DATE '2024-01-10' AND d<DATE '2024-01-20' AND \"view\">60) THEN NULL ELSE \"view\" END AS \"view\", "
    "CASE WHEN d>DATE '2024-01-05' AND d<DATE '2024-01-25' AND click<20 THEN NULL ELSE click END AS click "
    "FROM (SELECT *, CAST(ts AS DATE) AS d FROM tgrid)",
    "tgrid",
)
def _(t):
    return qc.range_filter_wide(t.tower_grid(), [r[1:] for r in _RULES])


_FLAG_SQL = "CASE k%10 WHEN 0 THEN 'm' WHEN 1 THEN 'mq' WHEN 2 THEN 'q' WHEN 3 THEN 'ok' END"
_FLAGGED = f"(SELECT *, {_FLAG_SQL} AS flag FROM (SELECT *, CAST(regexp_extract(props,'[0-9]+') AS INT) AS k FROM events))"


@query(
    "q2_null_flagged",
    "event_id:i v:6 w:6",
    "SELECT event_id, CASE WHEN flag IN ('m','mq','q') THEN NULL ELSE value END AS v, "
    f"CASE WHEN flag IS NULL THEN value END AS w FROM {_FLAGGED}",
)
def _(t):
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int") % 10
    flag = F.when(k == 0, "m").when(k == 1, "mq").when(k == 2, "q").when(k == 3, "ok")
    df = t.events.select("event_id", F.col("value").alias("v"), F.col("value").alias("w"), flag.alias("flag"))
    return qc.null_flagged(qc.null_flagged(df, {"v": "flag"}), {"w": "flag"}, bad=None)


@query(
    "q3_null_where",
    "site:s ts:t view:6",
    'SELECT site, ts, CASE WHEN click-50>0 THEN "view" END AS "view" FROM tgrid',
    "tgrid",
)
def _(t):
    return qc.null_where(t.tower_grid(), "view", F.col("click") - 50 > 0)


@query(
    "q4_between_days",
    "event_id:i ts:t",
    "SELECT event_id, ts FROM events WHERE ts>=TIMESTAMP '2024-01-05' AND ts<=TIMESTAMP '2024-01-20'",
)
def _(t):
    return qc.between_days(t.events, "ts", "2024-01-05", "2024-01-20")


@query(
    "q5_categories",
    "id:i veg:s",
    "SELECT id, veg FROM obs WHERE veg IN ('1-URGENT','2-HIGH','5-LOW') AND veg NOT IN ('5-LOW') AND month(ts)=7 AND year(ts)>=1997",
    "obs",
)
def _(t):
    df = qc.not_in_categories(qc.in_categories(t.obs(), "veg", ["1-URGENT", "2-HIGH", "5-LOW"]), "veg", ["5-LOW"])
    return df.filter((F.month("ts") == 7) & (F.year("ts") >= 1997))


@query(
    "q6_drop_leap_day",
    "year:i month:i n:i",
    "SELECT year(ts) AS year, month(ts) AS month, count(*) AS n FROM obs WHERE strftime(ts,'%m-%d')<>'02-29' GROUP BY ALL",
    "obs",
)
def _(t):
    return qc.drop_leap_day(t.obs(), "ts").groupBy(F.year("ts").alias("year"), F.month("ts").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "q7_season_mask",
    "id:i v:6",
    "SELECT id, CASE WHEN dayofyear(ts)>135 AND dayofyear(ts)<273 THEN v ELSE 0 END AS v FROM obs",
    "obs",
)
def _(t):
    return qc.season_mask(t.obs(), "ts", ["v"])


@query(
    "q8_check_unique",
    "veg:s ts:t n:i",
    "SELECT veg, ts, count(*) AS n FROM obs GROUP BY ALL HAVING count(*)>1",
    "obs",
)
def _(t):
    return qc.check_unique(t.obs(), ["veg", "ts"])


@query(
    "q8_check_grid",
    "sensor:s ts:t problem:s",
    "SELECT k.sensor, g.ts, 'missing' AS problem FROM (SELECT DISTINCT sensor FROM sensor) k CROSS JOIN steps g "
    "WHERE NOT EXISTS (SELECT 1 FROM sensor x WHERE x.sensor=k.sensor AND x.ts=g.ts) "
    "UNION ALL SELECT sensor, ts, 'off grid' FROM sensor WHERE ts NOT IN (SELECT ts FROM steps)",
    "steps",
)
def _(t):
    return qc.check_grid(t.sensor(), t.grid(), ["sensor", "ts"])


@query(
    "q8_check_dims",
    "vec_id:i variable:s dimension:i expected:i found:i",
    "SELECT vec_id, 'flat' AS variable, 1 AS dimension, 64 AS expected, 64-vec_id%3 AS found FROM embeddings WHERE vec_id%3<>0 UNION ALL "
    "SELECT vec_id, 'nested', 2, 64, 64-vec_id%3 FROM embeddings WHERE vec_id%3<>0 UNION ALL SELECT vec_id, 'nested', 1, 2, 1 FROM embeddings WHERE vec_id%5=0",
)
def _(t):
    flat = F.slice("embedding", 1, (64 - F.col("vec_id") % 3).cast("int"))
    nested = F.when(F.col("vec_id") % 5 == 0, F.array("flat")).otherwise(F.array("flat", "flat"))
    df = t.embeddings.withColumn("flat", flat).withColumn("nested", nested)
    return qc.check_dims(df, ["vec_id"], {"flat": [64], "nested": [2, 64]})


@query(
    "q8_check_conservation",
    "day:d sensor:s difference:4",
    "SELECT a.day, a.sensor, a.s - b.s AS difference FROM (SELECT CAST(ts AS DATE) AS day, event_type AS sensor, sum(value) AS s "
    "FROM events WHERE value<=200 GROUP BY ALL) a JOIN (SELECT CAST(ts AS DATE) AS day, event_type AS sensor, sum(value) AS s "
    "FROM events GROUP BY ALL) b USING (day, sensor) WHERE abs(a.s-b.s)>1e-7",
)
def _(t):
    fine = t.events.select(F.to_date("ts").alias("day"), F.col("event_type").alias("sensor"), "value")
    coarse = fine.groupBy("day", "sensor").agg(F.sum("value").alias("total"))
    return qc.check_conservation(fine.filter("value <= 200"), coarse, ["day", "sensor"], "value", "total")


@query(
    "q9_qc_compare",
    "variable:s Filtered:s n:i known:i",
    "SELECT variable, \"Filtered\", count(*) AS n, count(value) AS known FROM (SELECT 'view' AS variable, 'unfiltered' AS \"Filtered\", \"view\" AS value FROM tgrid "
    "UNION ALL SELECT 'click','unfiltered',click FROM tgrid UNION ALL SELECT 'view','filtered',CASE WHEN \"view\" <= 60 THEN \"view\" END FROM tgrid "
    "UNION ALL SELECT 'click','filtered',CAST(NULL AS DOUBLE) FROM tgrid) GROUP BY ALL HAVING count(value)>0",
    "tgrid",
)
def _(t):
    before = t.tower_grid()
    after = qc.null_outside(before, {"view": (None, 60), "click": (1e9, None)})
    both = qc.qc_compare(before, after, ["view", "click"], ["site", "ts"])
    return both.groupBy("variable", "Filtered").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("known"))


@query(
    "q10_complete_pairs",
    "site:s ts:t view:6 click:6",
    'SELECT site, ts, "view", click FROM tgrid WHERE "view" IS NOT NULL AND click IS NOT NULL',
    "tgrid",
)
def _(t):
    return qc.complete_pairs(t.tower_grid(), "view", "click")


@query(
    "s11_plot_dimension",
    "name:s code:s",
    "SELECT n_name AS name, CASE WHEN n_name LIKE '%\\_1%' ESCAPE '\\' THEN 'DM' WHEN n_name LIKE '%2%' THEN 'MM' END AS code FROM nation",
)
def _(t):
    from fluxloom.operators.joins import classify

    return classify(t.nation.select(F.col("n_name").alias("name")), "name", [("_1", "DM"), ("2", "MM")], "code")


