"""Registered queries: file sources and sinks, written and read back.

Each query writes what it reads below the shared folder: measurement files of
the given shape are made by Spark from the supplied tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import fill as fl
from fluxloom.operators import summarize as sm
from fluxloom.plans.inputs import KINDS, bin_sql, season_sql
from fluxloom.plans.registry import query, scratch
from fluxloom.sources import readers as rd
from fluxloom.sources import sinks as sk

_TOWER_COLS = " ".join(f"{k}:6" for k in KINDS)
_TOWER_SQL = "SELECT site, ts, " + ", ".join(f'"{k}"' for k in KINDS) + " FROM tgrid"


def _tower_file(t) -> str:
    """Year, DoY, Hour and measures, as tower files have them."""
    path = scratch(t, "tower")
    day = tp.end_label_date("ts")
    table = t.tower_grid().select(
        F.when(F.col("site") == "East", 1).otherwise(2).alias("Tower"),
        F.year(day).alias("Year"), F.dayofyear(day).alias("DoY"), tp.end_label_hour("ts").alias("Hour"), *KINDS,
    )
    sk.write_units_table(rd.with_units(table, {"Hour": "--", "view": "Wm-2", "click": "degC"}), path)
    return path


@query("s1_read_units_table", f"site:s ts:t {_TOWER_COLS}", _TOWER_SQL, "tgrid")
def _(t):
    types = {"Tower": "int", "Year": "int", "DoY": "int"}
    df = rd.read_units_table(t.spark, _tower_file(t), types)
    return df.select(
        F.when(F.col("Tower") == 1, "East").otherwise("West").alias("site"),
        tp.ts_from_ydh("Year", "DoY", "Hour").alias("ts"), *KINDS,
    )


@query(
    "k1_write_units_table",
    "rows:i missing:i",
    "SELECT count(*) AS rows, " + "+".join(f'count(*) FILTER (WHERE "{k}" IS NULL)' for k in KINDS) + " AS missing FROM tgrid",
    "tgrid",
)
def _(t):
    lines = t.spark.read.text(_tower_file(t)).filter(~F.col("value").startswith("Tower") & ~F.col("value").startswith("--"))
    holes = F.size(F.filter(F.split("value", "\t"), lambda x: x == "-9999"))
    return lines.agg(F.count(F.lit(1)).alias("rows"), F.sum(holes).alias("missing"))


_GAUGE = (
    ["station", "utc_date", "utc_time", "lon", "precipitation"],
    ["string", "string", "string", "double", "double"],
)


@query(
    "s2_read_whitespace_table",
    "station:s ts:t precipitation:6",
    f"SELECT CAST(user_id AS VARCHAR) AS station, {bin_sql('start')} AS ts, CASE WHEN count(*) FILTER (WHERE value<1)=0 THEN sum(value) END AS precipitation "
    "FROM events GROUP BY ALL",
)
def _(t):
    from fluxloom.operators.grid import rebin

    path = scratch(t, "gauge")
    day = F.year("ts") * 10000 + F.month("ts") * 100 + F.day("ts")
    clock = F.lpad((F.hour("ts") * 100 + F.minute("ts")).cast("string"), 4, "0")
    amount = F.when(F.col("value") < 1, F.lit("-9999")).otherwise(F.col("value").cast("string"))
    line = F.concat_ws("   ", F.col("user_id").cast("string"), day.cast("string"), clock, F.lit("-105.50"), amount)
    t.events.select(F.concat(F.lit("  "), line).alias("value")).write.text(path)
    raw = rd.read_whitespace_table(t.spark, path, *_GAUGE)
    stamp = F.concat("utc_date", "utc_time")
    gauge = raw.select("station", tp.parse_yyyymmddhhmm(stamp).alias("ts"), "precipitation")
    return rebin(gauge, ["station"], "ts", {"precipitation": "sum"}, null="strict")


@query(
    "s3_read_preamble_csv",
    "ts:t site:s light:6",
    'SELECT ts, site, "view" AS light FROM tgrid',
    "tgrid",
)
def _(t):
    path = scratch(t, "radiation")
    stamp = F.format_string(
        "%04d%02d%02d%02d%02d", F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts"), F.minute("ts")
    )
    line = F.concat_ws(",", stamp, "site", F.coalesce(F.col("view").cast("string"), F.lit("-9999")))
    head = ["# Site: X", "# Version: 1", "STAMP,SITE,SW_IN"]
    sk.write_lines(t.tower_grid().select(line.alias("value")), path, head)
    df = rd.read_preamble_csv(t.spark, path, {"STAMP": "string", "SITE": "string"})
    return df.select(tp.parse_yyyymmddhhmm("STAMP").alias("ts"), F.col("SITE").alias("site"), F.col("SW_IN").alias("light"))


@query(
    "s4_read_typed_csv",
    "id:i veg:s ts:t v:6",
    "SELECT id, veg, ts, CASE WHEN id%5=0 OR id%7=0 OR id%11=0 THEN NULL ELSE v END AS v FROM obs",
    "obs",
)
def _(t):
    path = scratch(t, "typed")
    missing = F.when(F.col("id") % 5 == 0, "NA").when(F.col("id") % 7 == 0, "NaN").when(F.col("id") % 11 == 0, "")
    text = F.coalesce(missing, F.col("v").cast("string"))
    t.obs().select("id", "veg", F.col("ts").cast("string").alias("ts"), text.alias("v")).write.csv(
        path, header=True, quoteAll=True
    )
    return rd.read_typed_csv(t.spark, path, {"id": "bigint", "veg": "enumerated", "ts": "dateTime", "v": "numeric"})


@query(
    "s5_read_many",
    "event_id:i value:6 user_id:i",
    "SELECT event_id, value, NULL AS user_id FROM events WHERE ts<TIMESTAMP '2024-01-15' UNION ALL "
    "SELECT event_id, value, user_id FROM events WHERE ts>=TIMESTAMP '2024-01-15'",
)
def _(t):
    base = scratch(t, "years")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    t.events.filter(F.col("ts") < split).select("event_id", "value").write.csv(f"{base}/1", header=True)
    t.events.filter(F.col("ts") >= split).select("event_id", "value", "user_id").write.csv(f"{base}/2", header=True)
    first = {"event_id": "bigint", "value": "numeric"}
    columns = {f"{base}/1": first, f"{base}/2": {**first, "user_id": "bigint"}}
    return rd.read_many(list(columns), lambda p: rd.read_typed_csv(t.spark, p, columns[p]))


@query(
    "s6_read_history",
    "case:s veg:s year:i n:i x:6",
    'SELECT "case", veg, year(ts) AS year, count(*) AS n, avg(x) AS x FROM sim WHERE "case" IN (\'A\',\'R\') AND year(ts) BETWEEN 1997 AND 1999 GROUP BY ALL',
    "sim",
)
def _(t):
    root = scratch(t, "history")
    sk.write_history(t.sim(), root, "ts")
    df = rd.read_history(t.spark, root, ["A", "R"], 1997, 1999)
    return df.groupBy("case", "veg", "year").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x"))


@query(
    "s10_read_stage",
    "stage:s veg:s season:s hour:3 year:i doy:i v_avg:6",
    f"SELECT 'diurnal' AS stage, veg, {season_sql()} AS season, CASE WHEN hour(ts)=0 AND minute(ts)=0 THEN 23.5e0 ELSE hour(ts)+minute(ts)/60e0-0.5e0 END AS hour, 0 AS year, 0 AS doy, avg(v) AS v_avg FROM obs "
    f"GROUP BY ALL UNION ALL SELECT 'annual', veg, 'year', 0e0, year(ts), 0, avg(v) FROM obs GROUP BY ALL UNION ALL SELECT 'daily', veg, 'day', 0e0, 0, dayofyear(ts), avg(v) FROM obs GROUP BY ALL "
    "UNION ALL SELECT 'all', veg, 'none', CASE WHEN hour(ts)=0 AND minute(ts)=0 THEN 23.5e0 ELSE hour(ts)+minute(ts)/60e0-0.5e0 END, year(ts), dayofyear(ts), v FROM obs",
    "obs",
)
def _(t):
    """Every written stage, read back."""
    base = scratch(t, "stages")
    for name, df in sm.summarize_by_time(t.obs(), ["v"], ["veg"], "ts").items():
        sk.write_stage(df, base, name)
    none = F.lit(0)
    whole = {
        "diurnal": ("season", "hour", none, none, "v_houravg"),
        "annual": (F.lit("year"), F.lit(0.0), "year", none, "v_yearavg"),
        "daily": (F.lit("day"), F.lit(0.0), none, "doy", "v_dailyavg"),
        "all": (F.lit("none"), "hour", F.year("ts"), F.dayofyear("ts"), "v"),
    }
    names = ("season", "hour", "year", "doy", "v_avg")
    parts = []
    for stage, columns in whole.items():
        shown = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(columns, names, strict=True)]
        parts.append(rd.read_stage(t.spark, base, stage).select(F.lit(stage).alias("stage"), "veg", *shown))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "k5_write_stages",
    "stage:s n:i",
    f"SELECT 'diurnal' AS stage, count(*) AS n FROM (SELECT DISTINCT veg, {season_sql()}, hour(ts), minute(ts) FROM obs) UNION ALL "
    "SELECT 'daily', count(*) FROM (SELECT DISTINCT veg, dayofyear(ts) FROM obs) UNION ALL "
    "SELECT 'annual', count(*) FROM (SELECT DISTINCT veg, year(ts) FROM obs) UNION ALL SELECT 'all', count(*) FROM obs",
    "obs",
)
def _(t):
    from fluxloom.operators.reshape import stack_rows

    base = scratch(t, "stages")
    parts = sm.summarize_by_time(t.obs(), ["v"], ["veg"], "ts")
    for name, df in parts.items():
        sk.write_stage(df, base, name)
    return stack_rows(
        *[
            rd.read_stage(t.spark, base, name).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(name))
            for name in parts
        ]
    )


@query(
    "s12_variable_catalog",
    "variable:s units:s long_name:s rows:i",
    "SELECT v.variable, v.units, v.long_name, e.n AS rows FROM (VALUES ('event_id',NULL,NULL),('event_type',NULL,NULL),('props',NULL,NULL),('ts',NULL,NULL),"
    "('user_id',NULL,NULL),('value','Wm-2','incoming')) v(variable,units,long_name), (SELECT count(*) AS n FROM events) e",
)
def _(t):
    df = rd.with_units(t.events, {"value": "Wm-2"}, {"value": "incoming"})
    catalog = rd.variable_catalog(df)
    counts = df.select(*[F.lit(1).alias(c) for c in df.columns]).agg(*[F.count(c).alias(c) for c in df.columns])
    return catalog.join(counts.unpivot([], df.columns, "variable", "rows"), "variable")


@query(
    "k2_write_flagged",
    "ts:t view:6 view_flag:s",
    "SELECT b.ts, coalesce(b.\"view\",f.\"view\") AS \"view\", CASE WHEN b.\"view\" IS NOT NULL THEN 'n' WHEN f.\"view\" IS NOT NULL THEN 's' ELSE 'm' END AS view_flag "
    "FROM tgrid b JOIN tgrid f ON b.ts=f.ts AND b.site='East' AND f.site='West'",
    "tgrid",
)
def _(t):
    path = scratch(t, "flagged")
    roles = t.tower_grid().withColumn("role", F.when(F.col("site") == "East", "base").otherwise("fill"))
    legend = {"n": "value of the base tower", "s": "taken from the fill tower", "m": "missing in both"}
    sk.write_flagged(fl.fill_two_sources(roles, ["ts"], "role", ["view"]), path, legend)
    return t.spark.read.parquet(path)


@query(
    "k3_write_forcing",
    "site:s year_mon:s time:6 FSDS:6 TBOT:6",
    "SELECT site, strftime(ts,'%Y-%m') AS year_mon, (row_number() OVER (PARTITION BY site, strftime(ts,'%Y-%m') ORDER BY ts)-1)/48e0 AS time, "
    '"view" AS "FSDS", click+273.15e0 AS "TBOT" FROM tgrid',
    "tgrid",
)
def _(t):
    path = scratch(t, "forcing")
    g = t.tower_grid().select("site", "ts", F.col("view").alias("Rg"), (F.col("click") + 273.15).alias("Tair"))
    sk.write_forcing(g, path, ["site"], "ts", {"title": "forcing"})
    return t.spark.read.parquet(f"{path}/data")


@query("k4_export_series", "ts:t v:6", "SELECT ts, v FROM sensor WHERE sensor='error'", "sensor")
def _(t):
    path = scratch(t, "runoff")
    sk.export_series(t.sensor().filter("sensor = 'error'"), ["ts", "v"], path)
    return rd.read_typed_csv(t.spark, path, {"ts": "dateTime", "v": "numeric"})
