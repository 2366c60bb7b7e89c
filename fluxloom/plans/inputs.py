"""The supplied tables seen as sensor, tower, observation and model series.

Every input exists twice: as a DataFrame built with the library's operators
and as a SQL common table expression written independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.operators import grid as gr
from fluxloom.operators import segments as sg
from fluxloom.operators.mds import STAGES
from fluxloom.session import settle

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

#: Event types, in the roles they play as tower variables.
KINDS = ("view", "click", "signup", "purchase", "error")
#: Order priorities, standing for vegetation communities.
COMMUNITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


class Tables:
    """Tables of one folder; ``t.events`` reads ``events.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sensor(self) -> DataFrame:
        """Half-hour means per event type, interval-end labels, with natural gaps."""
        events = self.events.select(F.col("event_type").alias("sensor"), "ts", F.col("value").alias("v"))
        return gr.rebin(events, ["sensor"], "ts", {"v": "mean"}, label="end")

    def grid(self) -> DataFrame:
        """Re-binned once: the span and the rows of the grid read what is settled."""
        return gr.complete_grid(settle(self.sensor()), ["sensor"], "ts")

    def segments(self, seconds: int) -> DataFrame:
        """The grid staged for ordered work."""
        return sg.stage(self.grid(), ["sensor"], "ts", seconds)

    def towers(self) -> DataFrame:
        """Two towers (by user parity) with one column per event type."""
        site = F.when(F.col("user_id") % 2 == 0, "East").otherwise("West")
        wide = self.events.select(
            site.alias("site"), "ts", *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in KINDS]
        )
        return gr.rebin(wide, ["site"], "ts", {k: "mean" for k in KINDS}, label="end")

    def stationed(self) -> DataFrame:
        """Events of three stations (by user), each with two towers."""
        return self.events.selectExpr("CAST(user_id % 3 AS BIGINT) AS station", "CASE WHEN user_id % 2 = 0 THEN 'East' ELSE 'West' END AS site", "*")

    def station_towers(self) -> tuple[DataFrame, DataFrame]:
        """Towers of three stations, and each station's hourly readings."""
        kinds = [F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in ("view", "click")]
        towers = gr.rebin(
            self.stationed().select("station", "site", "ts", *kinds), ["station", "site"], "ts", {"view": "mean", "click": "mean"}, label="end"
        )
        errors = self.stationed().where("event_type = 'error'").select("station", "ts", F.col("value").alias("v"))
        hourly = gr.rebin(errors, ["station"], "ts", {"v": "mean"}, label="end").where(F.minute("ts") == 0)
        return towers, hourly

    def tower_grid(self) -> DataFrame:
        return gr.complete_grid(settle(self.towers()), ["site"], "ts")

    def obs(self) -> DataFrame:
        """Several years of observations of five communities."""
        slot = (F.col("o_orderkey") % 48).cast("int") * 1800
        return self.orders.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("veg"),
            tp.plus_seconds("o_orderdate", slot).alias("ts"),
            (F.col("o_totalprice") / 1000.0).alias("v"),
            (F.col("o_custkey") % 97 - 48.0).alias("w"),
        )

    def sim(self) -> DataFrame:
        """Several years of three simulated cases."""
        slot = (F.col("l_orderkey") % 48).cast("int") * 1800
        return self.lineitem.select(
            F.col("l_returnflag").alias("case"),
            F.col("l_linestatus").alias("veg"),
            tp.plus_seconds("l_shipdate", slot).alias("ts"),
            F.col("l_quantity").alias("x"),
            (F.col("l_extendedprice") / 1000.0).alias("y"),
            F.col("l_discount").alias("z"),
        )

    def daily(self) -> DataFrame:
        """Daily mean of the observations per community."""
        return (
            self.obs()
            .groupBy("veg", F.to_date("ts").alias("date"))
            .agg(F.avg("v").alias("v"), F.avg("w").alias("w"))
        )

    def daily_ts(self) -> DataFrame:
        return self.daily().select("veg", F.col("date").cast("timestamp_ntz").alias("ts"), "v", "w")


def bin_sql(label: str = "end", ts: str = "ts") -> str:
    plus = "+1" if label == "end" else ""
    return f"make_timestamp((epoch_us({ts})//1800000000{plus})*1800000000)"


def season_sql(ts: str = "ts") -> str:
    return (
        f"CASE WHEN month({ts}) IN (12,1,2) THEN 'DJF' WHEN month({ts}) IN (3,4,5) THEN 'MAM' "
        f"WHEN month({ts}) IN (6,7,8) THEN 'JJA' ELSE 'SON' END"
    )


def leap_sql(year: str) -> str:
    return f"(({year}) % 4 = 0 AND (({year}) % 100 <> 0 OR ({year}) % 400 = 0))"


def noleap_sql(d: str) -> str:
    return (
        f"CASE WHEN month({d})=2 AND day({d})=29 THEN NULL "
        f"ELSE dayofyear({d}) - CASE WHEN {leap_sql(f'year({d})')} AND dayofyear({d})>59 THEN 1 ELSE 0 END END"
    )


_MDS_STAGES = ", ".join(
    f"({i},{m},{d})" for i, (m, d) in enumerate((m, d) for m, days in STAGES for d in days)
)


def mds_sql(base: str, also: str = "NULL") -> str:
    """Every gap against every donor, all stages side by side, the first sufficient one taken."""
    return (
        "SELECT b.site, b.variable, b.ts, b.y AS value, coalesce(b.y, r.m) AS filled, r.m AS model, r.method, "
        'CASE WHEN r.method=3 THEN 2*r.half+1 ELSE 2*r.half END AS "window", r.n, r.sd, CASE WHEN b.y IS NOT NULL THEN 0 '
        "WHEN r.method=1 THEN CASE WHEN 2*r.half<=14 THEN 1 WHEN 2*r.half<=56 THEN 2 ELSE 3 END "
        "WHEN r.method=2 THEN CASE WHEN 2*r.half<=14 THEN 1 WHEN 2*r.half<=28 THEN 2 ELSE 3 END "
        "WHEN r.method=3 THEN CASE WHEN 2*r.half+1<=1 THEN 1 WHEN 2*r.half+1<=5 THEN 2 ELSE 3 END END AS fqc "
        f"FROM {base} b LEFT JOIN (SELECT site, variable, pos, arg_min(m, ord) AS m, arg_min(sd, ord) AS sd, arg_min(n, ord) AS n, "
        "arg_min(method, ord) AS method, arg_min(half, ord) AS half FROM (SELECT p.site, p.variable, p.pos, s.ord, s.method, s.half, "
        "avg(p.y) AS m, stddev_samp(p.y) AS sd, count(*) AS n FROM (SELECT g.site, g.variable, g.pos, d.y, abs(d.pos-g.pos) AS away, "
        "abs(CAST(round((d.pos-g.pos)/48e0) AS INT)) AS k, abs((d.pos-g.pos) - 48*CAST(round((d.pos-g.pos)/48e0) AS INT)) AS o, "
        "abs(d.rg-g.rg) < greatest(least(50e0, g.rg), 20e0) AND g.rg IS NOT NULL AND d.rg IS NOT NULL AS a1, "
        f"abs(d.vpd-g.vpd) < 5 AND abs(d.ta-g.ta) < 2.5 AS a23 FROM {base} g JOIN {base} d ON g.site=d.site AND g.variable=d.variable "
        f"AND d.y IS NOT NULL AND (g.y IS NULL OR g.variable={also}) AND abs(d.pos-g.pos) <= 210*48+2) p "
        f"JOIN (VALUES {_MDS_STAGES}) s(ord, method, half) ON (s.method=1 AND away<=half*48 AND a1 AND a23) OR (s.method=2 AND away<=half*48 AND a1) "
        "OR (s.method=3 AND k<=half AND o<=2) GROUP BY ALL HAVING count(*)>=2) GROUP BY ALL) r "
        "ON r.site=b.site AND r.variable=b.variable AND r.pos=b.pos"
    )


def sun_sql(lat: str = "40.0e0", lon: str = "-105.5e0", zone: str = "-7e0") -> str:
    """Sine of the sun's height."""
    a = "(2*pi()*(dayofyear(ts)-1)/365e0)"
    decl = "(radians(23.45e0)*sin(2*pi()*(284+dayofyear(ts))/365e0))"
    eot = f"(229.18e0*(0.000075e0+0.001868e0*cos({a})-0.032077e0*sin({a})-0.014615e0*cos(2*{a})-0.040849e0*sin(2*{a})))"
    angle = f"radians((hour(ts)+minute(ts)/60e0+(4e0*({lon}-15e0*({zone}))+{eot})/60e0-12e0)*15e0)"
    return f"(sin(radians({lat}))*sin({decl})+cos(radians({lat}))*cos({decl})*cos({angle}))"


def flow_sql(base: str, fill: str, light: str, rain: str, rains: str, lights: str) -> str:
    """One tower filled from the other, beside rain and radiation."""
    nee = "2e0*exp(200e0*(1e0/61.02e0-1e0/(click/10e0-5+46.02e0)))*(1+(purchase-50)/500e0)"
    return (
        "SELECT *, 6.1078e0*exp(17.08085e0*tair/(234.175e0+tair))*(1-rh/100e0) AS vpd FROM (SELECT b.ts, "
        "CASE WHEN coalesce(b.nee,f.nee) BETWEEN -100 AND 100 THEN coalesce(b.nee,f.nee) END AS nee, coalesce(b.click,f.click)/10e0-5 AS tair, "
        f"CASE WHEN coalesce(b.signup,f.signup)>100 THEN 100 ELSE coalesce(b.signup,f.signup) END AS rh, {rain}/1800e0 AS prect, "
        f"CASE WHEN {light}<0 THEN 0 WHEN {light}>1200 THEN 1200 ELSE {light} END AS rg FROM "
        f"(SELECT *, {nee} AS nee FROM {base}) b JOIN (SELECT *, {nee} AS nee FROM {fill}) f ON f.ts=b.ts LEFT JOIN {rains} LEFT JOIN {lights})"
    )


def _long_sql(site: str, wide: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{site}' AS site, ts, '{name}' AS variable, CAST(epoch(ts) AS BIGINT)//1800 AS pos, rg, vpd, tair AS ta, {col} AS y FROM {wide}"
        for name, col in (("NEE", "nee"), ("Tair", "tair"), ("PRECTmms", "prect"), ("Rg", "rg"), ("VPD", "vpd"))
    )


_KIND_COLS = ", ".join(f"avg(value) FILTER (WHERE event_type='{k}') AS {k}" for k in KINDS)

#: Name: (expressions it needs, SQL).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "sensor": ((), f"SELECT event_type AS sensor, {bin_sql()} AS ts, avg(value) AS v FROM events GROUP BY ALL"),
    "span": (
        ("sensor",),
        "SELECT CASE WHEN min(ts)=date_trunc('day',min(ts)) THEN min(ts) "
        "ELSE date_trunc('day',min(ts)) + INTERVAL 1 DAY END AS s, date_trunc('day',max(ts)) AS e FROM sensor",
    ),
    "steps": (("span",), "SELECT unnest(generate_series(s + INTERVAL 30 MINUTE, e, INTERVAL 30 MINUTE)) AS ts FROM span"),
    "grid": (
        ("steps",),
        "SELECT k.sensor, g.ts, x.v FROM (SELECT DISTINCT sensor FROM sensor) k CROSS JOIN steps g "
        "LEFT JOIN sensor x ON x.sensor=k.sensor AND x.ts=g.ts",
    ),
    "towers": (
        (),
        f"SELECT CASE WHEN user_id%2=0 THEN 'East' ELSE 'West' END AS site, {bin_sql()} AS ts, {_KIND_COLS} "
        "FROM events GROUP BY ALL",
    ),
    "tgrid": (
        ("steps", "towers"),
        "SELECT k.site, g.ts, " + ", ".join(f'x."{k}"' for k in KINDS)
        + " FROM (SELECT DISTINCT site FROM towers) k CROSS JOIN steps g "
        "LEFT JOIN towers x ON x.site=k.site AND x.ts=g.ts",
    ),
    "obs": (
        (),
        "SELECT o_orderkey AS id, o_orderpriority AS veg, o_orderdate + to_minutes(CAST((o_orderkey%48)*30 AS BIGINT)) AS ts, "
        "o_totalprice/1000e0 AS v, (o_custkey%97 - 48)*1e0 AS w FROM orders",
    ),
    "sim": (
        (),
        'SELECT l_returnflag AS "case", l_linestatus AS veg, '
        "l_shipdate + to_minutes(CAST((l_orderkey%48)*30 AS BIGINT)) AS ts, "
        "l_quantity AS x, l_extendedprice/1000e0 AS y, l_discount AS z FROM lineitem",
    ),
    "d": (
        ("sim",),
        'SELECT "case", h, y, row_number() OVER (PARTITION BY "case" ORDER BY h)-1 AS r, count(*) OVER (PARTITION BY "case") AS n '
        'FROM (SELECT "case", round(hour(ts)+minute(ts)/60e0,1) AS h, avg(y) AS y FROM sim GROUP BY ALL)',
    ),
    "fine": (
        (),
        f"SELECT CAST(ts AS DATE) AS date, {bin_sql('start')} AS ts, coalesce(sum(CASE WHEN event_type='view' AND value>30 "
        "AND day(ts)%5<>0 THEN value END),0) AS w FROM events GROUP BY ALL",
    ),
    "rainfine": (
        (),
        f"SELECT CAST(ts AS DATE) AS date, {bin_sql('start')} AS ts, coalesce(CASE WHEN count(*) FILTER (WHERE value<=1)=0 "
        "THEN sum(value) END, 0) AS w FROM events WHERE event_type<>'purchase' GROUP BY ALL",
    ),
    "exchange": (
        ("tgrid",),
        "SELECT *, CASE WHEN nee IS NOT NULL THEN nee ELSE v0+(v1-v0)*(epoch(ts)-epoch(t0))/(epoch(t1)-epoch(t0)) END AS nee_f FROM (SELECT *, "
        "last_value(nee IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN nee IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0, "
        "first_value(nee IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN nee IS NOT NULL THEN ts END IGNORE NULLS) OVER f AS t1 FROM "
        "(SELECT site, ts, \"view\"*2-80 AS rg, coalesce(click/10e0,5e0) AS ta, 2e0*exp(200e0*(1e0/61.02e0-1e0/(click/10e0+46.02e0)))*(1+(purchase-50)/500e0) AS nee FROM tgrid) "
        "WINDOW b AS (PARTITION BY site ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "f AS (PARTITION BY site ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))",
    ),
    "rrefs": (
        ("exchange",),
        "SELECT site, make_timestamp(CAST(floor(avg(CAST(epoch(ts) AS BIGINT))) AS BIGINT)*1000000) AS ts, sum(s*nee)/sum(s*s) AS rref FROM "
        f"(SELECT site, ts, nee, exp(200e0*(1e0/61.02e0-1e0/(ta+46.02e0))) AS s, CAST(epoch(ts) AS BIGINT)//86400 AS d FROM exchange WHERE rg<10 AND {sun_sql()}<0 AND nee IS NOT NULL) x "
        "JOIN (SELECT unnest(generate_series(4900,5000)) AS k) w ON x.d BETWEEN 4*k-4 AND 4*k+4 GROUP BY site, k HAVING count(*)>=2 AND sum(s*nee)>0",
    ),
    "nightx": (
        ("exchange",),
        "SELECT site, CAST(epoch(ts) AS BIGINT) AS s, CAST(epoch(ts) AS BIGINT)//86400 AS d, nee AS y, ta, 1e0/61.02e0-1e0/(ta+46.02e0) AS x "
        f"FROM exchange WHERE rg<10 AND {sun_sql()}<0 AND nee IS NOT NULL",
    ),
    # Every window's fit, step by step, and its error from the residuals.
    "fits": (
        ("nightx",),
        "WITH RECURSIVE w AS (SELECT n.*, k FROM nightx n JOIN (SELECT unnest(generate_series(3900,4010)) AS k) g ON n.d BETWEEN 5*k-7 AND 5*k+7), "
        "u AS (SELECT site, k, count(*) AS n FROM w GROUP BY site, k HAVING count(*)>=6 AND max(ta)-min(ta)>=5), "
        "it AS (SELECT site, k, 0 AS i, 100e0 AS e0, CAST(NULL AS DOUBLE) AS move FROM u UNION ALL "
        "SELECT site, k, i+1, least(2000e0, greatest(-1000e0, e0+least(100e0, greatest(-100e0, move)))), move FROM "
        "(SELECT site, k, i, e0, a*(e-b/a*c)/(b/a*(a*d-c*c)) AS move FROM (SELECT it.site, it.k, it.i, it.e0, sum(exp(2*it.e0*x)) AS a, "
        "sum(exp(it.e0*x)*y) AS b, sum(x*exp(2*it.e0*x)) AS c, sum(x*x*exp(2*it.e0*x)) AS d, sum(x*exp(it.e0*x)*y) AS e "
        "FROM it JOIN w USING (site, k) WHERE it.i<30 GROUP BY it.site, it.k, it.i, it.e0))), "
        "f AS (SELECT it.site, it.k, it.e0, sum(exp(it.e0*x)*y)/sum(exp(2*it.e0*x)) AS rref, sum(exp(2*it.e0*x))/"
        "(sum(exp(2*it.e0*x))*sum(x*x*exp(2*it.e0*x))-sum(x*exp(2*it.e0*x))*sum(x*exp(2*it.e0*x))) AS lever FROM it JOIN w USING (site, k) "
        "WHERE it.i=30 AND abs(it.move)<1e-7*greatest(1,abs(it.e0)) GROUP BY it.site, it.k, it.e0) "
        "SELECT f.site, f.k, f.e0, f.rref, count(*) AS n, sqrt(f.lever/(f.rref*f.rref)*sum((y-f.rref*exp(f.e0*x))^2)/greatest(count(*)-2,1)) AS sd "
        "FROM f JOIN w USING (site, k) GROUP BY f.site, f.k, f.e0, f.rref, f.lever",
    ),
    "e0s": (
        ("fits",),
        "SELECT site, avg(e0) AS e0 FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY sd, k) AS r FROM fits "
        "WHERE e0 BETWEEN 30 AND 450 AND sd<=0.5e0*e0) WHERE r<=3 GROUP BY site",
    ),
    "rrefsfit": (
        ("nightx", "e0s"),
        "SELECT site, make_timestamp(CAST(floor(avg(s)) AS BIGINT)*1000000) AS ts, sum(exp(e0*x)*y)/sum(exp(2*e0*x)) AS rref FROM nightx "
        "JOIN e0s USING (site) JOIN (SELECT unnest(generate_series(4900,5000)) AS k) w ON d BETWEEN 4*k-4 AND 4*k+4 "
        "GROUP BY site, k HAVING count(*)>=2 AND sum(exp(e0*x)*y)>0",
    ),
    "flowwide": (
        ("tgrid", "grid"),
        flow_sql(
            "tgrid WHERE site='East'", "tgrid WHERE site='West'", "l.v*4-80", "p.v",
            "grid p ON p.ts=b.ts AND p.sensor='purchase'", "grid l ON l.ts=b.ts AND l.sensor='view'",
        ),
    ),
    # Three stations of two towers, their hourly readings as a third site, rules by purchases.
    "strows": (
        (),
        "SELECT user_id%3 AS station, CASE WHEN user_id%2=0 THEN 'East' ELSE 'West' END AS site, "
        f"{bin_sql()} AS ts, avg(value) FILTER (event_type='view') AS \"view\", avg(value) FILTER (event_type='click') AS click, NULL AS v FROM events GROUP BY 1,2,3 "
        f"UNION ALL SELECT user_id%3, 'all', {bin_sql()} AS b, NULL, NULL, avg(value) FROM events WHERE event_type='error' GROUP BY 1,3 HAVING minute(b)=0",
    ),
    "stgrid": (
        ("strows",),
        "SELECT k.station, k.site, k.ts, x.\"view\", x.click FROM (SELECT station, site, unnest(generate_series(min(s) OVER w + INTERVAL 30 MINUTE, max(e) OVER w, INTERVAL 30 MINUTE)) AS ts FROM "
        "(SELECT station, site, CASE WHEN min(ts)=date_trunc('day',min(ts)) THEN min(ts) ELSE date_trunc('day',min(ts)) + INTERVAL 1 DAY END AS s, date_trunc('day',max(ts)) AS e "
        "FROM strows WHERE site<>'all' GROUP BY 1,2) WINDOW w AS (PARTITION BY station)) k LEFT JOIN strows x USING (station, site, ts)",
    ),
    "strules": (
        (),
        "SELECT user_id%3 AS station, CASE WHEN user_id%2=0 THEN 'East' ELSE 'West' END AS site, CASE WHEN user_id%5<3 THEN 'view' ELSE 'click' END AS variable, "
        "CAST(ts AS DATE) - 1 AS a, CAST(ts AS DATE) + 3 AS b, value/10 AS lo, 100-value/10 AS hi FROM events WHERE event_type='purchase'",
    ),
    # The same towers and sensors side by side.
    "slots": (
        (),
        "SELECT unnest(generate_series(CASE WHEN a=date_trunc('day',a) THEN a ELSE date_trunc('day',a) + INTERVAL 1 DAY END + INTERVAL 30 MINUTE, "
        f"date_trunc('day',z), INTERVAL 30 MINUTE)) AS ts FROM (SELECT {bin_sql(ts='min(ts)')} AS a, {bin_sql(ts='max(ts)')} AS z FROM events)",
    ),
    "kinds": (("slots",), f"SELECT * FROM slots LEFT JOIN (SELECT {bin_sql()} AS ts, {_KIND_COLS} FROM events GROUP BY 1) USING (ts)"),
    "east": (("slots",), f"SELECT * FROM slots LEFT JOIN (SELECT {bin_sql()} AS ts, {_KIND_COLS} FROM events WHERE user_id%2=0 GROUP BY 1) USING (ts)"),
    "west": (("slots",), f"SELECT * FROM slots LEFT JOIN (SELECT {bin_sql()} AS ts, {_KIND_COLS} FROM events WHERE user_id%2=1 GROUP BY 1) USING (ts)"),
    "northwide": (("east", "west", "kinds"), flow_sql("east", "west", "l.view*4-80", "p.purchase", "kinds p ON p.ts=b.ts", "kinds l ON l.ts=b.ts")),
    "southwide": (("east", "west", "kinds"), flow_sql("west", "east", "l.view*3-40", "p.purchase", "kinds p ON p.ts=b.ts", "kinds l ON l.ts=b.ts")),
    "flowlong": (("flowwide",), _long_sql("both", "flowwide")),
    "stationlong": (("northwide", "southwide"), _long_sql("north", "northwide") + " UNION ALL " + _long_sql("south", "southwide")),
    "stationfilled": (("stationlong",), mds_sql("stationlong", "'NEE'")),
    "flowfilled": (("flowlong",), mds_sql("flowlong", "'NEE'")),
    "mdsown": (
        ("tgrid",),
        "SELECT site, ts, 'T' AS variable, CAST(epoch(ts) AS BIGINT)//1800 AS pos, \"view\"*4 AS rg, signup/10e0 AS vpd, "
        "click/10e0 AS ta, click/10e0 AS y FROM tgrid",
    ),
    "mdsbase": (
        ("tgrid",),
        " UNION ALL ".join(
            f"SELECT site, ts, '{k}' AS variable, CAST(epoch(ts) AS BIGINT)//1800 AS pos, \"view\"*4 AS rg, signup/10e0 AS vpd, "
            f"click/10e0 AS ta, {k} AS y FROM tgrid"
            for k in ("purchase", "error")
        ),
    ),
    "pts": ((), "SELECT c_custkey AS id, c_acctbal AS lat, c_custkey*37%360+0.5e0 AS lon FROM customer"),
    "cells": ((), "SELECT s_acctbal AS lat, s_suppkey*7%360*1e0 AS lon FROM supplier"),
    "obsdoy": (("obs",), f"SELECT *, {noleap_sql('ts')} AS doy FROM obs"),
    "daily": (
        ("obs",),
        "SELECT veg, CAST(ts AS DATE) AS date, avg(v) AS v, avg(w) AS w FROM obs GROUP BY ALL",
    ),
}
