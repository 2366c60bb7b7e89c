"""Readers, sinks and the streaming re-bin."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fluxloom.operators import grid as gr
from fluxloom.operators import reshape as rs
from fluxloom.session import settle, shared_dir
from fluxloom.sources import readers as rd
from fluxloom.sources import sinks as sk
from fluxloom.streaming.rebin import rebin_available, rebin_stream

from .conftest import stamp


def put(path, text):
    path.write_text(text)
    return str(path)


def test_units_table_file(spark, tmp_path):
    p = put(tmp_path / "t.txt", "Year\tDoY\tHour\tNEE\n--\t--\t--\tumolm-2s-1\n2024\t1\t0.5\t-9999\n2024\t1\t24\t1.25\n")
    df = rd.read_units_table(spark, p, {"Year": "int", "DoY": "int"})
    assert [tuple(r) for r in df.orderBy("Hour").collect()] == [(2024, 1, 0.5, None), (2024, 1, 24.0, 1.25)]
    assert df.schema["NEE"].metadata["units"] == "umolm-2s-1"
    catalog = {r.variable: r.units for r in rd.variable_catalog(df).collect()}
    assert catalog["NEE"] == "umolm-2s-1" and catalog["Year"] == "--"


def test_units_tables_of_other_column_orders_meet_by_name(spark, tmp_path):
    a = put(tmp_path / "a one.txt", "Hour\tv\tw\n--\tm\tkg\n1\t10\t20\n")
    b = put(tmp_path / "b.txt", "w\tHour\tv\nkg\t--\tm\n21\t2\t11\n")
    c = put(tmp_path / "c.txt", "Hour\tv\tw\n--\tm\tkg\n3\t-9999\t22\n")
    d = put(tmp_path / "d.txt", "Hour\tv\n--\tmm\n4\t13\n")
    df = rd.read_units_table(spark, [a, b, c, d], {})
    got = [(r.Hour, r.v, r.w) for r in df.orderBy("Hour").collect()]
    assert got == [(1.0, 10.0, 20.0), (2.0, 11.0, 21.0), (3.0, None, 22.0), (4.0, 13.0, None)]
    assert df.schema["v"].metadata["units"] == "m"


def test_heads_are_read_without_the_files(spark, tmp_path):
    size = 0
    for i in range(6):
        text = f"Hour\tv{i % 2}\n--\tm\n" + "".join(f"{k}\t{k / 7:.12f}\n" for k in range(200_000 if i else 1))
        put(tmp_path / f"h{i}.txt", text)
        size += len(text)
    put(tmp_path / "short.txt", "Hour\tv0\n")
    files = [str(p) for p in tmp_path.iterdir()]
    sc = spark.sparkContext
    sc.setJobGroup("heads", "heads")
    try:
        heads = rd._heads(spark, files)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in heads.items()} == {("Hour\tv0", "--\tm"): 3, ("Hour\tv1", "--\tm"): 3, ("Hour\tv0",): 1}
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup("heads") for s in tracker.getJobInfo(j).stageIds}
    read = sum(store.lastStageAttempt(s).inputBytes() for s in stages if tracker.getStageInfo(s))
    assert 0 < read < size / 10


@pytest.mark.parametrize("parts", [1, 3])
def test_every_part_opens_with_the_head(spark, tmp_path, parts):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") > 4, F.col("id")).alias("b"))
    sk.write_units_table(df.repartition(parts), str(tmp_path / "t"))
    texts = [p.read_text().splitlines() for p in (tmp_path / "t").glob("part-*")]
    assert sum(len(t) - 2 for t in texts if t) == 10 and len(texts) == parts
    assert all(t[:2] == ["a\tb", "--\t--"] for t in texts if t)
    assert "Python" not in df._jdf.queryExecution().toString()


def test_a_table_without_rows_keeps_its_head(spark, tmp_path):
    df = spark.range(0).select(F.col("id").cast("double").alias("a"))
    sk.write_units_table(df, str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["a", "--"]


def test_units_table_with_commas_and_quotes(spark, tmp_path):
    p = put(tmp_path / "t.csv", '"time","wc10"\n"--","%"\n"2020-01-01 00:30:00",0.5\n')
    df = rd.read_units_table(spark, p, {"time": "timestamp_ntz"}, sep=",")
    assert df.first().time == stamp("2020-01-01 00:30:00") and df.first().wc10 == 0.5


def test_whitespace_file(spark, tmp_path):
    p = put(tmp_path / "g.txt", " 94075 20240101   0035  -105.5  -9999.0\n94075 20240101 0040 -105.5 1.2\n\n")
    df = rd.read_whitespace_table(spark, p, ["id", "day", "hm", "lon", "p"], ["string", "string", "string", "double", "double"])
    assert [r.p for r in df.orderBy("hm").collect()] == [None, 1.2]


def test_preamble_file(spark, tmp_path):
    p = put(tmp_path / "r.csv", "# Site: X\n# Version: 2\nTIMESTAMP_START,SW_IN\n202401010000,-9999\n202401010030,5\n")
    df = rd.read_preamble_csv(spark, p, {"TIMESTAMP_START": "string"})
    assert [tuple(r) for r in df.orderBy("TIMESTAMP_START").collect()] == [("202401010000", None), ("202401010030", 5.0)]


def test_preamble_without_comment_signs(spark, tmp_path):
    p = put(tmp_path / "r.csv", "Site X, somewhere\nversion two\nSTAMP,SW\n202401010000,-9999\n202401010030,5\n")
    df = rd.read_preamble_csv(spark, p, {"STAMP": "string"}, header_starts="STAMP")
    assert [tuple(r) for r in df.orderBy("STAMP").collect()] == [("202401010000", None), ("202401010030", 5.0)]


def test_typed_csv_tokens(spark, tmp_path):
    p = put(tmp_path / "c.csv", 'node,date,t,flag\n"6","2020-07-01 00:10:00",NaN,\n"7","2020-07-01 00:20:00",1.5,"m"\n')
    df = rd.read_typed_csv(spark, p, {"node": "text", "date": "dateTime", "t": "numeric", "flag": "enumerated"})
    assert [tuple(r) for r in df.orderBy("node").collect()] == [
        ("6", stamp("2020-07-01 00:10:00"), None, None), ("7", stamp("2020-07-01 00:20:00"), 1.5, "m"),
    ]


def test_units_survive_the_round_trip(spark, tmp_path, series):
    df = rd.with_units(series([1.5, None, float("nan"), 2.0]).select("ts", "v"), {"v": "degC"})
    path = str(tmp_path / "out")
    sk.write_units_table(df, path)
    back = rd.read_units_table(spark, path, {"ts": "timestamp_ntz"})
    assert [r.v for r in back.orderBy("ts").collect()] == [1.5, None, None, 2.0]
    assert back.schema["v"].metadata["units"] == "degC"


def test_flag_legend_is_kept(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "n")], "v double, v_flag string")
    sk.write_flagged(df, str(tmp_path / "f"), {"n": "own value"})
    assert spark.read.parquet(str(tmp_path / "f")).schema["v_flag"].metadata["legend"] == {"n": "own value"}


def test_forcing_folders(spark, tmp_path, series):
    g = series(range(200), start="2024-01-30 00:00:00").withColumnsRenamed({"k": "community", "v": "Tair"})
    path = str(tmp_path / "forcing")
    sk.write_forcing(g, path, ["community"], "ts", {"title": "x"})
    back = spark.read.parquet(f"{path}/data")
    first = back.groupBy("year_mon").agg(F.min("time").alias("t0"), F.count("*").alias("n")).orderBy("year_mon").collect()
    assert [(r.year_mon, r.t0, r.n) for r in first] == [("2024-01", 0.0, 96), ("2024-02", 0.0, 104)]
    units = {r.variable: r.units for r in spark.read.parquet(f"{path}/variables").collect()}
    assert units["TBOT"] == "K"
    assert {r.name for r in spark.read.parquet(f"{path}/attributes").collect()} >= {"calendar", "title"}


def test_history_reads_only_the_folders_asked_for(spark, tmp_path):
    rows = [(c, "FF", dt.datetime(y, 1, 1), 1.0) for c in "AB" for y in (2008, 2009, 2010)]
    df = spark.createDataFrame(rows, "case string, veg string, ts timestamp_ntz, x double")
    sk.write_history(df, str(tmp_path / "h"), "ts")
    got = rd.read_history(spark, str(tmp_path / "h"), ["A"], 2009)
    assert got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "case" in plan.split("PartitionFilters")[1][:80]


def test_levels_carry_their_long_names(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id int, TSOI array<double>")
    df = rd.with_units(df, {"TSOI": "K"}, {"TSOI": "soil temperature"})
    flat = rs.flatten_levels(df, ["TSOI"], 3)
    assert flat.columns == ["id", "TSOI_1", "TSOI_2", "TSOI_3"]
    assert flat.schema["TSOI_2"].metadata == {"units": "K", "long_name": "soil temperature at level 2"}
    deep = rs.attach_depth(df, "TSOI", [0.02, 0.06, 0.12], sign=-1).orderBy("level").collect()
    assert [(r.depth, r.value) for r in deep] == [(-0.02, 1.0), (-0.06, 2.0), (-0.12, 3.0)]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark))
    df = settle(spark.range(5))
    assert df.count() == 5 and "Exchange" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("null", ["skip", "strict"])
def test_streaming_rebin_equals_batch(spark, tmp_path, null):
    first = stamp("2024-01-01 00:00:00")
    rows = [
        (f"s{i % 2}", first + dt.timedelta(minutes=7 * i), None if i % 9 == 0 else float(i)) for i in range(60)
    ]
    schema = "k string, ts timestamp_ntz, v double"
    src = str(tmp_path / "in")
    # Files arrive in time order; a late row past the watermark is dropped.
    for part in range(3):
        chunk = spark.createDataFrame(rows[part * 20 : part * 20 + 20], schema).coalesce(1)
        chunk.write.mode("append").parquet(src)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = rebin_stream(feed, ["k"], "ts", {"v": "sum"}, label="end", null=null)
    name = f"bins_{null}"
    q = (
        out.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    batch = gr.rebin(spark.createDataFrame(rows, schema), ["k"], "ts", {"v": "sum"}, label="end", null=null)
    closed = rows[-1][1] - dt.timedelta(minutes=10)
    want = sorted(map(tuple, batch.filter(F.col("ts") <= F.lit(closed)).collect()), key=str)
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == want and want


def test_a_stopped_stream_goes_on_and_counts_late_rows(spark, tmp_path):
    schema, first = "k string, ts timestamp_ntz, v double", stamp("2024-01-01 00:00:00")
    places = [str(tmp_path / n) for n in ("in", "out", "state")]
    dropped = []
    # The second part goes on in the first one's last bin; the third begins with a row of the first bin.
    for minutes in ([1, 5, 40], [45, 70, 130], [2, 190, 600]):
        rows = [("a", first + dt.timedelta(minutes=m), float(m)) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(places[0])
        dropped.append(rebin_available(spark, places[0], schema, *places[1:], ["k"], "ts", {"v": "sum"}))
    got = [(r.ts.hour * 60 + r.ts.minute, r.v) for r in spark.read.schema(schema).parquet(places[1]).orderBy("ts").collect()]
    assert got == [(0, 6.0), (30, 85.0), (60, 70.0), (120, 130.0), (180, 190.0)]
    assert dropped == [0, 0, 1]


def test_stream_refuses_a_session_zone_other_than_utc(spark):
    df = spark.sql("SELECT 'a' AS site, timestamp_ntz'2024-03-10 02:30:00' AS ts, 1.0D AS v")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        with pytest.raises(ValueError, match="UTC"):
            rebin_stream(df, ["site"], "ts", {"v": "sum"})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
