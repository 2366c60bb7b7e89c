"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library was written for. Skewed keys are split at run time,
#: small shuffle partitions are merged, and timestamps stay zone-free.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def build_session(master: str | None = None, app: str = "fluxloom", **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset a local session works below its warehouse; on a cluster
    that is an error, and so is a folder that exists on one machine only: a
    path without a scheme goes to the default file system, which must then be
    a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/stages"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder once and go on from there.

    Cuts the lineage of staged work: a lost executor costs one stage, and
    later stages do not recompute earlier ones. Unlike a row checkpoint the
    table keeps its columns apart and its size known, so later joins read only
    what they need and Spark's own size checks see the truth.
    """
    path = f"{shared_dir(df.sparkSession)}/fluxloom/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_buckets(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``settle`` in as many buckets of ``by`` as the session has shuffle partitions, one sorted file each.

    Joins, aggregates and windows by these columns read the buckets without a
    shuffle. Only a catalogue entry tells Spark of buckets; ``release`` drops
    it with the folder.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = uuid.uuid4().hex
    dealt = df.repartition(buckets, *by)
    writer = dealt.write.format("parquet").bucketBy(buckets, *by).sortBy(*order)
    writer.option("path", f"{shared_dir(spark)}/fluxloom/settled-{run}").saveAsTable(f"settled_{run}")
    return spark.table(f"settled_{run}")


def release(*tables: DataFrame) -> None:
    """Delete the folders, and catalogue entries, of settled tables that nothing reads any more."""
    for df in tables:
        hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/fluxloom/settled-" in folder:
                df.sparkSession.sql(f"DROP TABLE IF EXISTS settled_{folder.rpartition('-')[2]}")
                path = hadoop(folder)
                path.getFileSystem(conf).delete(path, True)
