"""Re-binning of a live sensor feed into tumbling windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rebin_stream(
    events: DataFrame, keys: Sequence[str], ts: str, aggs: Mapping[str, str], width: str = "30 minutes",
    watermark: str = "10 minutes", label: str = "start", null: str = "skip",
) -> DataFrame:
    """The batch re-binning on an unbounded table.

    A bin is emitted once the watermark has passed its end; later rows for it
    are dropped. State holds one partial aggregate per open bin and key.
    Watermarks need zoned timestamps, so stamps are read in the session zone
    and given back without one. The session must run in UTC: a zone with
    daylight saving would merge or skip an hour.
    """
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}, must be UTC")
    fns = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}
    out = []
    for col, how in aggs.items():
        value = fns[how](col)
        if null == "strict":
            value = F.when(F.count(col) == F.count(F.lit(1)), value)
        out.append(value.alias(col))
    zoned = events.withColumn(ts, F.col(ts).cast("timestamp_ltz")).withWatermark(ts, watermark)
    grouped = zoned.groupBy(F.window(ts, width).alias("_w"), *keys).agg(*out)
    return grouped.select(*keys, F.col(f"_w.{label}").cast("timestamp_ntz").alias(ts), *aggs)


def rebin_available(
    spark: SparkSession, source: str, schema: str, out: str, state: str, keys: Sequence[str], ts: str, aggs: Mapping[str, str], **options
) -> int:
    """Re-bin the files that have come to ``source`` since the last call; closed bins go to Parquet in ``out``.

    ``state`` is the stream's checkpoint: after a stop or a failure the next
    call goes on from there, and no row is binned twice. Returns how many
    partial sums came too late for their bin and were dropped.
    """
    bins = rebin_stream(spark.readStream.schema(schema).parquet(source), keys, ts, aggs, **options)
    run = bins.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state)
    run = run.trigger(availableNow=True).start(out)
    run.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for batch in run.recentProgress for op in batch["stateOperators"])
