"""Writers: every task writes its own part, nothing passes the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxloom.operators.attach import from_rows
from fluxloom.operators.derive import month_time_axis
from fluxloom.operators.qc import SENTINEL
from fluxloom.sources.readers import variable_catalog, with_units


def _as_text(f: T.StructField, sentinel: float):
    c = F.col(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    missing = f"{sentinel:g}" if isinstance(f.dataType, T.NumericType) else "NA"
    return F.coalesce(c.cast("string"), F.lit(missing))


def write_lines(lines: DataFrame, path: str, head: Sequence[str] = ()) -> None:
    """Text lines, every part file opening with the head lines.

    A task writes one file: its first row, told by its number within the
    partition, brings the head along. Of a table without rows the head is left.
    """
    write = lambda df: df.write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)
    if not head:
        return write(lines)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    top = F.when(place == 0, F.lit("".join(f"{line}\n" for line in head))).otherwise("")
    write(lines.select(F.concat(top, F.coalesce("value", F.lit(""))).alias("value")))
    if lines.sparkSession.read.text(path).isEmpty():
        write(from_rows(lines.sparkSession, [("\n".join(head),)], "value string"))


def write_units_table(df: DataFrame, path: str, sep: str = "\t", sentinel: float = SENTINEL) -> None:
    """Names line, units line, data; missing numbers as the sentinel.

    Each part file is a complete table with its own two head lines.
    """
    units = {f.name: f.metadata.get("units", "--") for f in df.schema.fields}
    head = [sep.join(df.columns), sep.join(units[c] for c in df.columns)]
    lines = df.select(F.concat_ws(sep, *[_as_text(f, sentinel) for f in df.schema.fields]).alias("value"))
    write_lines(lines, path, head)


def write_flagged(df: DataFrame, path: str, legend: Mapping[str, str]) -> None:
    """Values and flags with the legend in the flag fields' metadata."""
    cols = [
        F.col(c).alias(c, metadata={**df.schema[c].metadata, "legend": dict(legend)}) if c.endswith("_flag") else F.col(c)
        for c in df.columns
    ]
    df.select(*cols).write.mode("overwrite").parquet(path)


# Forcing variables with the names, units and descriptions the model reads.
FORCING = [
    ("FLDS", "FLDS", "W/m^2", "incident longwave (FLDS)"),
    ("Rg", "FSDS", "W/m^2", "incident shortwave (FSDS)"),
    ("PRECTmms", "PRECTmms", "mm/s", "precipitation (PRECTmms)"),
    ("rH", "RH", "%", "relative humidity at lowest atm level (RH)"),
    ("P", "PSRF", "Pa", "pressure at the lowest atmospheric level (PSRF)"),
    ("Tair", "TBOT", "K", "temperature at lowest atm level (TBOT)"),
    ("U", "WIND", "m/s", "wind at lowest atm level (WIND)"),
    ("ZBOT", "ZBOT", "m", "observational height"),
    ("NEE", "NEE", "umolm-2s-1", "net ecosystem exchange"),
    ("H", "FSH", "Wm-2", "sensible heat flux"),
    ("LE", "EFLX_LH_TOT", "Wm-2", "latent heat flux"),
    ("GPP", "GPP", "umolm-2s-1", "gross primary productivity"),
    ("radNet", "Rnet", "W/m^2", "net radiation"),
]


def forcing_table(df: DataFrame, keys: Sequence[str], ts: str, steps_per_day: int = 48) -> DataFrame:
    """Model names, units and the month's time axis."""
    have = [v for v in FORCING if v[0] in df.columns]
    axis = month_time_axis(df, keys, ts, steps_per_day)
    named = axis.select(*keys, ts, "year_mon", "time", *[F.col(a).alias(b) for a, b, _, _ in have])
    return with_units(named, {b: u for _, b, u, _ in have}, {b: n for _, b, _, n in have})


def write_forcing(df: DataFrame, path: str, keys: Sequence[str], ts: str, attributes: Mapping[str, str] | None = None) -> None:
    """One folder per community and month, with units, fill value and attributes beside the data.

    Rows are placed by (community, month) so that each folder gets one file.
    """
    table = forcing_table(df, keys, ts)
    (
        table.repartition(*keys, "year_mon")
        .sortWithinPartitions(*keys, "year_mon", "time")
        .write.mode("overwrite")
        .partitionBy(*keys, "year_mon")
        .parquet(f"{path}/data")
    )
    catalog = variable_catalog(table).withColumn("fill_value", F.lit(SENTINEL))
    catalog.write.mode("overwrite").parquet(f"{path}/variables")
    rows = list({"calendar": "noleap", "mode": "time-dependent", **(attributes or {})}.items())
    from_rows(df.sparkSession, rows, "name string, value string").write.mode("overwrite").parquet(f"{path}/attributes")


def export_series(df: DataFrame, cols: Sequence[str], path: str, fmt: str = "csv") -> None:
    out = df.select(*cols).write.mode("overwrite")
    out.csv(path, header=True) if fmt == "csv" else out.parquet(path)


def write_stage(df: DataFrame, base: str, stage: str, partition_by: Sequence[str] = ()) -> str:
    """A named stage later steps read back."""
    path = f"{base}/{stage}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_history(df: DataFrame, root: str, ts: str) -> None:
    """Simulation rows in ``case`` / ``veg`` / ``year`` folders."""
    laid = df.withColumn("year", F.year(ts))
    laid.repartition("case", "veg", "year", F.month(ts)).write.mode("overwrite").partitionBy("case", "veg", "year").parquet(root)
