"""Measurement files as tables with explicit types; nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxloom.operators.attach import from_rows
from fluxloom.operators.qc import SENTINEL, null_sentinels
from fluxloom.operators.reshape import stack_rows

#: Column types for the domains used in data-set descriptions.
DOMAINS = {"text": "string", "dateTime": "timestamp_ntz", "date": "date", "numeric": "double", "enumerated": "string"}

#: Files asked for their first lines by one job.
FILES = 32


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _typed(c: str, kind: str) -> Column:
    text = F.trim(F.col(c))
    return text.try_cast(kind)


def _opening(spark: SparkSession, paths: list[str], n: int, keep: Column | None = None) -> list[str]:
    """The first ``n`` lines of some file, of those to ``keep``.

    Only blocks at the start of a file are looked at: a large file is read in
    several pieces and most of them do not begin with its head.
    """
    lines = spark.read.text(paths).filter("_metadata.file_block_start = 0")
    if keep is not None:
        lines = lines.filter(keep)
    return [r.value for r in lines.select("value").limit(n).collect()]


def _heads(spark: SparkSession, paths: list[str], n: int = 2) -> dict[tuple[str, ...], list[str]]:
    """Files by their first ``n`` lines.

    Every file is asked for its first lines by a limit of its own, ``FILES``
    of them in one job; the scan behind a limit stops after one buffer. A
    session of its own keeps files whole: a limit takes lines of any split.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    listed = sorted({unquote(f) for f in spark.read.text(paths).inputFiles()})
    files: dict[tuple[str, ...], list[str]] = {}
    for at in range(0, len(listed), FILES):
        some = listed[at : at + FILES]
        tops = [session.read.text(f).limit(n).select(F.lit(i).alias("i"), F.monotonically_increasing_id().alias("at"), "value") for i, f in enumerate(some)]
        lines = sorted(reduce(DataFrame.unionAll, tops).collect())
        for i, f in enumerate(some):
            if head := tuple(r.value for r in lines if r.i == i):
                files.setdefault(head, []).append(f)
    return files


def read_units_table(spark: SparkSession, path, types: Mapping[str, str], sep: str = "\t", sentinel: float = SENTINEL) -> DataFrame:
    """Tables whose first line names the columns and whose second gives their units.

    Every file carries both lines. Files are read in groups of equal heads,
    each by its own names, and united by name: neither the order of columns
    nor their number need agree. Units go to the field metadata, those of the
    first file (by name) that has the column. What comes to the driver is one
    row per file, as many as Spark lists there anyway.
    """
    tables = [_read_units(spark, files, head, types, sep, sentinel) for head, files in _heads(spark, _paths(path)).items() if len(head) == 2]
    if not tables:
        raise ValueError("no file has the two head lines")
    return tables[0] if len(tables) == 1 else stack_rows(*tables)


def _read_units(spark: SparkSession, paths: list[str], head: tuple[str, ...], types: Mapping[str, str], sep: str, sentinel: float) -> DataFrame:
    names, units = ([t.strip().strip('"') for t in line.split(sep)] for line in head)
    raw = spark.read.csv(paths, schema=_strings(names), sep=sep, header=True, enforceSchema=True)
    unit_of = dict(zip(names, units))
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.lit(u)) for n, u in unit_of.items()])
    data = raw.filter(~same)
    typed = data.select(
        *[
            _typed(n, types.get(n, "double")).alias(n, metadata={"units": unit_of[n]})
            for n in names
        ]
    )
    return null_sentinels(typed, sentinel)


def read_whitespace_table(spark: SparkSession, path, names: Sequence[str], types: Sequence[str], sentinel: float = SENTINEL) -> DataFrame:
    """Header-less lines of blank-separated fields, typed by position."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    lines = spark.read.text(_paths(path)).filter(F.trim("value") != "").select(parts.alias("p"))
    typed = lines.select(
        *[F.get(F.col("p"), F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    )
    return null_sentinels(typed, sentinel)


def read_preamble_csv(
    spark: SparkSession,
    path,
    types: Mapping[str, str],
    null: str = "-9999",
    comment: str = "#",
    header_starts: str | None = None,
    data_pattern: str = r"^\s*[-+]?\d",
) -> DataFrame:
    """CSV after some free lines and one header line, a sentinel as NULL.

    Preamble lines start with the comment sign. Where they do not,
    ``header_starts`` tells the header line by its beginning, and data rows
    are those whose first field fits ``data_pattern``. The order of columns is
    the files'; all files share it.
    """
    paths = _paths(path)
    line = F.col("value")
    keep = line.startswith(header_starts) if header_starts else ~line.startswith(comment)
    (header,) = _opening(spark, paths, 1, keep)
    names = [t.strip().strip('"') for t in header.split(",")]
    raw = spark.read.csv(
        paths, schema=_strings(names), header=False, comment=comment, nullValue=null, ignoreLeadingWhiteSpace=True
    )
    first = F.col(names[0])
    data = raw.filter(first.rlike(data_pattern) if header_starts else ~first.eqNullSafe(F.lit(names[0])))
    out = data.select(*[_typed(n, types.get(n, "double")).alias(n) for n in names])
    return null_sentinels(out, float(null))


def read_typed_csv(
    spark: SparkSession, paths, domains: Mapping[str, str], na_tokens: Sequence[str] = ("NA", "NaN", "")
) -> DataFrame:
    """Quoted CSV with declared domains per column and several tokens for missing."""
    raw = spark.read.csv(_paths(paths), schema=_strings(list(domains)), header=True, quote='"', escape='"')
    return raw.select(
        *[
            F.when(~F.trim(F.col(n)).isin(*na_tokens), _typed(n, DOMAINS.get(d, d))).alias(n)
            for n, d in domains.items()
        ]
    )


def read_many(paths: Sequence[str], reader: Callable[[str], DataFrame]) -> DataFrame:
    """Files of differing columns, united by name; duplicates from overlapping files stay."""
    return stack_rows(*[reader(p) for p in paths])


def read_history(
    spark: SparkSession, root: str, cases: Sequence[str], first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """Simulation history laid out by ``case``, ``veg`` and ``year`` folders.

    Cases and years are folder filters: other files are never opened.
    """
    df = spark.read.parquet(root).filter(F.col("case").isin(*cases))
    if first_year is not None:
        df = df.filter(F.col("year") >= first_year)
    if last_year is not None:
        df = df.filter(F.col("year") <= last_year)
    return df


def read_stage(spark: SparkSession, base: str, stage: str) -> DataFrame:
    """An earlier stage by name."""
    return spark.read.parquet(f"{base}/{stage}")


def variable_catalog(df: DataFrame) -> DataFrame:
    """Unit and long name of every variable, from field metadata."""
    rows = [
        (f.name, f.metadata.get("units"), f.metadata.get("long_name"))
        for f in df.schema.fields
    ]
    return from_rows(df.sparkSession, rows, "variable string, units string, long_name string")


def with_units(df: DataFrame, units: Mapping[str, str], long_names: Mapping[str, str] | None = None) -> DataFrame:
    """Attach units (and long names) to fields, for instance after an aggregate."""
    long_names = long_names or {}

    def field(c: str) -> Column:
        meta = dict(df.schema[c].metadata)
        if c in units:
            meta["units"] = units[c]
        if c in long_names:
            meta["long_name"] = long_names[c]
        return F.col(c).alias(c, metadata=meta)

    return df.select(*[field(c) for c in df.columns])
