"""Long and wide forms, unions, selections and renames."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxloom.functions import values as vl
from fluxloom.operators.attach import attach, from_rows
from fluxloom.session import settle


def stack_rows(*frames: DataFrame) -> DataFrame:
    """Row union by column name, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_cases(cases: Mapping[str, DataFrame], label: str = "case") -> DataFrame:
    """Cases stacked along a new labelled dimension."""
    return stack_rows(*[df.withColumn(label, F.lit(name)) for name, df in cases.items()])


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), variable, value)


def melt_pairs(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], mean: str = "_avg", sd: str = "_sd") -> DataFrame:
    """``<metric>_avg`` / ``<metric>_sd`` columns to (metric, mean, sd) in one pass."""
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m + mean).cast("double").alias("mean"),
            F.col(m + sd).cast("double").alias("sd"),
        )
        for m in metrics
    ]
    return df.select(*ids, F.explode(F.array(*rows)).alias("_p")).select(*ids, "_p.*")


def widen(
    df: DataFrame, ids: Sequence[str], key: str, values: Sequence[str], cols: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Named key values to columns ``<col>_<value>``; no pass to find the values."""
    return df.groupBy(*ids).agg(
        *[
            F.max(F.when(F.col(key).cast("string") == str(v), F.col(c))).alias(f"{c}_{prefix}{v}")
            for c in cols
            for v in values
        ]
    )


def split_by(df: DataFrame, key: str, values: Sequence[str]) -> dict[str, DataFrame]:
    return {v: df.filter(F.col(key) == v) for v in values}


def cyclic_point(df: DataFrame, keys: Sequence[str], lon: str, period: float = 360.0) -> DataFrame:
    """The first longitude of every row of cells repeated one period further on.

    The lowest longitude is aggregated first; the cells carrying it are found
    by a join with that small table.
    """
    first = settle(df.groupBy(*keys).agg(F.min(lon).alias("_first")))
    edge = (
        attach(df, first, list(keys), "inner")
        .filter(F.col(lon) == F.col("_first"))
        .drop("_first")
        .withColumn(lon, F.col(lon) + period)
        .select(*df.columns)
    )
    return df.unionByName(edge)


def select_existing(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The named columns that exist, and the names that do not."""
    have = [n for n in names if n in df.columns]
    return df.select(*have), [n for n in names if n not in df.columns]


def select_like(
    df: DataFrame, include: Sequence[str] = (".*",), exclude: Sequence[str] = (), first: Sequence[str] = ()
) -> DataFrame:
    """Columns matching any ``include`` and no ``exclude`` pattern, ``first`` ones leading."""
    hit = [
        c
        for c in df.columns
        if any(re.search(p, c) for p in include) and not any(re.search(p, c) for p in exclude)
    ]
    lead = [c for c in first if c in df.columns]
    return df.select(*lead, *[c for c in hit if c not in lead])


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_regex(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Names rewritten by each rule's first match in turn."""

    def new(name: str) -> str:
        for pattern, text in rules:
            name = re.sub(pattern, text, name, count=1)
        return name

    return df.toDF(*[new(c) for c in df.columns])


def tag(df: DataFrame, **consts) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def provenance(parts: Sequence[tuple[str, Column | str]]) -> Column:
    """``label = value | label = value``; a missing value prints as NA."""
    pieces: list[Column] = []
    for i, (label, col) in enumerate(parts):
        pieces += [F.lit((" | " if i else "") + label + " = "), F.col(col) if isinstance(col, str) else col]
    return vl.paste(*pieces)


def band(df: DataFrame, mean: str, sd: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Mean ± deviation; a zero deviation is widened to 1e-12."""
    dev = F.when(F.col(sd) == 0, F.lit(1e-12)).otherwise(F.col(sd))
    return df.withColumns({lo: F.col(mean) - dev, hi: F.col(mean) + dev})


def at_index(df: DataFrame, cols: Sequence[str], i: int) -> DataFrame:
    """One index (from 0) of layered columns; the layer dimension goes away."""
    return df.select(*[F.get(F.col(c), F.lit(i)).alias(c) if c in cols else F.col(c) for c in df.columns])


def flatten_levels(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """Layered columns to ``VAR_1`` … ``VAR_n``, long names suffixed with the level.

    ``n`` is the declared number of levels. A shorter array leaves NULL; a
    longer one ends the job rather than lose its levels.
    """
    meta = {f.name: dict(f.metadata) for f in df.schema.fields}
    out: list[Column] = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        too_long = F.raise_error(F.format_string(f"{c} has %d levels, declared are {n}", F.size(c)))
        whole = F.when(F.size(c) > n, too_long.cast(df.schema[c].dataType)).otherwise(F.col(c))
        for j in range(1, n + 1):
            m = dict(meta[c])
            if "long_name" in m:
                m["long_name"] = f"{m['long_name']} at level {j}"
            # Every level asks, so that a plan that needs only one of them can't lose the question.
            out.append(F.get(whole, F.lit(j - 1)).alias(f"{c}_{j}", metadata=m))
    return df.select(*out)


def attach_depth(df: DataFrame, col: str, depths: Sequence[float], sign: int = 1, out: str = "value") -> DataFrame:
    """One row per level with its depth; ``sign=-1`` points the axis down."""
    dim = from_rows(df.sparkSession, [(i, float(d) * sign) for i, d in enumerate(depths)], "level int, depth double")
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.posexplode(col).alias("level", out)).join(F.broadcast(dim), "level").select(
        *rest, "level", "depth", out
    )


def drop_short_variables(df: DataFrame, variable: str, n_expected: int) -> DataFrame:
    """Only variables recorded at every time step."""
    counts = df.groupBy(variable).agg(F.count(F.lit(1)).alias("_n"))
    full = settle(counts.filter(F.col("_n") >= n_expected).drop("_n"))
    return attach(df, full, [variable], "left_semi")
