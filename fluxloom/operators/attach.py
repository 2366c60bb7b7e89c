"""Size-checked broadcast and hot-key-safe joins of a small side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes a broadcast side may hold.
MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 100_000, 64 << 20


_ARROW = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
}


def from_rows(spark, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Table from rows written in a program; their number bounds its size.

    Handed over as one Arrow table, which Spark keeps as a local relation of
    known size: no Python worker reads it back.
    """
    fields = T.StructType.fromDDL(schema).fields
    columns = [
        pa.array([r[i] for r in rows], type=_ARROW[f.dataType.simpleString()]) for i, f in enumerate(fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=[f.name for f in fields]))


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the side may be broadcast, by its rows and the bytes they hold.

    Fixed-width columns aren't read; of others only their lengths are.
    """
    loose = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f"`{f.name}`" for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if nested:
        loose.append(F.octet_length(F.to_json(F.struct(*nested))))
    width = 8 * len(df.columns)
    held = sum((F.coalesce(F.sum(x.cast("long")), F.lit(0)) for x in loose), F.lit(0))
    n, more = df.agg(F.count(F.lit(1)), held).first()
    return n <= max_rows and n * width + more <= max_bytes


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 1 / 256) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of all rows, from one frequent-items sketch a task.

    At most ``1 / share`` of them; the sketch tracks so many items that none is missed.
    """
    most = max(1, int(1 / share))
    top = F.expr(f"approx_top_k(h, {most}, {min(10_000, 32 * most)})")
    n, found = df.select(F.xxhash64(*on).alias("h")).agg(F.count(F.lit(1)), top).first()
    return [r["item"] for r in found or [] if r["count"] > share * n]


def attach(
    df: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    null_safe: bool = False,
    where: Column | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a side expected to be small.

    Within ``max_rows`` and ``max_bytes`` it is broadcast and the large side is
    not shuffled at all. Beyond that hot keys are found by a sketch. Their rows
    stay where they are and meet the few rows of the small side that have these
    keys, broadcast if they fit; all others are joined by a shuffle, in which
    no key is hot. What a row goes through depends on its key alone.
    ``null_safe`` lets NULL keys meet, as grouping does; ``where`` is a further
    condition on columns of both sides. Joins that keep unmatched rows of the
    small side are refused.
    """
    if how not in ("inner", "left", "left_semi", "left_anti", "semi", "anti"):
        raise ValueError(f"attach keeps rows of the large side only, not how={how!r}")
    names = {k: f"_r_{k}" for k in on}
    same = [F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r) for k, r in names.items()]
    met = reduce(lambda a, b: a & b, same if where is None else [*same, where])

    def joined(rows: DataFrame, side: DataFrame, fits: bool) -> DataFrame:
        side = side.withColumnsRenamed(names)
        return rows.join(F.broadcast(side) if fits else side, met, how).drop(*names.values())

    if is_small(small, max_rows, max_bytes):
        return joined(df, small, True)
    hot = hot_keys(df, on)
    if not hot:
        return joined(df, small, False)
    is_hot = F.xxhash64(*on).isin(hot)
    named = small.filter(is_hot)
    return joined(df.filter(is_hot), named, is_small(named, max_rows, max_bytes)).unionByName(joined(df.filter(~is_hot), small.filter(~is_hot), False))
