"""What several operators of this package use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Between words: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def spread(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_runs(text: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs ``(first row, end row, bytes, offsets)`` of whole texts.

    A run holds at most ``most`` bytes, or one text if that is longer, so the
    arrays worked out from it stay small whatever the batch size. NULL reads
    as the empty text. The bytes are a view of the Arrow buffer.
    """
    text = pc.fill_null(text.cast(pa.large_string()), "")
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
