"""Substring deduplication by content-defined chunks cut where a gear rolling hash says so."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxloom.llm.common import byte_runs
from fluxloom.session import settle

#: Shortest and longest chunk in bytes, and the bits of the rolling hash that are 0 at a cut (one place in 32).
LEAST, MOST, CUT = 40, 256, np.uint32(0b11111 << 11)
#: Bytes a cut depends on: higher bits of the hash would see more of the text.
SEEN = 16


def _mixed(n: np.ndarray) -> np.ndarray:
    n = (n ^ (n >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    n = (n ^ (n >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return n ^ (n >> np.uint64(31))


#: A random number per byte value.
GEAR = (_mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places behind which a chunk may end: the gear hash of the last bytes, worked out by doubling."""
    code = GEAR[data]
    for by in (1, 2, 4, 8):
        code[by:] += code[:-by] << np.uint32(by) if by < len(code) else np.uint32(0)
    return np.flatnonzero((code & CUT) == 0) + 1


def chunk_ends(places: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of one text: the first place at least ``LEAST`` on, at the latest ``MOST`` on."""
    out = []
    for p in places:
        while p - start > MOST:
            start += MOST
            out.append(start)
        if p - start >= LEAST:
            out.append(p)
            start = p
    while end - start > MOST:
        start += MOST
        out.append(start)
    if end > start:
        out.append(end)
    return out


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for a, _, data, offsets in byte_runs(batch.column(1)):
            places = cuts(data)
            bounds = np.searchsorted(places, offsets, "right")
            rows, number, starts, lengths, digests = [], [], [], [], []
            whole = data.tobytes()
            for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                # A hash near the start of a text must not see the text before it.
                own = places[bounds[k] : bounds[k + 1]]
                ends = chunk_ends(own[own >= s + SEEN].tolist(), s, e) or [e]
                before = begin = s
                for n, end in enumerate(ends):
                    rows.append(a + k)
                    number.append(n)
                    starts.append(begin - s)
                    lengths.append(end - begin)
                    if n and end - begin < LEAST:
                        # The rest of a text is too short to tell by itself: it counts with the chunk before it.
                        digests.append(hashlib.blake2b(whole[before:end], digest_size=16, person=b"tail").digest())
                    else:
                        digests.append(hashlib.blake2b(whole[begin:end], digest_size=16).digest())
                    before, begin = begin, end
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(digests, pa.binary())],
                ["doc_id", "number", "start", "length", "digest"],
            )


def repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All chunks (settled), and those that came before: ``doc_id, number, start, length``.

    The first occurrence of a digest, by doc_id and place, stays. First
    occurrences are found by an aggregate that is reduced before the shuffle
    and written, so that the join beside it is one whose skewed keys Spark
    splits: a passage in a third of all texts is no single task.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    chunks = settle(texts.mapInArrow(chunked, "doc_id long, number int, start long, length long, digest binary"))
    held = chunks.where("length > 0")
    firsts = held.groupBy("digest").agg(F.min(F.struct("doc_id", "number")).alias("first"), F.count("*").alias("n"))
    firsts = settle(firsts.where("n > 1").select("digest", "first"))
    later = held.join(firsts, "digest").where(F.struct("doc_id", "number") != F.col("first"))
    return chunks, later.select("doc_id", "number", "start", "length")


def dedup(docs: DataFrame) -> DataFrame:
    """What each text has repeated: ``doc_id, n_bytes, n_chunks, n_removed, n_repeated, spans``.

    ``spans`` are the byte spans (``start:end``, end exclusive, adjacent ones
    joined) whose content came before in a chunk of a smaller doc_id, or
    earlier in the text; ``n_removed`` their bytes, ``n_repeated`` their
    chunks. A text shorter than ``LEAST`` counts as a whole; a last chunk shorter
    than that only together with the chunk before it, so unlike texts that end
    in the same few bytes lose nothing. Cuts depend on the bytes around them alone, so an insertion moves
    chunks but doesn't change those beyond the next cut.

    One row per doc_id: rows that share one count as one document, whose equal
    chunks at the same place are one. NULL and empty texts have one chunk of no
    bytes. NULL doc_id sorts first. Other columns don't matter; an empty table
    gives an empty result.
    """
    chunks, later = repeated(docs)
    sizes = chunks.groupBy("doc_id").agg(F.sum("length").alias("n_bytes"), F.count("*").alias("n_chunks"))
    gone = later.distinct().groupBy("doc_id").agg(
        F.sum("length").alias("n_removed"),
        F.count("*").alias("n_repeated"),
        F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("s"),
    )
    # A span starts where no other ends, and ends where no other starts.
    starts = F.transform("s", lambda x: x["start"])
    ends = F.transform("s", lambda x: x["end"])
    opens, closes = F.array_except(starts, ends), F.array_except(ends, starts)
    spans = F.array_join(F.zip_with(opens, closes, lambda a, b: F.concat_ws(":", a, b)), ",")
    gone = gone.withColumn("spans", spans).drop("s").withColumnRenamed("doc_id", "_id")
    out = sizes.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return out.fillna(0, ["n_removed", "n_repeated"]).fillna("", ["spans"]).select("doc_id", "n_bytes", "n_chunks", "n_removed", "n_repeated", "spans")


def without(text: Column, spans: Column) -> Column:
    """The text without the byte spans that ``dedup`` found."""

    @F.pandas_udf("string")
    def kept(texts, found):
        out = []
        for t, s in zip(texts, found, strict=True):
            if t and s:
                data, parts, at = t.encode(), [], 0
                for span in s.split(","):
                    a, b = map(int, span.split(":"))
                    parts.append(data[at:a])
                    at = b
                t = b"".join([*parts, data[at:]]).decode(errors="ignore")
            out.append(t)
        import pandas as pd

        return pd.Series(out, dtype=object)

    return kept(text, spans)
