"""Token files: ids ranked by frequency, in whole bytes, with the lengths kept apart in control bytes.

A file set is a folder with three tables. ``blocks`` holds runs of whole
documents in order: their doc_ids and numbers of ids, two bits of length an
id in ``control`` (four ids a byte), and the ids' ranks in one to four bytes
each in ``data``. ``shards`` holds where each shard starts, ``ranks`` the id of
each rank. Rank 0 is the commonest id, so that most ids take one byte.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluxloom.llm.common import spread
from fluxloom.llm.tokens import encoded, encoder
from fluxloom.session import release, settle, shared_dir

#: Ids of a block, unless one document is longer.
BLOCK = 1 << 20

BLOCKS = "shard int, block int, start bigint, n bigint, doc_ids array<bigint>, counts array<bigint>, control binary, data binary"

#: Lengths, in bytes, that the four ids of each control byte have.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)
#: What of four bytes belongs to an id of 1 … 4 bytes.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of 32-bit numbers."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[: len(ranks)] = extra
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    # No wider than the longest: most blocks hold numbers of two bytes at most.
    wide = int(extra.max(initial=0)) + 1
    held = np.arange(wide, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[:, :wide][held].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of control and data bytes: lengths from one table, masks from another, no loop over numbers."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    begins = ends - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    whole = np.zeros(n, np.uint32)
    for k in range(int(lengths.max(initial=0))):
        whole |= padded[begins + k].astype(np.uint32) << np.uint32(8 * k)
    return whole & MASKS[lengths]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def tokenized(batches: Iterator[pa.RecordBatch], path: str, end: int, kind: str) -> Iterator[pa.RecordBatch]:
    """``doc_id, n, crc, ids`` of each row, the ids as ``kind`` and the end id among them."""
    last = np.array([end], "<u4").tobytes()
    names = ["doc_id", "n", "crc", "ids"]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)

    for n, (doc_id, ids) in enumerate(encoded(_rows(batches), path), 1):
        ids += last
        held.append((doc_id, len(ids) // 4, zlib.crc32(ids), np.frombuffer(ids, "<u4").astype(kind).tobytes()))
        if n % 4096 == 0:
            yield batch()
            held = []
    if held:
        yield batch()


def counted(batches: Iterator[pa.RecordBatch], size: int, kind: str) -> Iterator[pa.RecordBatch]:
    n = np.zeros(size, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
        n[: len(found)] += found
    held = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], ["id", "n"])


def blocks(batches: Iterator[pa.RecordBatch], rank: np.ndarray, kind: str, most: int) -> Iterator[pa.RecordBatch]:
    """A sorted partition as blocks; a shard is a partition."""
    shard, number, start = TaskContext.get().partitionId(), 0, 0
    held: list[tuple] = []
    n = 0

    def block() -> pa.RecordBatch:
        control, data = pack(rank[np.frombuffer(b"".join(r[2] for r in held), kind)])
        values = (shard, number, start, n, [r[0] for r in held], [r[1] for r in held], control, data)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [f.split()[0] for f in BLOCKS.split(", ")])

    for row in _rows(batches):
        if held and n + row[1] > most:
            yield block()
            held, number, start, n = [], number + 1, start + n, 0
        held.append(row)
        n += row[1]
    if held:
        yield block()


def write(docs: DataFrame, tokenizer: str, end: int = 1, path: str | None = None, shards: int | None = None, block: int = BLOCK) -> str:
    """Write all texts' ids in ascending order of doc_id; gives the folder.

    A text's ids are the tokenizer's and the id ``end`` behind them. Texts are
    tokenized once, into a table of ids; their counts (at most as many as
    the vocabulary has ids, the one thing that passes the driver) rank the ids.
    The table is dealt to ``shards`` by ranges of (doc_id, number of ids,
    checksum, row), each shard sorted and written in blocks. Spark commits
    whole tasks' files, so a lost executor leaves no half shard.

    NULL doc_id comes first. Rows that share a doc_id are documents each, in
    the order of their numbers of ids, then checksums; the row's own number
    comes last in the range key, so copies of one row spread over shards.
    NULL and empty texts are the end id alone. Other columns don't matter; an
    empty table gives empty tables.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/fluxloom/settled-{uuid.uuid4().hex}-tokens"
    shards = shards or spread(spark)
    size = max(encoder(tokenizer).size, end + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    found = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        lambda it: tokenized(it, tokenizer, end, kind), "doc_id bigint, n bigint, crc bigint, ids binary"
    )
    found = settle(found.withColumn("row", F.monotonically_increasing_id()))
    counts = found.select("ids").mapInArrow(lambda it: counted(it, size, kind), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    ranks = sorted(((-r.n, r.id) for r in counts.collect()))
    rank = np.zeros(size, np.uint32)
    rank[[i for _, i in ranks]] = np.arange(len(ranks))
    named = pa.table({"rank": pa.array(range(len(ranks)), pa.int64()), "id": pa.array([i for _, i in ranks], pa.int64()), "n": pa.array([-n for n, _ in ranks], pa.int64())})
    spark.createDataFrame(named).coalesce(1).write.parquet(f"{path}/ranks")
    order = ["doc_id", "n", "crc", "row"]
    dealt = found.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "n", "ids")
    dealt.mapInArrow(lambda it: blocks(it, rank, kind, block), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    sizes = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n").alias("n"))
    # One row a shard, however many documents: their number is a parameter.
    before = F.coalesce(F.sum("n").over(W.partitionBy().orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes.select("shard", before.alias("shard_start"), "n").coalesce(1).write.parquet(f"{path}/shards")
    release(found)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a file set: ``doc_id, start, n_tokens, ids``.

    ``start`` is the number of ids of all documents before it, ``ids`` its
    ids as little-endian 32-bit integers.
    """
    ids = np.zeros(0, "<u4")
    ranks = spark.read.schema("rank bigint, id bigint, n bigint").parquet(f"{path}/ranks").select("rank", "id").toPandas()
    if len(ranks):
        ids = np.zeros(len(ranks), "<u4")
        ids[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n, doc_ids, counts, control, data in zip(*[batch.column(i) for i in range(6)], strict=True):
                whole = ids[unpack(control.as_py(), data.as_py(), n.as_py())].tobytes()
                counts = np.array(counts.as_py(), np.int64)
                ends = np.cumsum(counts)
                parts = [whole[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(start.as_py() + ends - counts), pa.array(counts), pa.array(parts, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    shards = spark.read.schema("shard int, shard_start bigint, n bigint").parquet(f"{path}/shards").select("shard", "shard_start")
    held = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").join(F.broadcast(shards), "shard")
    held = held.select((F.col("shard_start") + F.col("start")).alias("start"), "n", "doc_ids", "counts", "control", "data")
    return held.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
