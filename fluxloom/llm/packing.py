"""Best-fit packing of token sequences, locally first, then up a tree of partitions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxloom.llm.tokens import encoded
from fluxloom.session import settle

#: Tokens of a sequence.
CAPACITY = 2048
#: A bin with at most so many tokens free is nearly full and leaves the tree.
SLACK = 4
#: Partitions that meet in one at each step up the tree, and bins a task takes at most before the tree stops narrowing.
FAN_IN, PER_TASK = 8, 200_000

MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"
BIN = f"total int, done boolean, members array<{MEMBER}>"
_MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def best_fit(sizes: np.ndarray) -> list[list[int]]:
    """Bins of item numbers: largest items first, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
    free_ones = 0  # bit f: a bin has f tokens free
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        fitting = free_ones >> n
        if fitting:
            f = n + (fitting & -fitting).bit_length() - 1
            b = by_free[f].pop()
            if not by_free[f]:
                free_ones ^= 1 << f
            bins[b].append(i)
        else:
            f, b = CAPACITY, len(bins)
            bins.append([i])
        if f > n:
            by_free[f - n].append(b)
            free_ones |= 1 << (f - n)
    return bins


def as_batch(total: np.ndarray, done: np.ndarray, offsets: np.ndarray, members: pa.Array) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), members)
    return pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(done, pa.bool_()), lists], ["total", "done", "members"])


def packed(sizes: np.ndarray, members: pa.ListArray, last: bool) -> pa.RecordBatch:
    """Bins made of smaller bins, whose members stay together in their order."""
    bins = best_fit(sizes)
    order = np.fromiter((i for b in bins for i in b), np.int64)
    ends = np.cumsum([len(b) for b in bins])
    counts = members.value_lengths().to_numpy(zero_copy_only=False)[order]
    offsets = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], ends])]
    total = np.add.reduceat(sizes[order], np.concatenate([[0], ends[:-1]]))
    return as_batch(total, (CAPACITY - total <= SLACK) | last, offsets, members.take(pa.array(order)).flatten())


def tokenized(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Cut every text into pieces; full pieces are bins of their own, the rest of the partition is packed."""
    rows: list[list] = [[], [], [], [], []]
    texts = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    for doc_id, ids in encoded(texts, path):
        ids += b"\0\0\0\0"
        for k, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
            part = ids[at : at + 4 * CAPACITY]
            for column, value in zip(rows, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                column.append(value)
    if not rows[0]:
        return
    members = pa.StructArray.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _MEMBER, strict=True)], fields=list(_MEMBER))
    lengths = np.array(rows[3], np.int64)
    full = np.flatnonzero(lengths == CAPACITY)
    if full.size:
        yield as_batch(lengths[full], np.ones(full.size, bool), np.arange(full.size + 1), members.take(pa.array(full)))
    rest = np.flatnonzero(lengths < CAPACITY)
    if rest.size:
        alone = pa.ListArray.from_arrays(pa.array(np.arange(rest.size + 1), pa.int32()), members.take(pa.array(rest)))
        yield packed(lengths[rest], alone, False)


def merged(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """One node of the tree: the bins of its children packed again, as items."""
    whole = pa.Table.from_batches(list(batches)).combine_chunks() if (batches := list(batches)) else None
    if whole is not None and whole.num_rows:
        yield packed(whole["total"].to_numpy().astype(np.int64), whole["members"].combine_chunks(), last)


def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece, with its place in the sequence."""
    for batch in batches:
        lists = batch.column(1)
        counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        length = flat.field("length").to_numpy()
        ends = np.cumsum(length)
        before = ends - length
        first = np.cumsum(counts) - counts
        offset = before - np.repeat(before[first], counts) if counts.size else before
        sequence = np.repeat(batch.column(0).to_numpy(), counts)
        yield pa.RecordBatch.from_arrays(
            [*flat.flatten(), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
            [*[f.name for f in _MEMBER], "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pack all texts into sequences of at most ``CAPACITY`` tokens, as few as best fit finds.

    A text is its token ids and id 0 behind them; only longer ones are cut.
    Each partition of the input is tokenized and packed where it is. Bins
    that are nearly full leave; the others go up as items, ``FAN_IN``
    partitions meeting in one, and are packed again, until one partition is
    left. Should more than ``PER_TASK`` underfull bins a task remain (say, all
    just over half full), the tree stops narrowing there, so no task ever
    takes more; its result stays complete. Each step is a written table: a
    lost executor costs one step's tasks.

    Result: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``,
    one row per piece. NULL reads as the empty text, which is the single id 0.
    Rows sharing a doc_id, repeated ones among them, are packed each for
    itself. Ties go by the order of the input. Other columns don't matter. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    step = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lambda it: tokenized(it, tokenizer), BIN)
    done = []
    tasks = None
    while True:
        number = (F.monotonically_increasing_id() * 64 + len(done)).alias("sequence_id")
        step = settle(step.select(number, "total", "done", "members"))
        done.append(step.where("done").select("sequence_id", "members"))
        left = step.where("not done").count()
        if not left or tasks == 1 or len(done) > 60:
            break
        needed = -(-left // PER_TASK)
        before = tasks or max(1, step.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
        tasks = max(1, needed, -(-before // FAN_IN))
        last = tasks == 1 or tasks >= before
        step = step.where("not done").select("total", "done", "members").coalesce(tasks).mapInArrow(lambda it, last=last: merged(it, last), BIN)
        tasks = 1 if last else tasks
    bins = done[0]
    for more in done[1:]:
        bins = bins.union(more)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return bins.mapInArrow(placed, schema)
