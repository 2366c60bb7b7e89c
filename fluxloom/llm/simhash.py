"""SimHash fingerprints linked through a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxloom.llm.common import byte_runs, spread
from fluxloom.llm.components import components
from fluxloom.session import release, settle

#: Words of a shingle, and differing bits two linked fingerprints have at most.
WIDTH, RADIUS = 3, 3
#: Children of an index node.
FAN_OUT = 8
#: Pairs of index nodes looked at in one go.
SLAB = 1 << 17
#: Fingerprints sharing a block's bits beyond which the group is split by a further block, and how often.
GROUP, DEPTH = 20_000, 3


def fingerprints(texts: pa.Array, width: int) -> pa.Array:
    out = np.zeros(len(texts), np.uint64)
    for a, _, data, offsets in byte_runs(texts, 2 << 20):
        hashes: list[int] = []
        counts = []
        for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            # Bytes methods know ASCII alone: the letters A-Z and the six ASCII spaces.
            words = data[s:e].tobytes().lower().split()
            before = len(hashes)
            if len(words) >= width:
                line = b" ".join(words)
                ends = np.cumsum([len(w) + 1 for w in words])
                starts = np.concatenate([[0], ends[:-width]]).tolist()
                hashes += [xxhash.xxh64_intdigest(line[i:j], 42) for i, j in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
            elif words:
                hashes.append(xxhash.xxh64_intdigest(b" ".join(words), 42))
            counts.append(len(hashes) - before)
        n = np.array(counts, np.int64)
        held = np.flatnonzero(n)
        if not held.size:
            continue
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, np.cumsum(n[held]) - n[held], axis=0, dtype=np.int32)
        out[a + held] = np.packbits(2 * ones > n[held, None], axis=1).view(">u8")[:, 0]
    return pa.array(out.view(np.int64))


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """The 64-bit SimHash of a whole text as a long.

    A-Z in lower case, words between ASCII spaces, shingles of ``width`` words
    with repeats (all words, if fewer), each hashed by XXH64 with seed 42; a
    bit is 1 if it is set in over half the hashes. Without words it is 0, and
    so it is for NULL.
    """

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return fingerprints(texts, width)

    return of(text)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code word in the order in which neighbours differ by one bit."""
    rank = codes.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    return rank


def linked(codes: np.ndarray, groups: np.ndarray, radius: int) -> np.ndarray:
    """For each code the number of the first one it is connected with, within its group.

    The index: codes sorted by group and Gray rank, ``FAN_OUT`` neighbours to
    a node and so on upward. A node holds the bits all below it share. Pairs
    of nodes are followed from the root; a pair goes when their shared bits
    already differ in more than ``radius`` places, and is settled as a whole
    when not even the bits that vary could make more than that.
    """
    levels = [(codes, codes, groups, groups)]
    while len(levels[-1][0]) > 1:
        both, either, low, high = levels[-1]
        at = np.arange(0, len(both), FAN_OUT)
        ends = np.minimum(at + FAN_OUT, len(both)) - 1
        levels.append((np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(either, at), low[at], high[ends]))
    label = np.arange(len(codes))
    step = np.arange(FAN_OUT)

    def root(x: np.ndarray) -> np.ndarray:
        while True:
            up = label[x]
            if np.array_equal(up, x):
                return x
            x = up

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        while a.size:
            a, b = root(a), root(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))

    top = len(levels) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > SLAB:
            half = len(i) // 2
            stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
            continue
        both, either, low, high = levels[level]
        meet = (low[i] <= high[j]) & (low[j] <= high[i])
        i, j = i[meet], j[meet]
        shared = ~(both[i] ^ either[i]) & ~(both[j] ^ either[j])
        differ = both[i] ^ both[j]
        near = np.bitwise_count(differ & shared) <= radius
        i, j, shared, differ = i[near], j[near], shared[near], differ[near]
        if level == 0:
            unite(i, j)
            continue
        whole = (np.bitwise_count(differ | ~shared) <= radius) & (low[i] == high[j]) & (low[j] == high[i])
        for node in np.unique(np.concatenate([i[whole], j[whole]])).tolist():
            size = FAN_OUT**level
            below = np.arange(node * size, min((node + 1) * size, len(codes)))
            unite(below, np.full(len(below), below[0]))
        unite(i[whole] * FAN_OUT**level, j[whole] * FAN_OUT**level)
        i, j = i[~whole], j[~whole]
        first = (i[:, None, None] * FAN_OUT + step[None, :, None]).repeat(FAN_OUT, 2).ravel()
        second = (j[:, None, None] * FAN_OUT + step[None, None, :]).repeat(FAN_OUT, 1).ravel()
        n = len(levels[level - 1][0])
        real = (first < n) & (second < n) & (first <= second if level > 1 else first < second)
        if real.any():
            stack.append((level - 1, first[real], second[real]))
    return root(np.arange(len(codes)))


def group_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links that connect what is near within each group: fewer than there are codes.

    Rows come sorted by group; whole groups are indexed together, some hundred
    thousand rows at a time.
    """

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        mask, value, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        _, group = np.unique(np.stack([mask, value], 1), axis=0, return_inverse=True)
        codes = fp.view(np.uint64)
        order = np.lexsort([gray_rank(codes), group.ravel()])
        codes = codes[order]
        first = linked(codes, group.ravel()[order], radius)
        moved = np.flatnonzero(first != np.arange(len(codes)))
        yield pa.RecordBatch.from_arrays([pa.array(codes[moved].view(np.int64)), pa.array(codes[first[moved]].view(np.int64))], ["a", "b"])

    held: list[tuple] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        mask, value, fp = (batch.column(k).to_numpy() for k in range(3))
        if rows > 300_000:
            # Up to the last change of group what is held is whole.
            start = np.flatnonzero((mask != mask[0]) | (value != value[0]))
            cut = 0 if (mask[0], value[0]) != (held[-1][0][-1], held[-1][1][-1]) else int(start[0]) if start.size else None
            if cut is not None:
                held.append((mask[:cut], value[:cut], fp[:cut]))
                yield from flush(held)
                held, rows, mask, value, fp = [], 0, mask[cut:], value[cut:], fp[cut:]
        held.append((mask, value, fp))
        rows += len(fp)
    if held:
        yield from flush(held)


def blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [[int(b) for b in part] for part in np.array_split(bits, parts)]


def mask_of(bits: list[int]) -> int:
    n = sum(1 << b for b in bits)
    return n - (1 << 64) if n >> 63 else n


def links(codes: DataFrame, radius: int = RADIUS, group: int = GROUP, depth: int = DEPTH) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints (``fp``) at ``radius`` or fewer differing bits.

    Of ``radius + 1`` blocks of bits two such fingerprints share at least one
    whole, so each is looked up in the groups of its blocks, and nowhere else.
    A group larger than ``group`` is split the same way by the bits it doesn't
    share yet, up to ``depth`` times.
    """
    spark = codes.sparkSession
    parts = radius + 1
    level = {mask_of(b): b for b in blocks(list(range(64)), parts)}
    keyed = codes.select("fp", F.explode(F.array(*[F.lit(m) for m in level])).alias("mask"))
    ready, used = [], []
    for deeper in range(depth):
        keyed = keyed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        if deeper == depth - 1:
            ready.append(keyed)
            break
        hot = settle(keyed.groupBy("mask", "value").count().where(F.col("count") > group).select("mask", "value"))
        used.append(hot)
        if hot.isEmpty():
            ready.append(keyed)
            break
        ready.append(keyed.join(hot, ["mask", "value"], "left_anti"))
        below = {m: [(b, mask_of(bits + b)) for b in blocks([x for x in range(64) if x not in bits], parts)] for m, bits in level.items()}
        children = F.coalesce(*[F.when(F.col("mask") == m, F.array(*[F.lit(k) for _, k in kids])) for m, kids in below.items()])
        keyed = keyed.join(hot, ["mask", "value"], "left_semi").select("fp", F.explode(children).alias("mask"))
        level = {k: level[m] + b for m, kids in below.items() for b, k in kids}
    whole = ready[0].select("mask", "value", "fp")
    for more in ready[1:]:
        whole = whole.union(more.select("mask", "value", "fp"))
    found = whole.repartition(spread(spark), "mask", "value").sortWithinPartitions("mask", "value").mapInArrow(lambda it: group_links(it, radius), "a long, b long")
    found = settle(found)
    release(*used)
    return found


def classes(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Classes of near copies: ``doc_id, fp, component_id``, one row per row of ``docs``.

    Two texts are linked if their fingerprints differ in ``radius`` or fewer
    bits; ``component_id`` is the smallest doc_id that can be reached. Equal
    fingerprints are one before anything is compared, so a large group of
    copies counts once. Texts without words (NULL, empty, spaces) have
    fingerprint zero and are linked like any other. Rows with NULL doc_id take
    part and get the class's smallest id, if there is one. Repeated rows get
    equal results. Other columns don't matter; an empty table gives an empty
    result.
    """
    prints = settle(docs.select("doc_id", fingerprint(F.col("text"), width).alias("fp")))
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = links(distinct.select("fp"), radius, group)
    roots = settle(components(found))
    release(found)
    joined = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    joined = settle(joined)
    release(distinct, roots)
    named = settle(joined.groupBy("root").agg(F.min("first").alias("component_id")))
    named = settle(joined.select("fp", "root").join(named, "root").select("fp", "component_id"))
    release(joined)
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each class of near copies: the one with the smallest doc_id.

    The classes decide which ids go; only rows of those ids are looked at
    again. Of rows that share the kept id one stays.
    """
    return keep_first(docs, classes(docs, width, radius))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with one row of each class in ``found`` (``doc_id, component_id``): the one with the smallest doc_id."""
    found = settle(found.select("doc_id", "component_id"))
    gone = settle(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct())
    twice = found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id"))
    twice = settle(twice.join(gone, twice["_id"].eqNullSafe(gone["_id"]), "left_anti"))
    same = lambda side: F.col("doc_id").eqNullSafe(side["_id"])
    kept = docs.join(gone, same(gone), "left_anti")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, same(twice), "left_semi")
    return kept.join(twice, same(twice), "left_anti").unionByName(again.dropDuplicates(["doc_id"]))
