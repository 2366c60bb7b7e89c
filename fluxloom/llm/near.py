"""Near copies: SimHash fingerprints and rare word shingles propose pairs, exact Jaccard similarity decides."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluxloom.llm.common import byte_runs
from fluxloom.llm.components import components
from fluxloom.llm.simhash import RADIUS, keep_first, links
from fluxloom.session import release, settle

#: Words of a shingle, and the least similarity as a fraction.
WIDTH, LEAST = 5, (4, 5)
#: Bits that tell the weight of a shingle, and the share of texts weights are taken from: they order shingles, which never changes a result.
BITS, SAMPLE = 16, 16
#: Texts that one task compares with the same text.
TOGETHER = 256


def shingles(text: bytes, width: int) -> np.ndarray:
    """Hashes of a text's distinct shingles, sorted; of all its words, if there are fewer than ``width``."""
    codes = np.array([xxhash.xxh64_intdigest(w, 42) for w in text.lower().split()], np.uint64)
    width = min(width, len(codes))
    if not width:
        return codes
    n = len(codes) - width + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed = (mixed ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def fingerprint(codes: np.ndarray) -> int:
    """A bit is 1 where more than half of the shingles have it; as a signed number."""
    if not len(codes):
        return 0
    bits = np.unpackbits(codes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    most = 2 * bits.sum(0, dtype=np.int64) > len(codes)
    return int(np.packbits(most).view(">i8")[0])


def digest(codes: np.ndarray) -> bytes:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).digest()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles are as similar as asked, in whole numbers; sets without any are."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    # i / (a + b - i) >= p / q, without division
    return sum(LEAST) * both >= LEAST[0] * (len(a) + len(b))


def each(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in byte_runs(texts, 2 << 20):
        for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            yield shingles(data[s:e].tobytes(), width)


def weights(docs: DataFrame, width: int) -> np.ndarray:
    """How many shingles of a sample share their first ``BITS`` bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for codes in each(batch.column(0), width):
                np.add.at(n, (codes >> np.uint64(64 - BITS)).astype(np.int64), 1)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], ["bucket", "n"])

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    out = np.zeros(1 << BITS, np.int64)
    for bucket, n in sample.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def prefixes(batches: Iterator[pa.RecordBatch], width: int, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each text a digest, the fingerprint and the number of its shingles, and its rarest ones, by 32 bits: as many as two near sets can't both keep apart."""
    for batch in batches:
        digests, sizes, prints, ends, rare = [], [], [], [0], [np.zeros(0, np.uint64)]
        for codes in each(batch.column(1), width):
            digests.append(digest(codes))
            sizes.append(len(codes))
            prints.append(fingerprint(codes))
            most = len(codes) + LEAST[0] * len(codes) // -LEAST[1] + 1
            rare.append(codes[np.lexsort([codes, weight[codes >> np.uint64(64 - BITS)]])[:most]])
            ends.append(ends[-1] + len(rare[-1]))
        # Shingles that share 32 bits only meet more often.
        short = (np.concatenate(rare) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(short))
        columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), lists]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "size", "print", "prefix"])


def digested(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, _, _ in byte_runs(batch.column(0), 2 << 20):
            texts = batch.column(0).slice(a, b - a)
            yield pa.RecordBatch.from_arrays([pa.array([digest(codes) for codes in each(texts, width)], pa.binary()), texts], ["digest", "text"])


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Those of ``pairs`` (``a, b``) whose whole sets are as similar as asked.

    A text goes to the tasks in which it is compared: as ``a`` once for every
    ``TOGETHER`` texts it meets, as ``b`` once a pair.
    """
    many = F.ceil(F.count("*") / TOGETHER).cast("int").alias("many")
    groups = settle(pairs.groupBy("a").agg(many))
    spread = F.pmod(F.xxhash64("b"), F.col("many")).cast("int").alias("salt")
    asked = pairs.join(groups, "a").select("a", spread, F.col("b").alias("node"))
    asked = asked.union(groups.select("a", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("salt"), F.col("a").alias("node")))
    asked = settle(asked.join(nodes.select("node", "digest", "first"), "node"))
    # A doc_id may stand for several texts: of those that have it, the digest tells which one is meant.
    texts = docs.join(asked.select("first").distinct(), F.col("doc_id").eqNullSafe(F.col("first")), "left_semi").select("text")
    texts = texts.mapInArrow(lambda it: digested(it, width), "digest binary, text string").dropDuplicates(["digest"])
    sent = texts.join(asked, "digest").select("a", "salt", "node", F.coalesce("text", F.lit("")).alias("text"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a = rows["a"].iloc[0]
        sets = {n: shingles(t.encode(), width) for n, t in zip(rows["node"], rows["text"], strict=True)}
        near = [n for n in sets if n != a and alike(sets[a], sets[n])]
        return pd.DataFrame({"a": np.int64([a] * len(near)), "b": np.int64(near)})

    out = settle(sent.groupBy("a", "salt").applyInPandas(compare, "a long, b long"))
    release(groups, asked)
    return out


def by_prints(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a, b`` of ``nodes`` (``node, print``) that connect all whose fingerprints differ in ``radius`` or fewer bits.

    The index of ``simhash`` finds them; of the nodes of one fingerprint each
    is paired with the least. There are fewer pairs than links and nodes.
    """
    prints = settle(nodes.groupBy("print").agg(F.min("node").alias("least")))
    found = links(prints.select(F.col("print").alias("fp")), radius)
    one, two = (prints.select(F.col("print").alias(p), F.col("least").alias(f"{p}_least")) for p in ("a", "b"))
    across = found.distinct().join(one, "a").join(two, "b").select(F.least("a_least", "b_least").alias("a"), F.greatest("a_least", "b_least").alias("b"))
    within = nodes.select("node", "print").join(prints, "print").select(F.col("least").alias("a"), F.col("node").alias("b"))
    pairs = settle(across.union(within).where("a <> b").distinct())
    release(prints, found)
    return pairs


def meetings(nodes: DataFrame) -> DataFrame:
    """Where ``nodes`` (``node, size, prefix``) meet others: ``node, size, own, code, most`` per shingle of a prefix that another prefix has.

    ``own``: how many shingles of the prefix no other one has. ``most``: how
    many a set can share with another one if this is the first one they share:
    neither its own ones nor those it has before.
    """
    places = nodes.select("node", "size", F.size("prefix").alias("n"), F.posexplode("prefix").alias("pos", "code"))
    shared = settle(places.groupBy("code").agg(F.count("*").alias("many")).where("many > 1").select("code"))
    met = places.join(shared, "code")
    of = W.partitionBy("node")
    met = met.withColumn("own", F.col("n") - F.count("*").over(of)).withColumn("before", F.row_number().over(of.orderBy("pos")) - 1)
    met = settle(met.select("node", "size", "own", "code", (F.col("size") - F.col("own") - F.col("before")).alias("most")))
    release(shared)
    return met


def classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Classes of near copies: ``doc_id, component_id``, one row per row of ``docs``.

    Two texts are linked if the sets of their shingles (words as in
    ``simhash``) have a Jaccard similarity of at least ``LEAST``;
    ``component_id`` is the smallest doc_id that can be reached. Sets that are
    equal are one before anything is compared.

    First come the pairs that the index of SimHash fingerprints (of the same
    shingles) links. Fingerprints of sets so similar may differ in more bits,
    so that others come from the shingles: in one order of all of them, two
    such sets share one of their first ones, of as many as a near set may lack
    and one more. Rare ones come first, so few texts meet. A pair goes no
    further where the sizes, or the shingles that one of the two can't share
    (``meetings``), rule a link out, which loses none. The rest are compared
    as whole sets: at each shingle first with the set that has the fewest
    shingles of its own there, and then, as often as they meet, those that are
    not connected yet.

    Texts without words are one class. Rows with NULL doc_id take part and get
    the class's smallest id, if there is one;
    rows that share a doc_id may hold different texts. Other columns don't matter; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    weight = weights(docs, width)
    held = settle(docs.select("doc_id", "text").mapInArrow(lambda it: prefixes(it, width, weight), f"doc_id {kind}, digest binary, size int, print long, prefix array<int>"))
    nodes = held.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first(F.struct("size", "print", "prefix")).alias("s"))
    nodes = settle(nodes.select("digest", "first", "s.*").withColumn("node", F.monotonically_increasing_id()))
    told = by_prints(nodes)
    met = meetings(nodes)
    both = F.col("a_size") + F.col("b_size")
    # i / (a + b - i) >= p / q, without division; a pair shares no more than either can, and no more than the smaller one has.
    close = (sum(LEAST) * F.least("a_most", "b_most") >= LEAST[0] * both) & (LEAST[1] * F.least("a_size", "b_size") >= LEAST[0] * F.greatest("a_size", "b_size"))
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    side = lambda df, s: df.select("code", *[F.col(c).alias(f"{s}_{c}") for c in df.columns if c not in ("code", "node")], F.col("node").alias(s))

    hubs = settle(met.groupBy("code").agg(F.min(F.struct("own", "size", "node", "most")).alias("hub")).select("code", "hub.*"))
    star = settle(side(hubs, "a").join(side(met, "b"), "code").where((F.col("a") != F.col("b")) & close).select("a", "b").distinct())
    done = settle(ordered(star).union(told).distinct())
    found = confirmed(docs, nodes, star.union(told.join(ordered(star), ["a", "b"], "left_anti")).distinct(), width)
    release(told, star, hubs)
    roots = settle(components(found))

    left = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = settle(left.groupBy("code").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("code"))
    # Sizes come along, so that nothing but candidates leaves the join.
    left = settle(left.join(apart, "code", "left_semi").select("code", "root", "node", "size", "most"))
    release(met, roots, apart)
    pairs = side(left, "a").join(side(left, "b"), "code").where((F.col("a") < F.col("b")) & (F.col("a_root") != F.col("b_root")) & close).select("a", "b").distinct()
    pairs = settle(pairs.join(done, ["a", "b"], "left_anti"))
    release(left, done)
    more = confirmed(docs, nodes, pairs, width)
    release(pairs)
    roots = settle(components(found.union(more)))
    release(found, more)

    named = nodes.select("node", "digest", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = settle(named.select("digest", "first", "root"))
    least = settle(named.groupBy("root").agg(F.min("first").alias("component_id")))
    named = settle(named.join(least, "root").select("digest", "component_id"))
    release(nodes, roots, least)
    return held.select("doc_id", "digest").join(named, "digest").select("doc_id", "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each class of near copies: the one with the smallest doc_id."""
    return keep_first(docs, classes(docs, width))
