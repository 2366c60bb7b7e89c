"""Merkle manifest of a dataset, with proofs for any set of rows from one multiproof per leaf partition.

A tree's nodes have coordinates (tree, level, pos): leaves are level 0, node
``pos`` of a level has the children ``2 * pos`` and ``2 * pos + 1`` of the one
below. All digests are lowercase hex, as their parents take them in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluxloom.llm.common import spread
from fluxloom.operators.attach import is_small
from fluxloom.session import release, settle

#: Levels a task works out at once, so leaves of a block and of a leaf partition are at most 2 to this.
LEVELS = 11
#: Leaf partitions that may ask for one copy of a node, as a power of 2.
ASKING = 8

PATH = "array<struct<hash:string,left:boolean>>"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its bytes with their number before them; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def ordered(leaves: DataFrame, tree: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Leaves with their places: ``tree, pos, n`` (leaves of the tree), ``part`` and ``columns``.

    Ranges of (tree, order, row) are dealt to tasks, numbered there and moved
    on by what lies before them; the row's own number keeps a range from being
    one of equal rows. A leaf partition is a run of at most ``2 ** LEVELS``
    leaves of a range, whatever trees they belong to.
    """
    spark = leaves.sparkSession
    rows = settle(leaves.select(F.col(tree).alias("tree"), *order, *[c for c in columns if c not in order]).withColumn("row", F.monotonically_increasing_id()))
    keys = ["tree", *order, "row"]
    dealt = settle(rows.repartitionByRange(spread(spark), *keys).withColumn("range", F.spark_partition_id()))
    numbered = settle(dealt.withColumn("at", F.row_number().over(W.partitionBy("range").orderBy(*keys)) - 1).drop("row"))
    release(rows, dealt)
    runs = numbered.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(W.partitionBy("tree").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = settle(runs.select("tree", "range", (before - F.col("first")).alias("moved"), F.sum("here").over(W.partitionBy("tree")).alias("n")))
    runs = runs.withColumnsRenamed({"tree": "_tree", "range": "_range"})
    small = F.broadcast(runs) if is_small(runs) else runs
    placed = numbered.join(small, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("range") == F.col("_range")))
    part = F.col("range").cast("long") * (1 << 32) + F.shiftright("at", LEVELS)
    out = settle(placed.select("tree", (F.col("at") + F.col("moved")).cast("long").alias("pos"), "n", part.alias("part"), *columns))
    release(numbered, runs)
    return out


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def above(hashes: list[str]) -> list[str]:
    """The next level: two nodes to one, a last one alone."""
    return [digest("".join(hashes[i : i + 2])) for i in range(0, len(hashes), 2)]


def height(n: int) -> int:
    """Levels above the leaves."""
    return (n - 1).bit_length()


def build(leaves: DataFrame) -> DataFrame:
    """All nodes of all trees: ``tree, level, pos, hash``; ``leaves`` are ``tree, pos, n, leaf``.

    Blocks of ``2 ** LEVELS`` nodes next to each other are worked out in one
    go, ``LEVELS`` levels up; their tops are the next round's leaves. So the
    number of rounds is the tree's height over ``LEVELS``, and no task holds more than a block.
    """

    def grown(batches: Iterator[pa.RecordBatch], base: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out: list[tuple] = []
                for tree, block, n, hashes in zip(*[c.to_pylist() for c in batch.slice(start, 64).columns], strict=True):
                    for k in range(1, min(LEVELS, height(n) - base) + 1):
                        hashes = above(hashes)
                        out += [(tree, base + k, (block << LEVELS - k) + i, n, h) for i, h in enumerate(hashes)]
                columns = zip(*out, strict=True) if out else [[]] * 5
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["tree", "level", "pos", "n", "hash"])

    now = leaves.select("tree", "pos", "n", F.col("leaf").alias("hash"))
    nodes = [now.select("tree", F.lit(0).alias("level"), "pos", "n", "hash")]
    base = 0
    while True:
        block = F.shiftright("pos", LEVELS).alias("block")
        held = now.where(F.col("n") > F.lit(1 << base)).groupBy("tree", block).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("s"))
        found = held.select("tree", "block", "n", F.transform("s", lambda x: x["hash"]).alias("hashes"))
        found = settle(found.mapInArrow(lambda it, base=base: grown(it, base), "tree string, level int, pos bigint, n bigint, hash string"))
        base += LEVELS
        if found.isEmpty():
            release(found)
            break
        nodes.append(found)
        now = found.where(F.col("level") == base)
    out = nodes[0]
    for more in nodes[1:]:
        out = out.union(more)
    return out


def tops(nodes: DataFrame) -> DataFrame:
    """``tree, hash`` of each tree's last node."""
    # As many levels as n - 1 has binary digits.
    exact = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    return nodes.where((F.col("pos") == 0) & (F.col("level") == exact)).select("tree", "hash")


def missing(held: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per level the nodes a prover of ``held`` leaves of ``n`` must be given: siblings on its paths that it can't derive."""
    held = np.unique(held)
    for level in range(height(n)):
        beside = held ^ 1
        yield level, beside[(beside < n) & ~np.isin(beside, held, assume_unique=True)]
        held, n = np.unique(held >> 1), (n + 1) >> 1


def asked(pdf: pd.DataFrame) -> pd.DataFrame:
    """The coordinates a leaf partition lacks, each once."""
    out = []
    for tree, rows in pdf.groupby("tree", dropna=False, sort=False):
        tree = None if pd.isna(tree) else tree
        for level, places in missing(rows["pos"].to_numpy(), int(rows["n"].iloc[0])):
            out.append(pd.DataFrame({"tree": pd.Series([tree] * len(places), dtype=object), "level": np.int32(level), "pos": places}))
    found = pd.concat(out) if out else pd.DataFrame({"tree": pd.Series(dtype=object), "level": np.int32([]), "pos": np.int64([])})
    found.insert(0, "part", pdf["part"].iloc[0] if len(pdf) else 0)
    return found


def paths(held: np.ndarray, n: int, hashes: list[str], fetched: dict[tuple[int, int], str]) -> list[list[dict]]:
    """The proof of each held leaf: per level its sibling and whether that stands left of it, no hash where it has none.

    Interiors shared by several proofs are derived once, from below.
    """
    known = dict(zip(held.tolist(), hashes, strict=True))
    proofs: list[list[dict]] = [[] for _ in hashes]
    at = held.tolist()
    for level in range(height(n)):
        beside = {p: known.get(p ^ 1) or fetched.get((level, p ^ 1)) for p in known}
        for i, p in enumerate(at):
            proofs[i].append({"hash": beside[p], "left": bool(p & 1)})
            at[i] = p >> 1
        up = {}
        for p, h in known.items():
            if p >> 1 not in up:
                other = beside[p] or ""
                up[p >> 1] = digest(other + h if p & 1 else h + other)
        known = up
    return proofs


def prove(held: DataFrame, nodes: DataFrame) -> DataFrame:
    """``held`` (any rows of ``ordered``'s result, with ``leaf``) and each one's ``path`` to its tree's top.

    Every leaf partition asks for the union of the coordinates its proofs lack
    (an octopus multiproof), fetches each once and derives the rest itself. A
    node near the top is asked for by all partitions below it: it is given out
    in as many copies as keep ``2 ** ASKING`` partitions to a copy.
    """
    names = [c for c in held.columns if c not in ("tree", "pos", "n", "part", "leaf")]
    lacking = held.select("part", "tree", "pos", "n").groupBy("part").applyInPandas(asked, "part bigint, tree string, level int, pos bigint")
    copies = F.pow(F.lit(2), F.greatest(F.lit(0), F.col("level") + 1 - LEVELS - ASKING)).cast("long")
    lacking = lacking.withColumn("copy", F.pmod(F.xxhash64("part"), copies))
    given = nodes.select("tree", "level", "pos", "hash", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy"))
    given = given.withColumnsRenamed({c: f"_{c}" for c in ("tree", "level", "pos", "copy")})
    same = F.col("tree").eqNullSafe(F.col("_tree"))
    for c in ("level", "pos", "copy"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    fetched = settle(lacking.join(given, same).select("part", "tree", "level", "pos", "hash"))

    def expanded(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        key = lambda t: None if pd.isna(t) else t
        by_tree: dict = {}
        for t, level, pos, h in zip(got["tree"], got["level"], got["pos"], got["hash"], strict=True):
            by_tree.setdefault(key(t), {})[level, pos] = h
        out = [rows.assign(path=paths(rows["pos"].to_numpy(), int(rows["n"].iloc[0]), rows["leaf"].tolist(), by_tree.get(key(t), {}))) for t, rows in own.groupby("tree", dropna=False, sort=False)]
        return pd.concat(out) if out else own.assign(path=[])

    types = {f.name: f.dataType.simpleString() for f in held.schema.fields}
    columns = ["part", "tree", "pos", "n", "leaf", *names]
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns)
    return held.select(*columns).groupBy("part").cogroup(fetched.groupBy("part")).applyInPandas(lambda a, b: expanded(a, b)[[*columns, "path"]], f"{schema}, path {PATH}")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def step(done: Column, x: Column) -> Column:
        other = F.coalesce(x["hash"], F.lit(""))
        return F.sha2(F.when(x["left"], F.concat(other, done)).otherwise(F.concat(done, other)).cast("binary"), 256)

    return F.aggregate(path, start, step)


def siblings(path: Column) -> Column:
    """The hashes of a path in one string."""
    return F.array_join(F.transform(F.filter(path, lambda x: x["hash"].isNotNull()), lambda x: x["hash"]), "")


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id", tree: str = "lang", changed: dict[str, Column] | None = None) -> DataFrame:
    """A leaf, its proof and the root for every row: ``key, tree, leaf, changed_leaf, subroot, root, path``.

    A leaf is the digest of ``columns``. Rows of one ``tree`` value (text), in
    ascending order of ``key``, make one tree, the trees' tops in order of
    their value one more, whose top is ``root``. ``path`` leads through both.
    ``changed`` replaces columns by expressions for ``changed_leaf``, which nothing but
    ``fold`` looks at: it tells whether a changed row is found out.

    NULL keys and NULL trees come first and count as values. Rows that share a
    key follow the order of their leaves; equal rows are a leaf each. An empty
    table gives an empty result; one row's leaf is subroot and root, its path empty. Other
    columns don't matter.
    """
    value = {c: F.col(f"`{c}`") for c in columns}
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{tree}`").cast("string").alias("_of"), leaf(*value.values()).alias("leaf"),
        leaf(*(value | (changed or {})).values()).alias("changed_leaf"),
    )
    held = ordered(rows, "_of", ["key", "leaf"], ["key", "leaf", "changed_leaf"])
    nodes = build(held)
    subroots = settle(tops(nodes))
    top = ordered(subroots.select(F.lit("").alias("top"), F.col("tree").alias("of"), F.col("hash").alias("leaf")), "top", ["of"], ["of", "leaf"])
    upper = build(top)
    root = tops(upper).select(F.col("hash").alias("root"))
    ends = settle(prove(top, upper).select("of", F.col("leaf").alias("subroot"), F.col("path").alias("upper")).join(F.broadcast(root)))
    proven = prove(held, nodes)
    small = F.broadcast(ends) if is_small(ends) else ends
    out = proven.join(small, F.col("tree").eqNullSafe(F.col("of")))
    return out.select(F.col("key").alias(key), F.col("tree").alias(tree), "leaf", "changed_leaf", "subroot", "root", F.concat("path", "upper").alias("path"))
