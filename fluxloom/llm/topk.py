"""Exact top-k inner products by a vector-approximation file."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluxloom.session import release, settle, settle_buckets

#: Bits of a cell number.
CELL_BITS = 8
#: Vectors of a block of candidates and of a block of queries.
CANDIDATES, QUERIES = 4096, 4096


def whole(embedding: Column, scale: int = 256) -> Column:
    """Components as integers, rounded down; NULL for vectors that are NULL, empty of meaning or not finite."""
    real = F.transform(embedding, lambda x: x.cast("double"))
    fine = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(real, lambda x: F.floor(x * F.lit(scale)).cast("long")))


class Meeting:
    """Bounds of the inner products of a block of queries with a block of cells.

    A component ``x`` lies in cell ``x >> shift``, so a product lies between
    two bounds that differ by a constant of the query. Sums beyond what a
    double holds exactly widen the bounds by more than they can be off.
    """

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, cells: np.ndarray, ids: np.ndarray, shift: int) -> None:
        wide, step = queries.astype(np.float64), float(1 << shift)
        base = (wide @ cells.T.astype(np.float64)) * step
        reach = np.abs(wide).sum(1) * step * float(1 << (CELL_BITS - 1))
        off = np.where(reach < 2**52, 0.0, reach * 1e-9)[:, None]
        self.upper = base + (step - 1) * np.maximum(wide, 0).sum(1)[:, None] + off
        self.lower = base + (step - 1) * np.minimum(wide, 0).sum(1)[:, None] - off
        own = query_ids[:, None] == ids[None, :]
        self.upper[own] = self.lower[own] = -np.inf


def best_lower(m: Meeting, k: int) -> np.ndarray:
    """The ``k`` highest lower bounds of each query, fewer columns if there are fewer cells."""
    take = min(k, m.lower.shape[1])
    return -np.partition(-m.lower, take - 1, axis=1)[:, :take] if take else m.lower


def read_exact(query: np.ndarray, exact: np.ndarray, ids: np.ndarray, bounds: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` best of exact vectors, read in the order of their bounds in growing blocks until the next bound is below the kth score: ``(-score, vec_id)``."""
    best: list[tuple[int, int]] = []
    order = np.argsort(-bounds, kind="stable")
    at, take = 0, 4 * k
    safe = float(np.abs(query).max(initial=0)) * float(np.abs(exact).max(initial=0)) * exact.shape[1] < 2**62
    while at < len(order) and not (len(best) == k and bounds[order[at]] < -best[-1][0]):
        rows = order[at : at + take]
        scores = (exact[rows] @ query).tolist() if safe else [sum(a * b for a, b in zip(x, query.tolist(), strict=True)) for x in exact[rows].tolist()]
        best = sorted([*best, *zip((-s for s in scores), ids[rows].tolist(), strict=True)])[:k]
        at, take = at + take, 2 * take
    return best


def candidates(fit: DataFrame, k: int) -> DataFrame:
    """Rows that can be among anyone's ``k`` best.

    Equal vectors tie, and ties go to smaller ids: of equal vectors the first
    ``2 * k`` rows do, no id with more than ``k`` of them, as a query passes
    over rows with its own id. Both limits work before the shuffle, so a
    vector that a third of all rows have is a few rows a task.
    """
    of_id = F.row_number().over(W.partitionBy("v", "vec_id").orderBy("vec_id"))
    of_vector = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    few = fit.withColumn("n", of_id).where(F.col("n") <= k)
    return few.withColumn("n", of_vector).where(F.col("n") <= 2 * k).drop("n")


def search(vectors: DataFrame, is_query: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """Results of ``top`` and the exact vectors that were read for them: ``dim, qb, cb, row``."""
    fit = vectors.select("vec_id", whole(F.col("embedding")).alias("v"), is_query.alias("asks"))
    fit = fit.where("vec_id is not null and v is not null and size(v) > 0").withColumn("dim", F.size("v"))
    asked = fit.where("asks").dropDuplicates(["vec_id", "v"])
    asked = asked.withColumn("asked", F.row_number().over(W.partitionBy("vec_id").orderBy("v")))
    # Rows' numbers, stored, place them in blocks: equal ids and near vectors spread like others.
    numbered = lambda df: settle(df.withColumn("row", F.monotonically_increasing_id()))
    queries, far = numbered(asked.drop("asks")), numbered(candidates(fit.drop("asks"), k))
    n_queries = queries.count()
    n, most = far.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.abs(x))))).first()
    shift = max(0, int(most or 0).bit_length() + 1 - CELL_BITS)
    of_c, of_q = -(-n // CANDIDATES) or 1, -(-n_queries // QUERIES) or 1
    place = lambda blocks: F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    keys = ["dim", "qb", "cb"]
    queries = queries.withColumnRenamed("row", "query").withColumn("qb", F.pmod(F.xxhash64("query"), F.lit(of_q)).cast("int"))

    # The approximation file: a byte a component. Exact vectors stay in buckets by row.
    cell = F.transform("v", lambda x: F.shiftright(x, shift).cast("tinyint"))
    cells = settle(far.select("dim", place(of_c).alias("cb"), "row", "vec_id", cell.alias("cell")))
    exact = settle_buckets(far.select("row", "vec_id", "v"), ["row"], ["row"])
    release(far)
    cells_met = cells.select("dim", every(of_q).alias("qb"), "cb", "row", "vec_id", "cell").groupBy(*keys)

    def bounds(q: pd.DataFrame, c: pd.DataFrame) -> Meeting:
        return Meeting(np.stack(q["v"].to_numpy()), q["vec_id"].to_numpy(), np.stack(c["cell"].to_numpy()), c["vec_id"].to_numpy(), shift)

    def least(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not (len(q) and len(c)):
            return pd.DataFrame({"query": [], "low": []})
        low = best_lower(bounds(q, c), k)
        found = pd.DataFrame({"query": np.repeat(q["query"].to_numpy(), low.shape[1]), "low": low.ravel()})
        return found[found["low"] > -np.inf]

    def within(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not (len(q) and len(c)):
            return pd.DataFrame({name: [] for name in [*keys, "row"]})
        m = bounds(q, c)
        reach = ((m.upper >= q["kth"].fillna(-np.inf).to_numpy()[:, None]) & (m.upper > -np.inf)).any(0)
        return pd.DataFrame({**{name: q[name].iloc[0] for name in keys}, "row": c["row"].to_numpy()[reach]})

    def certain(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(q) and len(c):
            vectors, ids = np.stack(c["v"].to_numpy()), c["vec_id"].to_numpy()
            m = Meeting(np.stack(q["v"].to_numpy()), q["vec_id"].to_numpy(), vectors >> shift, ids, shift)
            for one, query_id, asked, kth, upper in zip(q["v"], q["vec_id"], q["asked"], q["kth"].fillna(-np.inf), m.upper, strict=True):
                left = np.flatnonzero((upper >= kth) & (upper > -np.inf))
                found += [(query_id, asked, i, -s) for s, i in read_exact(np.asarray(one), vectors[left], ids[left], upper[left], k)]
        return pd.DataFrame(found, columns=["query_id", "asked", "vec_id", "score"])

    # First scan of cells: at least k candidates of a query reach its kth lower bound.
    near = queries.select("dim", "qb", every(of_c).alias("cb"), "query", "vec_id", "v")
    low = near.groupBy(*keys).cogroup(cells_met).applyInPandas(least, "query long, low double")
    low = low.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.desc("low")))).where(F.col("n") <= k)
    kth = low.groupBy("query").agg(F.when(F.count("*") == k, F.min("low")).alias("kth"))
    known = settle(queries.join(kth, "query", "left"))
    # Second scan: what can reach it is read exactly, once a block of queries.
    near = known.select("dim", "qb", every(of_c).alias("cb"), "query", "asked", "vec_id", "v", "kth")
    reach = near.groupBy(*keys).cogroup(cells_met).applyInPandas(within, "dim int, qb int, cb int, row long")
    reach = settle(reach)
    read = reach.join(exact, "row")
    found = near.groupBy(*keys).cogroup(read.groupBy(*keys)).applyInPandas(certain, "query_id long, asked int, vec_id long, score long")
    best = W.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    release(cells)
    return ranked.select("query_id", "rank", "vec_id", "score", "asked"), reach


def top(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """Each query's ``k`` highest inner products with all other vectors: ``query_id, rank, vec_id, score, asked``.

    ``vectors`` has ``vec_id`` and ``embedding``; components count as
    ``whole`` makes them. Ties go to the smaller vec_id. Vectors that are NULL,
    hold NULL or a component that isn't finite, and rows with NULL vec_id take
    no part. Vectors of another length than the query's have no product with
    it. Repeated rows are candidates each; a row with the query's own vec_id
    is none. Rows that share a vec_id ask once for each of their vectors;
    ``asked`` numbers these from 1. Fewer candidates give fewer rows; an empty table gives none.

    Blocks of queries meet blocks of cells twice: for a lower bound of each
    query's kth score over all candidates, then for the candidates that can
    reach it. Only of those, exact vectors travel, and they are read in the
    order of their bounds until the kth result is certain. No pair becomes a
    row, groups are of bounded size, and ``k`` rows a query go on from each.
    """
    return search(vectors, is_query, k)[0]
