"""Mixing sources to target weights by hash-random order and prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluxloom.llm.common import words
from fluxloom.session import release, settle

#: Ranges of the key within a source are told by so many hexadecimal digits.
DIGITS = 3
#: Bits of a row's number that count rows within a run of them.
RUN = 16


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def key_of(doc_id: Column) -> Column:
    """A key that is random but the same in every run."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """What each source should give: columns ``source, source_size, target``.

    ``sizes`` holds one row per source. ``share`` times the sum of all sizes is
    dealt out by weight; a source stops at ``most`` times its size and what it
    can't give goes to the others by weight. With the sources in order of
    size over weight the full ones come first, so the level at which all the
    rest is shared follows from sums over that order: no rounds are needed.
    """
    turn = F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    ranked = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    ranked = (
        ranked.withColumn("rank", F.row_number().over(order))
        .withColumn("left", F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)) - capped)
        .withColumn("rest", rest)
        .withColumn("full", F.col("cap") * F.col("rest") <= F.col("weight") * F.col("left"))
    )
    # The first source that isn't full sets the level of all that follow.
    first = F.min(F.when(~F.col("full"), F.struct("rank", "left", "rest"))).over(W.partitionBy())
    ranked = ranked.withColumn("first", first)
    given = F.when(
        F.col("first").isNull() | (F.col("rank") < F.col("first.rank")), F.col("cap")
    ).otherwise(F.least("cap", F.col("weight") * F.col("first.left") / F.col("first.rest")))
    return ranked.select("source", "source_size", given.alias("target"))


def cuts(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: its size and target, the whole epochs, the last rows of the epoch that is cut and how many of them it takes.

    ``rows`` are ``doc_id, source, size, key``. Within a source rows are
    ordered by key. Sums per range of the key come first (at most
    ``16 ** DIGITS`` rows a source); a running sum over them finds the range
    in which the target ends. Of that range rows equal in (key, doc_id, size)
    are counted, and only these counts are sorted. A source, or copies, that
    hold a third of all rows are therefore never in one place.
    """
    rows = rows.withColumn("part", F.substring("key", 1, DIGITS))
    parts = settle(rows.groupBy("source", "part").agg(F.sum("size").alias("part_size")))
    goals = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, most)
    goals = goals.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    )
    goals = settle(goals.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    running = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = parts.withColumn("before", F.coalesce(F.sum("part_size").over(running), F.lit(0)))
    ends = before.join(goals, same(before, goals)).where(
        (F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("part_size"))
    )
    ends = ends.select(parts["source"].alias("s"), F.col("part").alias("end_part"), "before", "left")
    # The few ranges that are cut go to every row; their number is that of sources.
    inside = rows.join(ends, rows["source"].eqNullSafe(F.col("s")) & (F.col("part") == F.col("end_part"))).where("size > 0")
    alike = inside.groupBy("s", "end_part", "before", "left", "key", "doc_id", "size").agg(F.count("*").alias("n"))
    within = W.partitionBy("s").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(within), F.lit(0))
    # A row across the cut is taken only if that comes nearer to the target: how many of equal ones, one after the other.
    fit = F.floor((F.col("left") - below) / F.col("size") + 0.5)
    alike = alike.withColumn("copies", F.greatest(F.lit(0), F.least("n", fit)).cast("long"))
    taken = F.when(F.col("copies") > 0, F.struct("key", "doc_id", "size", "copies", "n"))
    last = alike.groupBy("s", "end_part").agg(F.max(taken).alias("last"))
    out = settle(
        goals.join(last, goals["source"].eqNullSafe(F.col("s")), "left").select(
            goals["source"], "source_size", "target", "whole", "end_part", F.struct("last.key", "last.doc_id", "last.size").alias("last"), "last.copies", "last.n"
        )
    )
    release(parts, goals)
    return out


def epochs(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Add ``source_size, target`` and ``epochs``, how often the mix takes a row.

    ``rows`` have ``doc_id, source, size, key`` and ``row``, a stored number
    of the row: of rows equal at the cut, some of which are taken, it tells
    which.
    """
    cut = cut.withColumnRenamed("source", "_source")
    at = F.struct("key", "doc_id", "size")
    part = F.substring("key", 1, DIGITS)
    placed = rows.join(cut, F.col("source").eqNullSafe(F.col("_source")))
    at_cut = F.coalesce((at == F.col("last")) & (F.col("copies") < F.col("n")), F.lit(False))
    # Equal rows are numbered within runs of the row number, and runs by what lies before them.
    run = F.shiftright("row", RUN)
    some = placed.where(at_cut).select("source", "copies", "row", run.alias("run"))
    runs = some.groupBy("source", "run").agg(F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(W.partitionBy("source").orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("source").alias("_s"), F.col("run").alias("_run"), before.alias("before"))
    some = some.withColumn("n", F.row_number().over(W.partitionBy("source", "run").orderBy("row")))
    some = some.join(runs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("run") == F.col("_run"))).where(F.col("before") + F.col("n") <= F.col("copies"))
    chosen = settle(some.select(F.col("row").alias("_row")))
    more = (F.col("size") > 0) & ((part < F.col("end_part")) | (part == F.col("end_part")) & (at <= F.col("last")))
    return (
        placed.join(chosen, F.when(at_cut, F.col("row")) == F.col("_row"), "left")
        .withColumn("epochs", F.col("whole") + F.when(F.coalesce(more, F.lit(False)) & (~at_cut | F.col("_row").isNotNull()), 1).otherwise(0))
        .drop("_source", "whole", "end_part", "last", "copies", "n", "_row")
    )


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """What the mix takes of each row: ``doc_id, source, size, source_size, target, epochs, taken``.

    Whole epochs are taken while a source's target holds them, and of the last
    one the rows whose running sum of sizes, in the order of a digest of
    doc_id, stays within what is left. ``taken`` is ``size * epochs``, at most
    ``most`` times the size (rounded up).

    Empty and NULL texts have size 0 and come along with whole epochs. NULL
    sources are one source, last in order. Ties of the key go by doc_id, then
    size; of rows equal in all three as many are taken as come nearest to the target, in the order in which the
    table is read. Other columns don't
    matter. An empty table gives an empty result.
    """
    # Sizes come from whole texts: one pass over them, then narrow rows only.
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), key_of(F.col("doc_id")).alias("key"))
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    taken = epochs(rows, cuts(rows, weights, share, most))
    return taken.select("doc_id", "source", "size", "source_size", "target", "epochs", (F.col("size") * F.col("epochs")).alias("taken"))


def repeat(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, its columns as they were."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_own")
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), key_of(F.col("doc_id")).alias("key"), own)
    # Written once, so that a row has one number in both readings below.
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    taken = epochs(rows, cuts(rows.drop("_own"), weights, share, most)).where("epochs > 0")
    return taken.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("epochs")))).select("_own.*")
