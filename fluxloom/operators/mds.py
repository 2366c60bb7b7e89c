"""Marginal distribution sampling: fill gaps from similar conditions nearby in time.

After Reichstein et al. 2005 (Global Change Biology 11, 1424-1439) and Wutzler
et al. 2018 (Biogeosciences 15, 5015-5030). A gap takes the mean of at least
two donors, from the first stage that offers them:

1. three drivers alike within ±7, then ±14 days
2. radiation alike within ±7 days
3. same time of day ±1 h on the same day, then ±1, ±2 days
4. three drivers within ±21 … ±70 days
5. radiation within ±14 … ±70 days
6. same time of day within ±7 … ±210 days

How it is run: the stages of one line differ only in window width, so one
range join serves all of them: donors are counted per ring (distance class)
and the first ring reaching two donors is taken. The join is an equality join
on (series, stretch of time, cells of the drivers) with the exact distances as
remaining conditions, so a gap meets only rows that are nearly alike, and at
most those of its time window. Unresolved gaps go on to the next line through
a written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxloom.functions import timeparts as tp
from fluxloom.session import settle

LOOKUP3, LOOKUP1, DIURNAL = 1, 2, 3

#: (method, half-widths in days) in the order they are tried.
STAGES: tuple[tuple[int, tuple[int, ...]], ...] = (
    (LOOKUP3, (7, 14)),
    (LOOKUP1, (7,)),
    (DIURNAL, (0, 1, 2)),
    (LOOKUP3, tuple(range(21, 71, 7))),
    (LOOKUP1, tuple(range(14, 71, 7))),
    (DIURNAL, tuple(range(7, 211, 7))),
)
RG_FLOOR = 20.0


def _ring(distance: Column, limits: Sequence[int]) -> Column:
    """Index of the narrowest window that holds the distance."""
    out: Column | None = None
    for i, limit in enumerate(limits):
        test = distance <= limit
        out = F.when(test, i) if out is None else out.when(test, i)
    return out


def _stretches(place: Column, reach: int, length: int) -> Column:
    """Numbers of the stretches of ``length`` that lie within ``reach`` of a place."""
    return F.sequence(F.floor((place - reach) / length), F.floor((place + reach) / length))


def _cells(x: Column, width: float) -> Column:
    cell = F.floor(x / width)
    return F.sequence(cell - 1, cell + 1)


def _lookup_pairs(
    todo: DataFrame, donors: DataFrame, ids: list[str], days: Sequence[int], per_day: int, tol: Sequence[float], three: bool
) -> DataFrame:
    reach = days[-1] * per_day
    length = 2 * reach
    on = [*ids, "_stretch"]
    gaps = todo.filter(F.col("_d1").isNotNull())
    gaps = gaps.withColumn("_stretch", F.explode(_stretches(F.col("_pos"), reach, length)))
    cell_of = [("_d2", tol[1]), ("_d3", tol[2])] if three else [("_d1", max(tol[0], RG_FLOOR))]
    give = donors.withColumn("_stretch", F.floor(F.col("_pos") / length))
    for d, width in cell_of:
        gaps = gaps.filter(F.col(d).isNotNull()).withColumn(f"_cell{d}", F.explode(_cells(F.col(d), width)))
        give = give.filter(F.col(d).isNotNull()).withColumn(f"_cell{d}", F.floor(F.col(d) / width))
        on.append(f"_cell{d}")
    give = give.withColumnsRenamed({c: f"_g{c}" for c in ("_pos", "_d1", "_d2", "_d3")})
    tol1 = F.greatest(F.least(F.lit(float(tol[0])), F.col("_d1")), F.lit(RG_FLOOR))
    away = F.abs(F.col("_g_pos") - F.col("_pos"))
    alike = (away <= reach) & (F.abs(F.col("_g_d1") - F.col("_d1")) < tol1)
    if three:
        alike = (
            alike
            & (F.abs(F.col("_g_d2") - F.col("_d2")) < tol[1])
            & (F.abs(F.col("_g_d3") - F.col("_d3")) < tol[2])
        )
    ring = _ring(away, [d * per_day for d in days])
    return gaps.join(give, on).filter(alike).select(*ids, "_pos", ring.alias("_ring"), "_y")


def _merged(parts: Column) -> Column:
    """Number, mean and squared deviations of moments ``(n, m, q)`` put together, in two passes over them: nothing cancels."""
    n = F.aggregate(parts, F.lit(0).cast("long"), lambda done, p: done + p["n"])
    mean = F.aggregate(parts, F.lit(0.0), lambda done, p: done + p["n"] * p["m"]) / n
    return F.transform(
        F.array(F.struct(n.alias("n"), mean.alias("m"))),
        lambda whole: F.struct(
            whole["n"].alias("n"), whole["m"].alias("m"),
            F.aggregate(parts, F.lit(0.0), lambda done, p: done + p["q"] + p["n"] * (p["m"] - whole["m"]) ** 2).alias("q"),
        ),
    )[0]


def _moment_tree(days: DataFrame, by: list[str], levels: int, at_once: int = 4) -> DataFrame:
    """Moments of 1, 2, 4 … days aligned to their number: ``by, _level, _node, n, m, q``.

    ``at_once`` levels are made in one pass from the last level of the pass before.
    """
    tree = level = days.select(*by, F.lit(0).alias("_level"), F.col("_day").alias("_node"), "n", "m", "q")
    for base in range(0, levels, at_once):
        top = min(base + at_once, levels)
        up = level.withColumn("_up", F.explode(F.sequence(F.lit(1), F.lit(top - base))))
        node = F.floor(F.col("_node") / F.pow(F.lit(2.0), F.col("_up"))).cast("long").alias("_node")
        found = up.groupBy(*by, (F.col("_up") + base).alias("_level"), node).agg(_merged(F.collect_list(F.struct("n", "m", "q"))).alias("s"))
        found = settle(found.select(*by, "_level", "_node", "s.*"))
        tree, level = tree.unionByName(found), found.filter(F.col("_level") == top)
    return tree


def _aligned(first: Column, end: Column, levels: int) -> Column:
    """Nodes (level, node) of a moment tree that make up the days ``first`` … ``end - 1``: at most two a level."""
    up = lambda x, size: F.ceil(x / size).cast("long")
    down = lambda x, size: F.floor(x / size).cast("long")

    def at(k: int) -> Column:
        lo, hi = up(first, 1 << k), down(end, 1 << k)
        in_lo, in_hi = up(first, 2 << k) * 2, down(end, 2 << k) * 2
        # Of the top level all; below it what larger nodes leave over at either end.
        ends = F.array(F.when(lo < in_lo, lo), F.when(in_hi < hi, in_hi))
        alone = F.array(F.when(lo < hi, lo), F.when(lo + 1 < hi, lo + 1))
        taken = F.when(in_lo < in_hi, ends).otherwise(alone) if k < levels else F.sequence(lo, F.greatest(lo, hi - 1))
        taken = F.filter(taken, lambda x: x.isNotNull() & (x < hi))
        return F.transform(taken, lambda x: F.struct(F.lit(k).alias("level"), x.alias("node")))

    return F.flatten(F.array(*[at(k) for k in range(levels + 1)]))


def _diurnal_found(
    todo: DataFrame, donors: DataFrame, ids: list[str], days: Sequence[int], per_day: int, near: int
) -> DataFrame:
    """Mean, deviation and number of donors at the same clock time, of the narrowest window with two of them.

    No gap is paired with a donor. Donors become moments per clock time and
    day; a sweep along the days finds, for every day with a gap, how far away
    the second nearest donor is, and so the window; its moments are put
    together from the nodes of a tree over the days.
    """
    by = [*ids, "_clock"]
    day, clock = F.floor(F.col("_pos") / per_day), F.pmod(F.col("_pos"), F.lit(per_day))
    # A donor serves the clock times up to one hour either side of its own.
    served = donors.select(*ids, "_y", F.explode(F.sequence(F.col("_pos") - near, F.col("_pos") + near)).alias("_pos"))
    served = served.select(*by[:-1], clock.alias("_clock"), day.alias("_day"), "_y")
    moments = [F.count(F.lit(1)).alias("n"), F.avg("_y").alias("m"), (F.var_pop("_y") * F.count(F.lit(1))).alias("q")]
    base = settle(served.groupBy(*by, "_day").agg(*moments))
    gaps = todo.select(*ids, "_pos", clock.alias("_clock"), day.alias("_day"))

    # Days with donors and days with gaps on one line per clock time; each day sees the nearest donors on either side.
    line = gaps.select(*by, "_day").distinct().join(base.select(*by, "_day", "n"), [*by, "_day"], "full")
    held = F.when(F.col("n") > 0, F.struct(F.col("_day").alias("d"), F.col("n").alias("n")))
    place = ", ".join(f"`{k}`" for k in by)

    def beside(order: str, k: int) -> Column:
        return F.expr(f"lag(_held, {k}) IGNORE NULLS OVER (PARTITION BY {place} ORDER BY _day {order})")

    line = line.withColumn("_held", held)
    line = line.select(*by, "_day", "n", *[beside(o, k).alias(f"_{o}{k}") for o in ("ASC", "DESC") for k in (1, 2)])
    seen = [F.when(F.col("n") > 0, F.struct(F.lit(0).cast("long").alias("away"), F.col("n").alias("n")))]
    for name in ("_ASC1", "_ASC2", "_DESC1", "_DESC2"):
        seen.append(F.when(F.col(name).isNotNull(), F.struct(F.abs(F.col(f"{name}.d") - F.col("_day")).alias("away"), F.col(f"{name}.n").alias("n"))))
    near_by = F.array_sort(F.filter(F.array(*seen), lambda x: x.isNotNull()))
    # Along the sorted distances: where two donors are reached.
    reached = F.aggregate(
        near_by, F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("away")),
        lambda done, x: F.struct(
            (done["n"] + x["n"]).alias("n"), F.when(done["away"].isNotNull(), done["away"]).when(done["n"] + x["n"] >= 2, x["away"]).alias("away")
        ),
        lambda done: done["away"],
    )
    half = F.element_at(F.array(*[F.lit(d) for d in days]), _ring(F.col("_reached"), days) + 1)
    line = line.select(*by, "_day", reached.alias("_reached")).where(F.col("_reached") <= days[-1]).select(*by, "_day", half.alias("_half"))
    wanted = settle(line)

    # A window of a few days is its days.
    levels = (2 * days[-1] + 1).bit_length() - 1 if days[-1] > 3 else 0
    tree = _moment_tree(base, by, levels)
    nodes = _aligned(F.col("_day") - F.col("_half"), F.col("_day") + F.col("_half") + 1, levels)
    asked = wanted.select(*by, "_day", "_half", F.explode(nodes).alias("_x")).select(*by, "_day", "_half", F.col("_x.level").alias("_level"), F.col("_x.node").alias("_node"))
    got = asked.join(tree, [*by, "_level", "_node"]).groupBy(*by, "_day", "_half").agg(_merged(F.collect_list(F.struct("n", "m", "q"))).alias("s"))
    got = got.select(*by, "_day", "_half", F.col("s.m").alias("_mean"), F.sqrt(F.col("s.q") / (F.col("s.n") - 1)).alias("_sd"), F.col("s.n").cast("int").alias("_n"))
    return gaps.join(got, [*by, "_day"]).select(*ids, "_pos", "_mean", "_sd", "_n", "_half")


def _first_enough(pairs: DataFrame, ids: list[str], days: Sequence[int]) -> DataFrame:
    """Mean, deviation and number of donors of the narrowest window with two of them.

    Rings before the one taken hold one donor at most, hence the two-part
    combination of means and squared deviations.
    """
    gap = [*ids, "_pos"]
    rings = pairs.groupBy(*gap, "_ring").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("m"), F.var_pop("_y").alias("v")
    )
    w = Window.partitionBy(*gap).orderBy("_ring")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    n0 = F.coalesce(F.sum("n").over(before), F.lit(0))
    m0 = F.coalesce(F.last("m").over(before), F.lit(0.0))
    n, n_all = F.col("n"), F.col("n") + F.col("_n0")
    mean = (n * F.col("m") + F.col("_n0") * F.col("_m0")) / n_all
    spread = n * F.col("v") + (F.col("m") - F.col("_m0")) ** 2 * n * F.col("_n0") / n_all
    half_width = F.element_at(F.array(*[F.lit(d) for d in days]), F.col("_ring") + 1)
    return (
        rings.withColumn("_n0", n0)
        .withColumn("_m0", m0)
        .filter((F.col("_n0") < 2) & (n_all >= 2))
        .select(
            *gap,
            mean.alias("_mean"),
            F.sqrt(spread / (n_all - 1)).alias("_sd"),
            n_all.cast("int").alias("_n"),
            half_width.alias("_half"),
        )
    )


def quality(method: Column, window: Column) -> Column:
    """1, 2 or 3 by method and full window length in days."""

    def grade(good: int, fair: int) -> Column:
        return F.when(window <= good, 1).when(window <= fair, 2).otherwise(3)

    return (
        F.when(method == LOOKUP3, grade(14, 56))
        .when(method == LOOKUP1, grade(14, 28))
        .when(method == DIURNAL, grade(1, 5))
    )


def mds_fill(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    targets: Sequence[str],
    drivers: Sequence[str] = ("Rg", "VPD", "Tair"),
    tol: Sequence[float] = (50.0, 5.0, 2.5),
    step: int = 1800,
    fill_all: Sequence[str] = (),
    stages=STAGES,
) -> DataFrame:
    """Fill the targets of a complete grid; one row per (series, variable, step).

    ``value`` as observed, ``model`` where a stage offered donors, ``filled``
    the observed value or else the model, ``method`` 1 … 3, ``window`` its full
    length in days, ``n`` and ``sd`` of the donors, ``fqc`` 0 for observed and
    1 … 3 for filled. Variables in ``fill_all`` are modelled on observed rows
    too, for their uncertainty. All variables go through the stages together.
    """
    keys = list(keys)
    ids = [*keys, "variable"]
    per_day = tp.DAY_SECONDS // step
    near = 3600 // step
    renamed = [F.col(d).alias(f"_d{i}") for i, d in enumerate(drivers, 1)]
    pos = F.floor(tp.epoch_seconds(ts) / step)
    table = settle(
        df.select(*keys, pos.alias("_pos"), F.col(ts).alias("_ts"), *renamed, *targets)
        .unpivot([*keys, "_pos", "_ts", "_d1", "_d2", "_d3"], list(targets), "variable", "_y")
    )
    donors = table.filter(F.col("_y").isNotNull()).drop("_ts")
    todo = table.filter(F.col("_y").isNull() | F.col("variable").isin(*fill_all)).drop("_ts", "_y")
    found: DataFrame | None = None
    for method, days in stages:
        if method == DIURNAL:
            got, length = _diurnal_found(todo, donors, ids, days, per_day, near), F.col("_half") * 2 + 1
        else:
            pairs = _lookup_pairs(todo, donors, ids, days, per_day, tol, method == LOOKUP3)
            got, length = _first_enough(pairs, ids, days), F.col("_half") * 2
        got = got.withColumn("_method", F.lit(method)).withColumn("_window", length)
        state = settle(todo.join(got.drop("_half"), [*ids, "_pos"], "left"))
        taken = state.filter(F.col("_n").isNotNull()).select(
            *ids, "_pos", "_mean", "_sd", "_n", "_method", "_window"
        )
        found = taken if found is None else found.unionByName(taken)
        todo = state.filter(F.col("_n").isNull()).select(*todo.columns)
        if todo.isEmpty():
            break
    out = table.drop("_d1", "_d2", "_d3").join(found, [*ids, "_pos"], "left")
    y = F.col("_y")
    return out.select(
        *keys,
        "variable",
        F.col("_ts").alias(ts),
        y.alias("value"),
        F.coalesce(y, F.col("_mean")).alias("filled"),
        F.col("_mean").alias("model"),
        F.col("_method").alias("method"),
        F.col("_window").alias("window"),
        F.col("_n").alias("n"),
        F.col("_sd").alias("sd"),
        F.when(y.isNotNull(), 0).otherwise(quality(F.col("_method"), F.col("_window"))).alias("fqc"),
    )
