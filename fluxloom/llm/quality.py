"""Quality rules and a hashed n-gram log-likelihood ratio, in Spark expressions only."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxloom.llm.common import SPACES, words
from fluxloom.session import settle

#: Buckets of the multinomials; the table of ratios has so many rows.
BUCKETS = 1 << 16
#: Mean log ratio per n-gram below which a text is rejected, unless more than ``STRICT`` of the trusted texts lie there.
THRESHOLD = -0.1
STRICT = 0.01
#: N-grams spread as the raw ones are that the trusted counts begin with.
SMOOTHING = float(BUCKETS)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def hashed(docs: DataFrame) -> DataFrame:
    """Add ``_w`` (words), ``_h1`` and ``_h2`` (hashes of words and of pairs from each word on).

    Each step is a projection of its own: later ones use the arrays twice.
    """
    docs = docs.withColumn("_w", words(F.col("text")))
    docs = docs.withColumn("_h1", F.transform("_w", lambda w: F.xxhash64(w)))
    return docs.withColumn("_h2", F.zip_with("_h1", shifted("_h1", 1), lambda a, b: F.xxhash64(a, b)))


def shifted(name: str, by: int) -> Column:
    return F.slice(F.col(name), by + 1, F.greatest(F.size(name) - by, F.lit(0)))


def grams() -> Column:
    """Buckets of a text's words and word pairs."""
    bucket = lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    pairs = F.slice("_h2", 1, F.greatest(F.size("_h2") - 1, F.lit(0)))
    return F.concat(F.transform("_h1", bucket), F.transform(pairs, bucket))


def base_counts(docs: DataFrame) -> DataFrame:
    """Add the columns ``BASE`` to rows with ``text, _w, _h1, _h2``.

    Eight-word windows are compared by a 64-bit hash of their words. Only
    texts that have a window twice go on to sort theirs.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    docs = docs.withColumn("_lines", lines)
    docs = docs.withColumn("_h4", F.zip_with("_h2", shifted("_h2", 2), lambda a, b: F.xxhash64(a, b)))
    docs = docs.withColumn("_h8", F.zip_with("_h4", shifted("_h4", 4), lambda a, b: F.xxhash64(a, b)))
    docs = docs.withColumn("_h8", F.slice("_h8", 1, F.greatest(F.size("_h8") - 7, F.lit(0))))
    twice = F.size(F.array_distinct("_h8")) < F.size("_h8")
    placed = F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_s", F.when(twice, placed))
    pairs = F.zip_with("_s", shifted("_s", 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    docs = docs.withColumn("_p", F.sort_array(F.array_distinct(F.flatten(pairs))))
    steps = F.zip_with("_p", shifted("_p", 1), lambda a, b: F.least(F.lit(8), F.coalesce(b - a, F.lit(8))))
    covered = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.col("_s").isNull(), 0).otherwise(covered),
    }
    return docs.withColumns({k: c.cast("long") for k, c in counts.items()}).drop("_lines", "_h4", "_h8", "_s", "_p")


def marked(docs: DataFrame, bits: DataFrame) -> DataFrame:
    """``docs`` with ``_trusted``: 1 for ids in ``bits`` (``trusted``), else 0."""
    by = F.col("doc_id").cast("bigint")
    found = docs.join(bits, F.shiftright(by, 6) == F.col("_of"), "left")
    return found.withColumn("_trusted", F.coalesce(F.getbit("_bits", by.bitwiseAND(63).cast("int")), F.lit(0)).cast("int")).drop("_of", "_bits")


def trusted(labels: DataFrame) -> DataFrame:
    """The ids labelled of quality and not toxic, in every label they have: 64 to a row (``_of``), a bit each (``_bits``).

    Of ids near each other some two bits a document are left, which Spark
    broadcasts or, if they are too many, joins by a shuffle.
    """
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    by = F.col("doc_id").cast("bigint")
    ids = labels.where("doc_id is not null").groupBy(by.alias("_id")).agg(F.min(F.when(good, 1).otherwise(0)).alias("good")).where("good = 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_id").bitwiseAND(63).cast("int"))
    return settle(ids.groupBy(F.shiftright("_id", 6).alias("_of")).agg(F.bit_or(bit).alias("_bits")))


def counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many n-grams of all texts, and of the trusted ones, each of the ``BUCKETS`` has; added up per task before the shuffle."""
    found = hashed(docs.select("_trusted", "text")).select("_trusted", F.explode(grams()).alias("bucket"))
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, m in found.groupBy("bucket").agg(F.count("*"), F.sum("_trusted")).collect():
        raw[bucket], good[bucket] = n, m
    return raw, good


def constant(spark: SparkSession, values: np.ndarray) -> Column:
    """All values as one array, by a scalar subquery; unlike a literal they aren't written out wherever Spark describes the plan."""
    return spark.createDataFrame([(values.tolist(),)], "v array<double>").scalar()


def bound(value: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scored(docs: DataFrame, smoothing: float) -> DataFrame:
    """``docs`` (with ``text, _trusted, _n, _g``) with ``score`` and without ``_g``.

    The log of trusted over raw probability, as a mean over the n-grams. Raw
    counts come from every text, trusted ones from every trusted text. To
    these come ``smoothing`` n-grams spread as the raw ones are, so that
    little labelled text gives ratios near 0; without trusted texts all are 0.
    A trusted text's own counts, those of its ``_n`` repeated rows, are left out.
    """
    raw, good = counts(docs)
    total = good.sum()
    # (good + smoothing * raw / all_raw) / (total + smoothing) over raw / all_raw
    weight = np.divide(raw.sum(), raw, out=np.zeros(BUCKETS), where=raw > 0)
    table = np.where((raw > 0) & (total > 0), np.log((good * weight + smoothing) / (total + smoothing)), 0.0)
    docs = base_counts(hashed(docs)).withColumn("_g", grams())
    # Each column is used once, by a variable: so the optimizer puts the subqueries where they are used, and no row carries the arrays.
    docs = docs.withColumns({f"_{k}": constant(docs.sparkSession, v) for k, v in (("table", table), ("good", good), ("weight", weight))})
    plain = lambda g: bound("_table", lambda t: F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(t, b)) / F.size(g))
    run = lambda b, n, s: F.struct(b.alias("b"), n.alias("n"), s.alias("s"))

    def runs(o: Column, good: Column, weight: Column) -> Column:
        own = lambda r: r["n"] * F.log((F.get(good, r["b"]) - F.col("_n") * r["n"]) * F.get(weight, r["b"]) + F.lit(smoothing))
        step = lambda r, b: F.when(r["b"] == b, run(b, r["n"] + 1, r["s"])).otherwise(run(b, F.lit(1), r["s"] + own(r)))
        return F.aggregate(o, run(F.get(o, F.lit(0)), F.lit(0), F.lit(0.0)), step, lambda r: r["s"] + own(r))

    def left(o: Column) -> Column:
        rest = F.lit(float(total)) - F.col("_n") * F.size(o)
        return bound("_good", lambda g: bound("_weight", lambda w: runs(o, g, w))) / F.size(o) - F.log(rest + F.lit(smoothing))

    # Of a trusted text equal n-grams stand together, and each run ends in one logarithm.
    score = bound("_g", lambda g: F.when(F.size(g) > 0, F.when(F.col("_trusted") == 1, bound(F.sort_array(g), left)).otherwise(plain(g))))
    return docs.withColumn("score", score).drop("_w", "_h1", "_h2", "_g", "_table", "_good", "_weight")


def repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``_trusted``) with ``_n``, how many rows have the id and text of a trusted one, and ``_twin``, a hash of the text where they are several."""
    ids = docs.where("_trusted = 1").select("doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    ids = settle(ids)
    if ids.isEmpty():
        return docs.withColumns({"_n": F.lit(1).cast("long"), "_twin": F.lit(None).cast("long")})
    rows = docs.where("_trusted = 1").select("doc_id", F.xxhash64("text").alias("_twin")).join(ids, "doc_id", "left_semi")
    rows = settle(rows.groupBy(F.col("doc_id").alias("_own_id"), "_twin").agg(F.count("*").alias("_n")).where("_n > 1"))
    docs = docs.join(rows, (F.col("doc_id") == F.col("_own_id")) & (F.xxhash64("text") == F.col("_twin")), "left").drop("_own_id")
    return docs.withColumn("_n", F.coalesce("_n", F.lit(1).cast("long")))


def at_rank(values: DataFrame, rank: int) -> float:
    """The value of ``v`` at a place, from 0, in ascending order: of 1,024 equal stretches the one that holds it is looked into again."""
    low, high = values.agg(F.min("v"), F.max("v")).first()
    while low < high:
        part = F.floor((F.col("v") - F.lit(low)) / F.lit(high - low) * 1024)
        rows = values.where(F.col("v").between(low, high)).groupBy(part.alias("part")).agg(F.count("*"), F.min("v"), F.max("v")).collect()
        for _, n, low, high in sorted(rows):  # noqa: B007
            if rank < n:
                break
            rank -= n
    return low


def quantile(values: DataFrame, q: float) -> float | None:
    """The share ``q`` of all ``v``, exact and between two values as ``percentile`` has it; no task holds them all."""
    n = values.count()
    if not n:
        return None
    place = q * (n - 1)
    low = at_rank(values, math.floor(place))
    return low if place % 1 == 0 else low + (at_rank(values, math.ceil(place)) - low) * (place % 1)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with ``BASE``, ``base_failed``, ``score`` and ``kept`` beside their columns, or those named.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated
    eight-word windows. ``score``: the mean over a text's words and word pairs
    of the log ratio between the trusted and the raw multinomial (``scored``);
    every trusted text counts, and its own counts are left out of its score.
    ``kept``: the base rules hold and the score is at least ``threshold``, or
    the score that all but ``STRICT`` of the trusted texts of 20 words reach,
    if that is smaller; the same rule decides every row.

    The scored rows are written once, for the threshold comes from them.
    NULL and empty texts have no words, a NULL score and fail. Repeated rows
    are judged alike, and each counts towards the raw corpus. Columns named as
    the new ones are replaced. Empty tables give an empty result.
    """
    named = [*(docs.columns if columns is None else columns)]
    found = scored(repeats(marked(docs, trusted(labels))), SMOOTHING)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    new = [*BASE, "score", "base_failed"]
    found = settle(found.select("doc_id", *[c for c in named if c not in [*new, "doc_id"]], *new, "_trusted", "_twin"))
    good = found.where("_trusted = 1 and n_words >= 20 and score is not null")
    values = good.where("_twin is null").select(F.col("score").alias("v"))
    values = values.union(good.where("_twin is not null").dropDuplicates(["doc_id", "_twin"]).select("score"))
    least = quantile(values, STRICT)
    threshold = threshold if least is None else min(threshold, least)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    found = found.withColumn("kept", F.coalesce(kept, F.lit(False)))
    return found.select(*[c for c in named if c not in [*new, "kept"]], *new, "kept")


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, their columns as they were."""
    aside = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    kept = judge(docs.withColumnsRenamed(aside), labels, threshold).where("kept")
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
