"""Language by hierarchical discrimination: family first, then the languages within it.

Both steps are one-versus-one linear support vector machines over hashed byte
n-grams of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluxloom.llm.common import byte_runs
from fluxloom.operators.attach import from_rows
from fluxloom.session import release, settle

#: Families of common languages; one that isn't listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}
#: Buckets of n-grams, lengths of n-grams in bytes.
BUCKETS, LENGTHS = 1 << 12, (1, 2, 3, 4)
#: Training texts of a language at most; those with the smallest hash of doc_id.
MOST_OF_A_LANGUAGE = 400
#: Training texts of a family at most, shared evenly by its languages, where families are told apart.
MOST_OF_A_FAMILY = 1_600
#: Groups in which the texts of a language are ranked before they are ranked together.
SALTS = 16

#: Bytes as features see them: ASCII letters in lower case, other bytes of letters as they are, all else one space.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[97:123] = _SEEN[65:91] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def buckets(data: np.ndarray) -> list[np.ndarray]:
    """For each n-gram length the bucket of the n-gram that ends at each byte; the first ``n - 1`` are not whole."""
    seen = _SEEN[data].astype(np.uint32)
    out = []
    for n in LENGTHS:
        code = seen.copy()
        for k in range(1, n):
            code[k:] += seen[:-k] * np.uint32(pow(2654435761, k, 1 << 32))
        code *= np.uint32(2246822519)
        code ^= code >> np.uint32(15)
        code *= np.uint32(3266489917 + 2 * n)
        out.append((code >> np.uint32(20)).astype(np.int32))
    return out


def inside(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First whole n-gram's place and end of each text."""
    return np.minimum(offsets[:-1] + n - 1, offsets[1:]), offsets[1:]


def counts(texts: pa.Array) -> np.ndarray:
    """Relative frequencies of buckets, a row per text."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for a, b, data, offsets in byte_runs(pc.utf8_lower(texts.cast(pa.large_string()))):
        for n, code in zip(LENGTHS, buckets(data), strict=True):
            for row, s, e in zip(range(a, b), *inside(offsets, n), strict=True):
                if e > s:
                    out[row] += np.bincount(code[s:e], minlength=BUCKETS) / np.float32(e - s)
    return out


@dataclass(frozen=True)
class Model:
    """Pairs of classes with their weights: first the families, then the languages of each."""

    families: Sequence[str]
    members: Mapping[str, Sequence[str]]
    pairs: Mapping[tuple[str, str], tuple[np.ndarray, float]]
    #: Texts each pair was fit on.
    sizes: Mapping[tuple[str, str], int] = field(default_factory=dict)

    @property
    def languages(self) -> list[str]:
        return [x for f in self.families for x in self.members[f]]


def machine(x: np.ndarray, y: np.ndarray, rounds: int = 300, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, each side weighing the same.

    Accelerated gradient steps from zero, so equal input gives equal weights.
    """
    scale = 1 / (x.std(0) + 1e-4)
    z = np.concatenate([x * scale, np.ones((len(x), 1), np.float32)], 1).astype(np.float64)
    z /= np.sqrt((z**2).sum(1).mean())
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w = ahead = np.zeros(z.shape[1])
    rate = 1 / (1 / cost + 2.0 * (z**2).sum(1).max())
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ ahead))
        new = ahead - rate * (ahead / cost - 2 * z.T @ (weight * y * slack))
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (old - 1) / t * (new - w), new
    norm = np.sqrt(((x * scale) ** 2).sum(1).mean() + 1)
    return (w[:-1] / norm * scale).astype(np.float32), float(w[-1] / norm)


def train(docs: DataFrame, most: int = MOST_OF_A_LANGUAGE, families: Mapping[str, str] = FAMILIES) -> Model:
    """Fit on at most ``most`` texts a language (columns ``doc_id, text, lang``; NULL lang, NULL text and texts without letters give nothing).

    The sample is chosen from narrow rows, cut per task before the shuffle and
    again per ``SALTS``-th of all tasks, so a language with most of the rows is
    no hot group. Rows that repeat id, label and text are one text of it; rows
    without an id take no place. Every pair of classes is fit in a group of
    its own, of at most twice ``MOST_OF_A_FAMILY`` texts with some kilobytes of
    features each; the driver gets the names of the languages and the weights
    of each pair.
    """
    labelled = docs.where("lang is not null and text is not null and doc_id is not null").withColumn("h", F.xxhash64("text"))
    first = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    salted = labelled.select("doc_id", "lang", "h").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    ahead = salted.withColumn("n", F.dense_rank().over(W.partitionBy("lang", "salt").orderBy(*first))).where(F.col("n") <= most)
    ranked = ahead.select("doc_id", "lang", "h").distinct().withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy(*first)))
    chosen = ranked.where(F.col("n") <= most)
    # At most ``most`` keys a language: bounded, so they may be broadcast.
    sample = labelled.join(F.broadcast(chosen), ["doc_id", "lang", "h"]).dropDuplicates(["doc_id", "lang", "h"])

    @F.arrow_udf("binary")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in counts(texts)], pa.binary())

    rows = settle(sample.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "h", "n", features(F.col("text")).alias("x")))
    known = sorted(r.lang for r in rows.select("lang").distinct().collect())
    family = {k: families.get(k, k) for k in known}
    members = {f: [k for k in known if family[k] == f] for f in sorted(set(family.values()))}
    # Which texts a pair is fit on: language, the pair, its side, and up to which rank.
    share = lambda f: max(1, MOST_OF_A_FAMILY // len(members[f]))
    sides = [(k, a, b, y, share(f)) for a, b in combinations(members, 2) for f, y in ((a, 1.0), (b, -1.0)) for k in members[f]]
    sides += [(k, a, b, y, most) for m in members.values() for a, b in combinations(m, 2) for k, y in ((a, 1.0), (b, -1.0))]
    pairs, sizes = {}, {}
    if sides:
        of = from_rows(docs.sparkSession, sides, "lang string, a string, b string, y double, upto long")
        met = rows.join(F.broadcast(of), "lang").where(F.col("n") <= F.col("upto")).drop("n", "upto")
        fits = met.groupBy("a", "b").applyInArrow(fit, "a string, b string, n long, weights binary, bias double").toArrow()
        for a, b, n, weights, bias in zip(*[c.to_pylist() for c in fits.columns], strict=True):
            pairs[a, b], sizes[a, b] = (np.frombuffer(weights, np.float32), bias), n
    release(rows)
    return Model(list(members), members, pairs, sizes)


def fit(table: pa.Table) -> pa.Table:
    """The machine of one pair; rows in a fixed order give the same weights again."""
    table = table.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("h", "ascending")])
    x = np.stack([np.frombuffer(b, np.float32) for b in table["x"].to_pylist()])
    weights, bias = machine(x, table["y"].to_numpy())
    return pa.table({**{name: table[name][:1].cast(pa.string()) for name in "ab"}, "n": [len(x)], "weights": pa.array([weights.tobytes()], pa.binary()), "bias": [bias]})


def decide(names: Sequence[str], margins: Mapping[tuple[str, str], np.ndarray], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The class with most pairs won, ties to the larger sum of margins; and how sure, from its smallest margin."""
    votes = np.zeros((rows, len(names)))
    least = np.full((rows, len(names)), 20.0)
    for (i, a), (j, b) in combinations(enumerate(names), 2):
        m = margins[a, b]
        for k, own in ((i, m), (j, -m)):
            votes[:, k] += (own > 0) + 1e-3 * np.clip(own, -10, 10)
            least[:, k] = np.minimum(least[:, k], own)
    best = votes.argmax(1) if names else np.zeros(rows, int)
    return best, 1 / (1 + np.exp(-2 * least[np.arange(rows), best]))


def predict(text: Column, model: Model) -> Column:
    """``struct<lang, score>`` of a whole text; score lies between 0 and 1.

    ``und`` with score 0 for NULL, texts without a letter, and where nothing
    was learned. Weights are summed over all n-grams of the text, whatever its
    length.
    """

    @F.arrow_udf("struct<lang:string,score:double>")
    def of(texts: pa.Array) -> pa.Array:
        lower = pc.utf8_lower(texts.cast(pa.large_string()))
        margins = {pair: np.full(len(texts), bias) for pair, (_, bias) in model.pairs.items()}
        for a, b, data, offsets in byte_runs(lower):
            for n, code in zip(LENGTHS, buckets(data), strict=True):
                first, end = inside(offsets, n)
                length = np.maximum(end - first, 1)
                for pair, (weights, _) in model.pairs.items():
                    sums = np.concatenate([[0.0], np.cumsum(weights[code], dtype=np.float64)])
                    margins[pair][a:b] += (sums[end] - sums[first]) / length
        rows = np.arange(len(texts))
        family, sure = decide(model.families, margins, len(texts))
        lang = np.full(len(texts), "und", dtype=object)
        score = np.zeros(len(texts))
        for f, name in enumerate(model.families):
            own = rows[family == f]
            inner, inner_sure = decide(model.members[name], {p: m[own] for p, m in margins.items() if p[0] in model.members[name]}, len(own))
            lang[own] = np.array(model.members[name], dtype=object)[inner]
            score[own] = sure[own] * inner_sure
        letters = pc.fill_null(pc.match_substring_regex(lower, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        lang[~letters], score[~letters] = "und", 0.0
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang", "score"])

    return of(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Learns only from rows that are not held out; predictions see the text
    alone. Rows with NULL doc_id are neither held out nor learned from;
    repeated rows get equal results. Other columns don't matter. An empty
    table gives an empty result, and without labels all texts are ``und``.
    """
    model = train(docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", "text").withColumn("p", predict(F.col("text"), model))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
