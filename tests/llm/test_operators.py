"""Each operator against a brute-force version, on supplied rows and on awkward ones."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fluxloom.llm import chat, chunks, components, langid, mixing, near, packing, pii, quality, queries, simhash, suffixes, topk

SHARED = "the same long passage stands in several of these texts, word for word, and goes on for a good while yet " * 2
AWKWARD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t", None, None), (4, "word", "de", "b"), (5, "word", "de", "b"),
    (5, "word", "de", "b"), (None, "no id at all, but some words in it", "en", None), (6, "x " * 30_000, "en", "a"),
    (7, "start one " + SHARED + " end one", "en", "b"), (8, "another beginning " + SHARED + "!", "fr", "b"), (9, SHARED, "fr", None),
    (10, "aaaa" * 200, "es", "a"), (11, "aaaa" * 300, "es", "a"), (12, "mail a.b@c.de or x@y, ip 1.2.3.4.5 1.2.3.999 card 4111 1111-1111 1111 call +1 (415) 555-0100.", "en", "a"),
    (13, "é" * 100, "fr", "a"), (14, "a@b.c@d.e +12 +1234567890123456789 0.0.0.0 https://u.example/x). token = \"12ab34cd56\"", "en", "b"),
    (15, "1, 2 & 3 | 4\n1, 2 & 3 | 4\n\n \n", "en", "b"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    for name in ("score", "kept", "size", "key", "fp", "component_id", "_id", "n_words", "start", "part", "epochs"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs.repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def base_spans(text):
    """The base kinds by plain regular expressions."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(sum(divmod(2 * n, 10)) if i % 2 else n for i, n in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return [f"{k}:{s}:{e}" for k, s, e in out]


@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_pii_base_spans(name, request):
    found = request.getfixturevalue(name).select("text", pii.find(F.col("text")).alias("s")).collect()
    for r in found:
        assert [x for x in r.s if x.split(":")[0] in ("email", "ip", "card", "phone")] == base_spans(r.text or "")


def test_pii_added_kinds_and_redaction(spark):
    text = 'see https://u.example/x). token = "12ab34cd56", IBAN DE89 3704 0044 0532 0130 00 bye; tokens of words'
    df = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    rows = df.select(pii.find(F.col("text")).alias("s"), pii.redact(F.col("text")).alias("r")).collect()
    kinds = [text[int(a) : int(b)] for k, a, b in (x.split(":") for x in rows[0].s) if k in ("url", "account")]
    assert kinds == ["https://u.example/x", "12ab34cd56", "DE89 3704 0044 0532 0130 00"]
    assert "12ab34cd56" not in rows[0].r and "<URL>" in rows[0].r and rows[0].r.endswith("tokens of words")
    assert [list(x) for x in rows[1:]] == [[[], None], [[], ""]]


def test_pii_values_have_no_length_limit_and_cues_no_case(spark):
    long = "A1b2" * 125
    signed = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U="
    texts = [f"token {long} end", f"API key: {signed}, then", "Customer ID 99-12345678.", "İİ API_KEY=abcd1234 x", "IBAN " + "A1 " * 5000, "token " + "DE12 " * 5000, "API key none"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", pii.redact(F.col("text")).alias("r")).orderBy("i").collect()
    assert [r.r for r in rows[:4]] == ["token <ACCOUNT> end", "API key: <ACCOUNT>, then", "Customer ID <ACCOUNT>.", "İİ API_KEY=<ACCOUNT> x"]
    assert [r.r for r in rows[4:]] == texts[4:]


def simhash_of(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


@pytest.mark.parametrize("group", [20_000, 2])
@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_simhash_classes(name, group, request):
    df = request.getfixturevalue(name)
    got = simhash.classes(df, group=group).collect()
    rows = [(i, t if t is None or len(t) < 9999 else t) for i, t in texts(df)]
    prints = {t: simhash_of(t, 3) for _, t in rows}
    assert collections.Counter((r.doc_id, r.fp & (1 << 64) - 1) for r in got) == collections.Counter((i, prints[t]) for i, t in rows)
    codes = sorted(set(prints.values()))
    label = {c: c for c in codes}
    for a in codes:
        for b in codes:
            if a < b and bin(a ^ b).count("1") <= 3:
                old, new = label[b], label[a]
                label = {c: new if x == old else x for c, x in label.items()}
    first = {}
    for i, t in rows:
        if i is not None:
            first[label[prints[t]]] = min(i, first.get(label[prints[t]], i))
    for r in got:
        assert r.component_id == first.get(label[r.fp & (1 << 64) - 1])


def test_gray_index_random():
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([s ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for s in seeds]))
    groups = np.zeros(len(codes), np.int64)
    order = np.argsort(simhash.gray_rank(codes))
    codes = codes[order]
    got = simhash.linked(codes, groups, 3)
    label = np.arange(len(codes))
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 3):
            label[label == label[j]] = label[i]
    assert len(set(zip(got.tolist(), label.tolist(), strict=True))) == len(set(got.tolist())) == len(set(label.tolist()))


def test_components_on_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1060), 1000)}


def test_keep_one(awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({r.component_id for r in simhash.classes(awkward).collect() if r.component_id is not None})


def jaccard_classes(rows):
    """The smallest id of each row's class, every pair compared."""
    kept = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        kept.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))))
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            i = len(kept[a] & kept[b])
            if label[a] != label[b] and 9 * i >= 4 * (len(kept[a]) + len(kept[b])):
                label = [label[b] if x == label[a] else x for x in label]
    first = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            first[x] = min(i, first.get(x, i))
    return [(i, first.get(x)) for (i, _), x in zip(rows, label, strict=True)]


@pytest.mark.parametrize("name", ["docs", "awkward", "edited"])
def test_near_copies(name, request, spark, sf_dir):
    if name == "edited":
        rng = np.random.default_rng(3)
        rows = []
        for base in range(12):
            words = [f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(20, 300)))]
            for _ in range(12):
                own = list(words)
                for at in rng.integers(0, len(own), int(rng.integers(0, 1 + len(own) // 20))):
                    own[at] = f"other{rng.integers(0, 9)}"
                rows.append((len(rows), " ".join(own[int(rng.integers(0, 5)) :])))
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    else:
        df = request.getfixturevalue(name)
    want = jaccard_classes(texts(df))
    assert collections.Counter((r.doc_id, r.component_id) for r in near.classes(df).collect()) == collections.Counter(want)
    if name == "edited":
        kept = {c for _, c in want}
        assert len(kept) < len(want) and {r.doc_id for r in near.keep_one(df).collect()} == kept
        assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect()} == kept


def test_near_copies_with_far_fingerprints(spark):
    """Five of 46 shingles differ, and 23 bits of the fingerprints."""
    at = "524 1578 1912 1994 1341 2202 2381 2782 2567 1997 2529 677 2106 2656 2335 1195 185 1419 2048 503 1505 1393 2927 831 2170 2351 1162 1599 2028 1601 2723 1212 13 2738 1218 1963 683 1688 1570 439 2992 311 946 1815 752 2761 1143 245 233 1113"
    words = [f"w{x}" for x in at.split()]
    other = [*words[:20], "other0", *words[21:]]
    prints = [near.fingerprint(near.shingles(" ".join(x).encode(), 5)) for x in (words, other)]
    assert ((prints[0] ^ prints[1]) & (1 << 64) - 1).bit_count() > 22
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    assert {r.component_id for r in near.classes(df).collect()} == {1}


def test_near_group_is_not_compared_all_with_all(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base, rows = [f"w{x}" for x in rng.integers(0, 3000, 150)], []
    for i in range(300):
        own = list(base)
        for at in rng.choice(150, int(rng.integers(0, 8)), replace=False):
            own[at] = f"x{rng.integers(0, 1 << 30)}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    compared, real = [], near.confirmed
    monkeypatch.setattr(near, "confirmed", lambda docs, nodes, pairs, width: compared.append(pairs.count()) or real(docs, nodes, pairs, width))
    assert collections.Counter((r.doc_id, r.component_id) for r in near.classes(df).collect()) == collections.Counter(jaccard_classes(rows))
    assert sum(compared) < 5 * len(rows)


def test_near_copies_are_proposed_by_fingerprints(spark):
    rng = np.random.default_rng(6)
    prints = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 30)]
    prints += [p ^ (1 << int(b)) for p in prints for b in rng.integers(0, 63, 2)] + prints[:5]
    pairs = near.by_prints(spark.createDataFrame(list(enumerate(prints)), "node long, print long")).collect()
    label = list(range(len(prints)))
    for a, b in pairs:
        label = [label[a] if x == label[b] else x for x in label]
    assert len(pairs) < len(prints) * 4
    for a, p in enumerate(prints):
        for b, q in enumerate(prints):
            assert (label[a] == label[b]) == (((p ^ q) & (1 << 64) - 1).bit_count() <= 6)


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_quality(name, request, spark, sf_dir):
    df = request.getfixturevalue(name)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for r in quality.judge(df, labels).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert (r.score is None) == (r.n_words == 0) and not (r.kept and r.base_failed)


def test_quality_of_texts_left_out(spark):
    """Labels decide what is counted as trusted, not what passes."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()} - {r.doc_id for r in labels.where("quality = 0 or toxic = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    judged = quality.judge(df, labels.where("doc_id % 2 = 0 or quality = 0")).where("not base_failed").collect()
    rate = lambda ids: sum(r.kept for r in judged if r.doc_id in ids) / sum(r.doc_id in ids for r in judged)
    assert rate({i for i in good if i % 2}) > 0.95 and rate({i for i in good if i % 2 == 0}) > 0.95
    assert rate(bad) < 0.4


def test_quality_scores_leave_own_counts_out(awkward, docs, spark, sf_dir):
    df = docs.select("doc_id", "text").where("doc_id < 90").union(docs.select("doc_id", "text").where("doc_id < 20"))
    df = df.union(awkward.select(F.col("doc_id") + 1000, "text"))
    rows = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    trusted = {r.doc_id for r in rows if r.quality == 1 and r.toxic == 0} - {r.doc_id for r in rows if not (r.quality == 1 and r.toxic == 0)} | {1005, 1004}
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id long, quality int, toxic int")
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:], strict=False)]
        return [signed(x) % quality.BUCKETS for x in h + pairs]

    raw, good, copies = collections.Counter(), collections.Counter(), collections.Counter(texts(df))
    for i, t in texts(df):
        raw.update(g := grams(t))
        good.update(g if i in trusted else [])
    a, all_raw, all_good = quality.SMOOTHING, raw.total(), good.total()
    want = {}
    for i, t in copies:
        g = grams(t)
        own = collections.Counter(g * copies[i, t] if i in trusted else [])
        rest = all_good - own.total()
        want[i, t] = sum(math.log(((good[b] - own[b]) * all_raw / raw[b] + a) / (rest + a)) for b in g) / len(g) if g else None
    long = [want[i, t] for i, t in want if i in trusted and base_counts(t)[0] >= 20]
    least = min(quality.THRESHOLD, float(np.percentile(long, 100 * quality.STRICT)))
    found = quality.judge(df.repartition(3).withColumn("_id", F.lit("clash")), labels).collect()
    assert {r._id for r in found} == {"clash"}
    assert collections.Counter((r.doc_id, r.text) for r in found) == copies
    for r in found:
        score = want[r.doc_id, r.text]
        assert r.score == (None if score is None else pytest.approx(score, abs=1e-9))
        assert score is None or abs(score - least) < 1e-9 or r.kept == (not r.base_failed and score >= least)


def test_quality_counts_every_trusted_text(spark):
    """Whatever their number: each of 20,500 brings its own word in, and only trusted texts have it."""
    n = 20_500
    df = spark.range(n + 20).select(F.col("id").alias("doc_id"), F.concat(F.lit("good "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    raw, good = quality.counts(quality.marked(df, quality.trusted(labels)))
    assert raw.sum() == 3 * (n + 20) and good.sum() == 3 * n


def test_quantile_is_exact(spark):
    rng = np.random.default_rng(2)
    for values in (rng.normal(size=3000).round(2), np.full(50, 0.25), np.array([-1.0]), rng.normal(size=101) ** 9):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        for q in (0.01, 0.5):
            assert quality.quantile(df, q) == pytest.approx(np.percentile(values, 100 * q), abs=1e-12)
    assert quality.quantile(df.limit(0), 0.01) is None


def test_quality_plan_is_short_and_rows_carry_no_tables(docs, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.scored(quality.repeats(quality.marked(docs, quality.trusted(labels))), quality.SMOOTHING)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 50_000
    assert not any(f"AS _{name}#" in plan for name in ("table", "good", "weight"))


def test_quality_keeps_columns(awkward, spark, sf_dir):
    kept = quality.keep(awkward, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert kept.schema.names == awkward.schema.names and kept.where("score <> 'clash'").isEmpty()


@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_packing(name, request):
    df = request.getfixturevalue(name).withColumn("doc_id", F.coalesce("doc_id", F.lit(99)))
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(df, path).collect()
    tokenizer = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, t in texts(df):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[i, at // 2048, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    ends = collections.Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
    least = -(-sum(ends.values()) // 2048)
    assert len(ends) <= max(least + 2, 1.05 * least)


def test_packing_special_strings(spark):
    odd = ["a<|endoftext|>b <|startoftext|>", "x y z\x1c q\x85r", "Ä ̈x İ ǅ ΑΣ Σ", "don't 'S ''ll 12½", " ퟿\U0001f600 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for r in packing.pack(df, path).collect():
        assert r.ids_crc32 == zlib.crc32(np.array([*tokenizer.encode(odd[r.doc_id], add_special_tokens=False).ids, 0], "<u4").tobytes())


def test_language(docs, awkward):
    got = langid.identify(docs)
    wrong = got.join(docs.select("doc_id", F.col("lang").alias("l")), "doc_id").where("held_out and l is not null and lang_pred <> l").count()
    assert wrong <= 0.05 * got.where("held_out").count()
    assert got.where("score < 0 or score > 1 or held_out <> (pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0)").isEmpty()
    odd = langid.identify(awkward).collect()
    assert len(odd) == len(AWKWARD) and {r.lang_pred for r in odd if r.doc_id in (1, 2, 3)} == {"und"}


def test_language_sample_is_bounded(docs, spark):
    rows = [(7, "the one repeated text", "en"), (None, "a text without an id", "en")]
    many = spark.range(3000).select(F.element_at(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("doc_id", "text", "lang"))]) for r in rows]), (F.col("id") % 2 + 1).cast("int")).alias("r")).select("r.*")
    few = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id <> 7")
    model = langid.train(few.unionByName(many.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))).repartition(20), 5)
    langs = few.select("lang").distinct().count()
    assert set(model.sizes) == set(model.pairs) and model.sizes
    assert max(model.sizes.values()) <= 5 * langs


def test_language_fits_are_those_of_the_whole_sample(docs, monkeypatch):
    """Pairs fit in groups equal machines over dense counts of the texts with the smallest hashes."""
    monkeypatch.setattr(langid, "MOST_OF_A_FAMILY", 12)
    known = docs.where("lang is not null and text is not null and doc_id is not null").dropDuplicates(["doc_id"])
    model = langid.train(known, 10)
    rows = known.select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("k")).collect()
    best = {k: sorted((r for r in rows if r.lang == k), key=lambda r: (r.k, r.doc_id))[:10] for k in {r.lang for r in rows}}
    for (a, b), (weights, bias) in model.pairs.items():
        side = lambda name: [r for m in model.members[name] for r in best[m][: 12 // len(model.members[name])]] if name in model.families else best[name]  # noqa: E731,B023
        chosen = sorted([(r.doc_id, r.text, y) for name, y in ((a, 1.0), (b, -1.0)) for r in side(name) if any(c.isalpha() for c in r.text)])
        assert model.sizes[a, b] == len(chosen)
        want, off = langid.machine(langid.counts(pa.array([t for _, t, _ in chosen])), np.array([y for *_, y in chosen]))
        assert np.allclose(weights, want) and np.isclose(bias, off)


def test_language_votes(docs):
    """Margins and votes once more, text by text, over dense counts."""
    model = langid.train(docs.where("doc_id % 2 = 0"), 50)
    some = docs.where("text is not null and length(text) between 1 and 2000").orderBy("doc_id").limit(50)
    got = {r.doc_id: r.p for r in some.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()}
    for r in some.collect():
        x = langid.counts(pa.array([r.text]))[0].astype(np.float64)
        margin = {pair: float(x @ w) + bias for pair, (w, bias) in model.pairs.items()}

        def best(names):
            won = {k: sum((s * m > 0) + 1e-3 * np.clip(s * m, -10, 10) for (a, b), m in margin.items() if a in names and b in names for s in ((a == k) - (b == k),) if s) for k in names}
            return max(names, key=lambda k: won[k])

        want = best(model.members[best(model.families)])
        assert got[r.doc_id].lang == (want if any(c.isalpha() for c in r.text) else "und")


@pytest.mark.parametrize("odd", [True, False])
def test_chat_round_trip(odd, spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    if odd:
        rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "\\b\\l<sep>]\n[<s>"), (-1, 1, "assistant", None), (-1, 1, "assistant", None), (-2, None, None, "x"), (None, 1, "a]\n<", ""), (-3, 0, "assistant", "é\\")]
        turns = spark.createDataFrame(rows, turns.schema).withColumn("segments", F.lit(1))
    got = chat.chat(turns).withColumn("t", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments"))).collect()
    want = collections.defaultdict(list)
    for r in turns.collect():
        want[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    assert len(got) == len(want)
    for r in got:
        said = [x[2:] for x in sorted(want[r.conv_id])]
        assert [(t.role, t.text) for t in r.t] == said
        assert r.loss == "".join(t for role, t in said if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)


def test_top_k_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4) * (1e6 if i % 7 == 0 else 1)]) for i in range(120)]
    rows += [(100, [0.5, 0.5, 0.5, 0.5])] * 3 + [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, [1.0] * 4), (204, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    got = collections.defaultdict(list)
    for r in topk.top(df, F.col("vec_id") == 50).orderBy("rank").collect():
        got[r.query_id].append((-r.score, r.vec_id))
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v)]
    query = dict(fine)[50]
    assert got == {50: sorted((-sum(a * b for a, b in zip(query, v, strict=True)), i) for i, v in fine if i != 50)[:5]}
    assert topk.top(df.limit(0), F.col("vec_id") == 50).isEmpty()


@pytest.mark.parametrize("k", [1, 5])
def test_top_k_equal_vectors_and_ids(spark, k):
    """A third of all rows hold one vector; ids repeat with equal and with different vectors."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    hot = [2.0] * 6
    rows += [(1000 + i // 2, hot) for i in range(300)] + [(50, hot)] * 9 + [(50, [-1.0] * 6), (150, [3.0, 0.0, 0.0, 0.0, 0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = collections.defaultdict(list)
    for r in topk.top(df, F.col("vec_id") % 50 == 0, k).orderBy("rank").collect():
        got[r.query_id, r.asked].append((-r.score, r.vec_id))
    fine = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows]
    want = {}
    for q in sorted({i for i, _ in fine if i % 50 == 0}):
        for asked, v in enumerate(sorted({v for i, v in fine if i == q}), 1):
            want[q, asked] = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in fine if i != q)[:k]
    assert got == want


def test_top_k_reads_few_exact_vectors(spark, monkeypatch):
    """On clustered vectors the cells rule out nearly all; several blocks of either side give the same."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 32))
    rows = [(i, [float(x) for x in centres[i % 60] + 0.05 * rng.normal(size=32)]) for i in range(9000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "QUERIES", 4)
    asks = F.col("vec_id") % 900 == 7
    got, read = topk.search(df, asks, 5)
    blocks = read.select("qb").distinct().count()
    assert blocks > 1
    assert read.count() < 0.1 * len(rows) * blocks
    v = np.floor(256 * np.array([x for _, x in rows])).astype(np.int64)
    for q in range(7, 9000, 900):
        scores = v @ v[q]
        want = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted(got.where(F.col("query_id") == q).collect(), key=lambda r: r["rank"])] == want


@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_chunk_dedup(name, request):
    df = request.getfixturevalue(name).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in chunks.dedup(df).collect()}
    seen = set()
    for i, t in sorted(texts(df)):
        data = (t or "").encode()
        code, places = 0, []
        for n, b in enumerate(data):
            code = ((code << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
            if n + 1 >= chunks.SEEN and not code & int(chunks.CUT):
                places.append(n + 1)
        at, removed, number = 0, 0, 0
        for end in chunks.chunk_ends(places, 0, len(data)) or [0]:
            part, at, number = data[at:end], end, number + 1
            # A short rest counts with the chunk before it.
            own = (before, part) if number > 1 and len(part) < chunks.LEAST else part
            if part:
                removed += len(part) * (own in seen)
                seen.add(own)
            before = part
        assert (got[i].n_bytes, got[i].n_chunks, got[i].n_removed) == (len(data), number, removed)
        assert sum(int(b) - int(a) for a, b in (s.split(":") for s in got[i].spans.split(",") if s)) == removed


def test_chunks_short_texts_and_tails(spark):
    whole = " ".join(hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 6] for i in range(60))
    rows = [(i, "short text") for i in range(5)] + [(5, ""), (6, ""), (7, None)]
    rows += [(10 + 2 * n + k, whole[: 200 + n]) for n in range(60) for k in (0, 1)]
    found = {r.doc_id: r for r in chunks.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].n_removed for i in range(8)] == [0, 10, 10, 10, 10, 0, 0, 0]
    assert [found[i].spans for i in (0, 1, 5)] == ["", "0:10", ""]
    for i, t in rows[8:]:
        assert i % 2 == 0 or (found[i].n_removed, found[i].spans) == (len(t), f"0:{len(t)}")


def test_chunks_unlike_texts_with_the_same_end_lose_nothing(spark):
    word = lambda i, k: hashlib.md5(f"{i} {k}".encode()).hexdigest()[: 3 + (i + k) % 6]
    rows = [(i, " ".join(word(i, k) for k in range(40)) + end) for i, end in enumerate([".", ". The end."] * 100)]
    assert chunks.dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").isEmpty()


def test_chunks_find_a_moved_passage(spark):
    words = " ".join(hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 6] for i in range(120))
    df = spark.createDataFrame([(1, "begin here " + words), (2, "quite another opening, longer than that, " + words + " end")], "doc_id long, text string")
    found = {r.doc_id: r for r in chunks.dedup(df).collect()}
    assert found[1].n_removed == 0 and found[2].n_removed > 0.6 * len(words)
    spans = df.join(chunks.dedup(df).select("doc_id", "spans"), "doc_id")
    left = {r.doc_id: r.t for r in spans.select("doc_id", chunks.without(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert len(left[2]) == 41 + len(words) + 4 - found[2].n_removed


@pytest.mark.parametrize("crowd,block", [(1000, 1 << 19), (2, 1 << 9)])
def test_suffix_dedup(crowd, block, awkward, docs, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    monkeypatch.setattr(suffixes, "BLOCK", block)
    df = awkward.select("doc_id", "text").union(docs.select(F.col("doc_id") + 100, "text").where("doc_id < 90"))
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.dedup(df).collect())
    first = {}
    rows = [(i, (t or "").encode()) for i, t in texts(df)]
    for i, b in rows:
        if i is not None:
            for k in range(len(b) - 49):
                first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], i))
    want = collections.Counter()
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want[i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want


def test_mixing_awkward(awkward):
    got = mixing.mix(awkward).collect()
    sizes = collections.Counter()
    for r in got:
        assert r.taken == r.size * r.epochs and r.taken <= 2 * r.size
        sizes[r.source] += r.size
    for r in got:
        assert r.source_size == sizes[r.source] and r.target <= 2 * r.source_size
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(1.5 * sizes.total())
    taken = mixing.repeat(awkward)
    assert taken.columns == awkward.columns and taken.count() == sum(r.epochs for r in got)
    assert sorted(map(tuple, mixing.mix(awkward).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_mixing_of_repeated_rows(spark):
    """Copies, and rows that share a doc_id, are taken one by one: a source's words come within one row of its target."""
    copies = spark.range(40).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("w " * 10).alias("text"))
    other = spark.range(60).select("id", F.lit("b").alias("source"), F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"))
    df = copies.union(other.select(F.lit(None).cast("long"), "source", "text")).repartition(5)
    got = mixing.mix(df).collect()
    for source in ("a", "b"):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    assert mixing.repeat(df).count() == sum(r.epochs for r in got)
    assert collections.Counter((r.source, r.text) for r in mixing.repeat(df).collect()).total() == sum(r.epochs for r in got)


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("word_bpe_49k.json")
    for df in (simhash.classes(empty), simhash.keep_one(empty), quality.judge(empty, labels), packing.pack(empty, path), langid.identify(empty), chunks.dedup(empty), suffixes.dedup(empty), mixing.mix(empty), mixing.repeat(empty)):
        assert df.isEmpty()
    assert chat.chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).isEmpty()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    want = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir).cache()
        assert kept.columns == columns
        want[name] = (before, kept)
    before, after = want["quality_rules"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality.judge(before, labels).where("kept").collect()}
    before, after = want["near_dedup"]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in jaccard_classes(texts(before))})
    before, after = want["redact_pii"]
    assert after.count() == before.count() and after.where(F.size(F.filter(pii.find(F.col("text")), lambda s: s.startswith("email"))) > 0).isEmpty()
    before, after = want["mix_sources"]
    assert collections.Counter(r.doc_id for r in after.collect()) == +collections.Counter({r.doc_id: r.epochs for r in mixing.mix(before).collect()})
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert sum(r.piece == 0 for r in packed) == after.count()


def test_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14)) and set(queries.SQL) < set(queries.QUERIES)
