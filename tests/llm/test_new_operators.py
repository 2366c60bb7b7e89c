"""Whitening, token files and the manifest against brute-force versions, on supplied rows and on awkward ones."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fluxloom.llm import manifest, tokenfile, tokens, whitening

PATH = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    (1, None, "en", "a", 3), (2, "", None, "a", None), (3, "   \n\t", None, None, 0), (4, "word", "de", "b", 4), (5, "word", "de", "b", 4),
    (5, "word", "de", "b", 4), (5, "other", "de", "b", 4), (None, "no id", "en", None, 5), (None, "no id", "en", None, 5), (6, "x " * 30_000, "en", "a", 60_000),
    (7, "é" * 100, "", "a", 100), (8, "a<|endoftext|>b ΑΣ Σ İ", "xé", "-", -1), (-9, "don't 'S ''ll 12½", "Z", "1:a", 9),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("pos", "tree", "n", "part", "leaf", "row", "path", "ids", "shard", "start", "crc", "level", "key", "root", "hash"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


def ids_of(text):
    return np.array(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, "<u4").tobytes() if text else b""


# --- token ids and files -----------------------------------------------------


def test_word_ids_are_the_librarys():
    rng = np.random.default_rng(1)
    every = [chr(c) for c in range(9, 0x180)] + list("'sstrevemlld ") * 20
    plain = [c for c in every if tokens.PLAIN.fullmatch(c)]
    texts = ["".join(rng.choice(a, 40)) for a in (every, plain) for _ in range(400)]
    texts += ["<|endoftext|> a", "x<|STARTOFTEXT|>y", "it's 12½ ²³ ªº µ", "a\x1cb\x85c", "", " "]
    found = tokens.Encoder(PATH)
    assert found.by_words
    tokenizer = Tokenizer.from_file(PATH)
    assert found.ids(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_words_are_cut_once_between_spaces(monkeypatch):
    """Cutting a text into words is asked for what stands between spaces, and not again for what was met."""
    cut, real = [], tokens.WORDS
    monkeypatch.setattr(tokens, "WORDS", type("Words", (), {"findall": staticmethod(lambda t: cut.append(t) or real.findall(t))}))
    found, text = tokens.Encoder(PATH), "It's done, it's\tdone, (really) it's"
    assert found.ids([text] * 9) == [ids_of(text)] * 9
    assert sorted(cut) == ["(really)"] * 2 + ["done,"] * 2 + ["it's"] * 2
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    assert tokens.Encoder(PATH).ids([text] * 3) == [ids_of(text)] * 3
    assert found.ids(["''s 's's a'b !'s '!'s"]) == [ids_of("''s 's's a'b !'s '!'s")]


def test_other_tokenizers_take_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    found, tokenizer = tokens.Encoder(path), Tokenizer.from_file(path)
    texts = ["Hello there, WORLD  é", ""]
    assert not found.by_words
    assert found.ids(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_numbers_of_all_lengths_round_trip(n):
    rng = np.random.default_rng(n)
    x = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
    control, data = tokenfile.pack(x)
    assert len(control) == -(-n // 4) and len(data) == sum(max(1, -(-int(v).bit_length() // 8)) for v in x)
    assert (tokenfile.unpack(control, data, n) == x).all()


@pytest.mark.parametrize("block", [tokenfile.BLOCK, 50])
@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_token_files(name, block, request, spark):
    df = request.getfixturevalue(name)
    folder = tokenfile.write(df, PATH, block=block)
    got = tokenfile.read(spark, folder).collect()
    rows = [(r.doc_id, ids_of(r.text) + np.array([1], "<u4").tobytes()) for r in df.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), zlib.crc32(r[1])))
    at, want = 0, collections.Counter()
    for i, ids in rows:
        want[i, at, len(ids) // 4, ids] += 1
        at += len(ids) // 4
    assert collections.Counter((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got) == want
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    assert sum(r.n for r in ranks) == at and all(a.n >= b.n for a, b in zip(ranks, ranks[1:], strict=False))
    held = spark.read.parquet(f"{folder}/blocks")
    assert held.where((F.col("n") > block) & (F.size("doc_ids") > 1)).isEmpty()


def test_token_files_of_copies_spread(spark):
    df = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same few words").alias("text"))
    folder = tokenfile.write(df, PATH, shards=8, block=100)
    sizes = [r.n for r in spark.read.parquet(f"{folder}/shards").collect()]
    assert len(sizes) == 8 and max(sizes) < sum(sizes) / 4
    assert sorted(r.start for r in tokenfile.read(spark, folder).collect()) == list(range(0, 20_000, 5))


# --- manifest ----------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle(rows):
    """Every row's manifest by definition."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf_of = lambda r: sha("".join(map(enc, r)))

    def levels(h):
        out = [h]
        while len(h) > 1:
            h = [sha("".join(h[i : i + 2])) for i in range(0, len(h), 2)]
            out.append(h)
        return out

    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for k in names:
        trees[k].sort(key=lambda x: x[:3])
    own = {k: levels([x[2] for x in trees[k]]) for k in names}
    top = levels([own[k][-1][0] for k in names])
    out = collections.Counter()
    for ki, k in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(trees[k]):
            path = []
            for lv, at in ((own[k], i), (top, ki)):
                for level in lv[:-1]:
                    path.append((level[at ^ 1] if at ^ 1 < len(level) else "", at & 1))
                    at >>= 1
            tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf_of((*r[:3], r[3] + 1, r[4])) if tampered else leaf
            for other, left in path:
                h = sha(other + h if left else h + other)
            out[r[0], leaf, own[k][-1][0], top[-1][0], sha("".join(o for o, _ in path)), h, h == top[-1][0]] += 1
    return out


def found(df):
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = manifest.manifest(df, changed={"n_chars": F.when(bad, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    folded = manifest.fold(F.col("changed_leaf"), F.col("path"))
    proof = F.sha2(manifest.siblings(F.col("path")).cast("binary"), 256)
    return collections.Counter(map(tuple, got.select("doc_id", "leaf", "subroot", "root", proof, folded, folded == F.col("root")).collect()))


@pytest.mark.parametrize("levels,asking", [(manifest.LEVELS, manifest.ASKING), (3, 0)])
@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_manifest(name, levels, asking, request, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "ASKING", asking)
    df = request.getfixturevalue(name)
    # Columns in the order of a leaf, but lang third as the tree's name.
    want = merkle([tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert found(df) == want


def test_manifest_of_one_row(awkward):
    one = awkward.where("doc_id = 4")
    (row,) = found(one)
    assert row[1] == row[2] == row[3] and row[4] == sha("")


def test_multiproof_asks_for_no_more_than_needed():
    """Every coordinate asked for is needed: none lies above a held leaf, none below another one asked for."""
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 100):
        held = np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False))
        hashes = [sha(str(i)) for i in range(n)]
        levels = [hashes]
        while len(levels[-1]) > 1:
            levels.append(manifest.above(levels[-1]))
        asked = [(level, p) for level, places in manifest.missing(held, n) for p in places.tolist()]
        assert len(asked) == len(set(asked))
        for level, p in asked:
            assert not any(i >> level == p for i in held.tolist())
            assert not any(other > level and p >> (other - level) == q for other, q in asked)
        fetched = {(level, p): levels[level][p] for level, p in asked}
        for i, path in zip(held.tolist(), manifest.paths(held, n, [hashes[i] for i in held], fetched), strict=True):
            h = hashes[i]
            for x in path:
                h = sha((x["hash"] or "") + h if x["left"] else h + (x["hash"] or ""))
            assert h == levels[-1][0]


def test_proofs_of_some_rows(spark, docs):
    """A few rows alone: their partitions fetch what they lack, and every path leads to its tree's top."""
    rows = docs.select("lang", "doc_id", manifest.leaf(F.col("text")).alias("leaf"))
    held = manifest.ordered(rows, "lang", ["doc_id", "leaf"], ["doc_id", "leaf"])
    nodes = manifest.build(held)
    some = manifest.prove(held.where("doc_id % 17 = 3"), nodes).join(manifest.tops(nodes), "tree")
    assert some.count() == docs.where("doc_id % 17 = 3").count()
    assert some.where(manifest.fold(F.col("leaf"), F.col("path")) != F.col("hash")).isEmpty()


# --- whitening ---------------------------------------------------------------


def whitened_directly(rows, k):
    """Rows taken part and, by length, everything by exact fractions."""
    kept, lists = [], collections.defaultdict(set)
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) and abs(256 * c) < 2.0**52 for c in v):
            x = tuple(math.floor(256 * c) for c in v)
            kept.append((i, x))
            lists[len(x)].add(x)
    fitted = {}
    for dim, xs in lists.items():
        n, sums = len(xs), [sum(c) for c in zip(*xs, strict=True)]
        c = [[n * a - b for a, b in zip(x, sums, strict=True)] for x in sorted(xs)]
        v = np.array([[float(Fraction(sum(r[i] * r[j] for r in c), n**3)) for j in range(dim)] for i in range(dim)])
        values, columns = np.linalg.eigh(v)
        order = np.argsort(-values)[:k]
        fitted[dim] = n, sums, values[order], columns[:, order].T, float(np.trace(v))
    return kept, fitted


ODD = [
    (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.5]), (3, [0.25, 9.0]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 0.0]),
    (8, []), (9, [5.0]), (None, [2.0, 2.0]), (10, [1.0] * 5), (11, [1.0] * 5), (12, [1.0, 2.0, 3.0]), (13, [1e13, -1e13, 4.0]), (14, [1e12, 2e11, -4.0]),
    (15, [3e12, -2e11, -4.0]), (16, [1e300, 0.0, 0.0]), (17, [-0.0, -0.001]),
]


@pytest.mark.parametrize("odd", [False, True])
def test_whitening(odd, spark, sf_dir):
    if odd:
        df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>").repartition(3)
        for name in ("x", "n", "component", "whitened"):
            df = df.withColumn(name, F.lit("clash"))
    else:
        df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    kept, fitted = whitened_directly([tuple(r) for r in df.select("vec_id", "embedding").collect()], 4)
    got = collections.Counter()
    for r in whitening.whiten(df).collect():
        got[r.vec_id, r.component, r.n, r.deviation, None if r.whitened is None else round(abs(r.whitened), 9), None if r.explained is None else round(r.explained, 9)] += 1
        assert r.identity_error < 1e-9
    want = collections.Counter()
    for i, x in kept:
        n, sums, values, rows, trace = fitted[len(x)]
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, sums, strict=True))
        for c, (e, u) in enumerate(zip(values, rows, strict=True), 1):
            real = e > 1e-12 * max(values)
            w = abs(sum(float(Fraction(n * a - b, n)) * t for a, b, t in zip(x, sums, u, strict=True))) / math.sqrt(e) if real else None
            share = (round(e / trace, 9) if real else 0.0) if trace else None
            want[i, c, n, deviation if deviation < 1 << 63 else None, None if w is None else round(w, 9), share] += 1
    assert got == want


def test_exact_sums_of_large_numbers():
    rng = np.random.default_rng(3)
    for bits in (3, 25, 26, 50, 61, 90):
        y = np.array([[int(a) * (1 << max(bits - 30, 0)) + int(b) for a, b in zip(r, r[::-1], strict=True)] for r in rng.integers(-(1 << min(bits, 30)), 1 << min(bits, 30), (50, 3))], object)
        y = y if bits > 60 else y.astype(np.int64)
        assert whitening.squares(y) == [sum(int(v) ** 2 for v in column) for column in y.T]
        held = collections.Counter()
        for _, at, part, n in whitening.sent(3, range(3), whitening.squares(y)):
            held[at] += n << whitening.PART * part
        assert [held[i] for i in range(3)] == whitening.squares(y)


def test_copies_of_a_vector_count_once(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(500, [3.0, 1.0]), (501, [0.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 2 * len(rows) and {r.n for r in got} == {3}


def test_empty_tables(empty, spark):
    assert found(empty) == {}
    assert tokenfile.read(spark, tokenfile.write(empty, PATH)).isEmpty()
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()
