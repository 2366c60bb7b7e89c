"""Registered queries of this package, each an operator over its whole table, and their SQL equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxloom.llm import chat, chunks, langid, manifest, mixing, packing, pii, quality, simhash, suffixes, tokenfile, topk, whitening
from fluxloom.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.find(F.col("text")).alias("s"))
    base = F.filter("s", lambda x: F.substring_index(x, ":", 1).isin("email", "ip", "card", "phone"))
    count = lambda kind: F.size(F.filter("s", lambda x: x.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in ("email", "ip", "card", "phone", "url", "account")],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("s", ",").alias("spans"),
    )


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), columns=["doc_id"])
    return found.select("doc_id", *quality.BASE, "base_failed", "kept", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).drop("asked")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, said)
    found = chat.chat(turns.union(own))
    found = found.withColumn("t", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    lines = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 4)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = manifest.manifest(table(spark, sf_dir, "documents"), changed={"n_chars": more})
    found = found.withColumn("folded_root", manifest.fold(F.col("changed_leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(manifest.siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    f.__name__: f
    for f in (op1_pii, op2_chunk_dedup, op3_simhash, op4_quality, op5_top_k, op6_packing, op7_language, op8_chat, op9_suffix_dedup, op10_mixing, op11_whitening, op12_token_files, op13_manifest)
}

def _leaf_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


SQL = {
    "op5_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
    "op8_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), o AS (
            SELECT *, row_number() OVER w AS n, lag(role) OVER w AS p, lead(role) OVER w AS q,
                length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g')) AS chars,
                length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) AS role_chars
            FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text))
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars + CASE WHEN p IS NOT DISTINCT FROM role THEN 5 ELSE 6 + role_chars END
                + CASE WHEN q IS NOT DISTINCT FROM role THEN 0 ELSE 5 END) AS BIGINT) AS formatted_chars
        FROM o GROUP BY conv_id
    """,
    "op9_suffix_dedup": """
        WITH d AS (
            SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
        ), n AS (
            SELECT doc_id, h, length(h) // 2 AS n_bytes FROM d
        ), s AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 49)) AS i FROM n)
        ), f AS (
            SELECT g, min(doc_id) AS first FROM s GROUP BY g
        ), r AS (
            SELECT s.doc_id, s.i FROM s JOIN f USING (g) WHERE f.first < s.doc_id
        ), b AS (
            SELECT doc_id, j, substr(h, 2 * j + 1, 2) AS byte FROM (SELECT doc_id, h, unnest(range(0, n_bytes)) AS j FROM n)
        ), c AS (
            SELECT b.doc_id, j, byte,
                coalesce(j - last_value(r.i IGNORE NULLS) OVER (PARTITION BY b.doc_id ORDER BY j ROWS UNBOUNDED PRECEDING) < 50, false) AS gone
            FROM b LEFT JOIN r ON r.doc_id = b.doc_id AND r.i = j
        ), e AS (
            SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS opens FROM c
        ), a AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
                string_agg(byte, '' ORDER BY j) FILTER (NOT gone) AS kept
            FROM e GROUP BY doc_id
        )
        SELECT n.doc_id, n.n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM n LEFT JOIN a USING (doc_id)
    """,
    "op10_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
                CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS cap,
                [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
            FROM d GROUP BY source
        ), o AS (
            SELECT *, row_number() OVER w AS rank,
                1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
                sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
            FROM s WINDOW w AS (ORDER BY cap / weight, encode(source) NULLS LAST)
        ), l AS (
            SELECT *, min(rank) FILTER (cap * rest > weight * room) OVER () AS first FROM o
        ), t AS (
            SELECT l.source, l.source_size,
                CASE WHEN l.first IS NULL OR l.rank < l.first THEN l.cap ELSE least(l.cap, l.weight * f.room / f.rest) END AS target
            FROM l LEFT JOIN l AS f ON f.rank = l.first
        ), x AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
                coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
            CAST(size * (whole + CASE WHEN size > 0 AND below + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM x
    """,
    "op13_manifest": """
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256(concat({fields}, {n_chars}, {text})) AS leaf,
                sha256(concat({fields}, {changed}, {text})) AS changed
            FROM (SELECT *, n_chars + CAST(xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
                    lambda x, i: xor(x >> 1, CASE WHEN (x & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))
            ), 4294967295::BIGINT) % 7 = 0 AS BIGINT) AS more FROM documents)
        ), l AS (
            SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id,
                row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
            FROM d
        ), nodes AS (
            SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM l
            UNION ALL
            SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(h || coalesce(beside, ''))
            FROM (SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY pos) AS beside FROM nodes WHERE n > 1) WHERE pos % 2 = 0
        ), s AS (
            SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), uppers AS (
            SELECT 0 AS lvl, pos, n, subroot AS h FROM s
            UNION ALL
            SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(h || coalesce(beside, ''))
            FROM (SELECT *, lead(h) OVER (ORDER BY pos) AS beside FROM uppers WHERE n > 1) WHERE pos % 2 = 0
        ), steps AS (
            SELECT l.id, k.lvl, CASE WHEN (l.pos >> k.lvl) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(o.h, '') AS step
            FROM l JOIN (SELECT DISTINCT tree, lvl FROM nodes WHERE n > 1) AS k USING (tree)
            LEFT JOIN nodes AS o ON o.tree = l.tree AND o.lvl = k.lvl AND o.pos = xor(l.pos >> k.lvl, 1)
            UNION ALL
            SELECT l.id, 1000 + k.lvl, CASE WHEN (s.pos >> k.lvl) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(o.h, '')
            FROM l JOIN s USING (tree) CROSS JOIN (SELECT DISTINCT lvl FROM uppers WHERE n > 1) AS k
            LEFT JOIN uppers AS o ON o.lvl = k.lvl AND o.pos = xor(s.pos >> k.lvl, 1)
        ), p AS (
            SELECT id, list(step ORDER BY lvl) AS path FROM steps GROUP BY id
        ), f AS (
            SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM uppers WHERE n = 1) AS root,
                sha256(coalesce(array_to_string(list_transform(p.path, lambda x: substr(x, 2)), ''), '')) AS proof_sha256,
                list_reduce(list_prepend(l.changed, coalesce(p.path, CAST([] AS VARCHAR[]))),
                    lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN substr(x, 2) || a ELSE a || substr(x, 2) END)) AS folded_root
            FROM l JOIN s USING (tree) LEFT JOIN p USING (id)
        )
        SELECT *, folded_root = root AS verified FROM f
    """.format(
        fields=", ".join(_leaf_field(c) for c in ("doc_id", "source", "lang")),
        n_chars=_leaf_field("n_chars"), text=_leaf_field("text"), changed=_leaf_field("coalesce(more, n_chars)"),
    ),
}
