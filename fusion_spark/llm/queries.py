"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fusion_spark.llm import (
    bpe, divergence, exact_dedup, fingerprints, html_text, language, near_dedup, packing, pii,
    quality, runs, sharding, toxicity,
)
from fusion_spark.llm.labels import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
    )


@register
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


CHECKS["op6_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels, fold(3) != 1)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels, fold(5) != 0)
    return quality.score_quality(docs, model).select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = language.fit_languages(docs, path, fold(4) != 2)
    return language.identify(docs, model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score"
    )


@register
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", *(f"n_{kind}" for kind in pii.KINDS),
        F.sha2("base", 256).alias("base_sha256"), "spans",
    )


@register
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents")).drop("digest")


@register
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@register
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = html_text.extract(pages, html_text.fit_extractor(pages))
    return text.withColumn("n_chars", F.length("text").cast("long"))


@register
def op11_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


CHECKS["op11_interleaving"] = """
WITH base AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
), bits AS (
    -- what a byte leaves in the remainder
    SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM range(256) AS r(b)
), ahead AS (
    -- what each byte of a remainder becomes after 64 further bytes of 0
    SELECT t, list(list_reduce(list_prepend(b << s, range(64)), lambda c, k:
        xor(c >> 8, t[1 + (c & 255)])) ORDER BY s, b) AS f
    FROM bits, range(256) AS r(b), (VALUES (0), (8), (16), (24)) AS v(s) GROUP BY t
), hexes AS (
    -- four bytes that stand for the starting value, then the text, in pieces of 64 bytes
    SELECT row, lpad(h, ((length(h) + 127) // 128 * 128)::INT, '0') AS h FROM (
        SELECT row, '62F52692' || hex(encode(text)) AS h FROM base)
), pieces AS MATERIALIZED (
    SELECT row, k, substr(h, 128 * k + 1, 128) AS piece
    FROM hexes, unnest(range(length(h) // 128)) AS u(k)
), parts AS MATERIALIZED (
    SELECT row, list(r ORDER BY k) AS parts FROM (
        SELECT row, k, list_reduce(list_prepend(0::BIGINT, list_transform(range(64), lambda i:
            ('0x' || piece[2 * i + 1:2 * i + 2])::BIGINT)), lambda c, b:
            xor(c >> 8, t[1 + (xor(c, b) & 255)])) AS r
        FROM pieces, bits) GROUP BY row
), crcs AS (
    SELECT row, xor(list_reduce(list_prepend(0::BIGINT, parts), lambda c, r: xor(r, xor(
        xor(f[1 + (c & 255)], f[257 + ((c >> 8) & 255)]),
        xor(f[513 + ((c >> 16) & 255)], f[769 + (c >> 24)])))), 4294967295) AS text_crc32
    FROM parts, ahead
), d AS (
    SELECT *, md5('11:' || coalesce(doc_id::VARCHAR, '-')) AS code,
           ('0x' || md5('11:' || coalesce(source, '-'))[:8])::BIGINT / 4294967296.0::DOUBLE AS u
    FROM (SELECT row, doc_id, source, octet_length(encode(text)) + 1 AS size FROM base)
    JOIN crcs USING (row)
), points AS (
    SELECT *, row_number() OVER own - 1 AS r,
           (row_number() OVER own - 1 + u) / count(*) OVER (PARTITION BY source) AS point
    FROM d WINDOW own AS (PARTITION BY source ORDER BY code, doc_id NULLS FIRST, size, text_crc32)
), places AS (
    SELECT *, row_number() OVER (ORDER BY point, source NULLS FIRST, r) - 1 AS place,
           count(*) OVER () AS n FROM points
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law,
       (((place + 1) * 8 - 1) // n)::INTEGER AS shard,
       place - (((place + 1) * 8 - 1) // n) * n // 8 AS slot, NULL::INTEGER AS grown_shard
FROM places
"""


def periodic(docs: DataFrame) -> DataFrame:
    """The documents, every tenth with the words from a place on repeated periodically.

    With h the CRC-32 of the id, these are the ids with h % 10 = 0; of n words, those from
    a = (h div 10) % n on repeat the first 1 + (n - a) div (3 + (h div 10) % 8) of them. The
    words of such a text are joined by one space. A null id is left as it is.
    """
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    repeated = F.expr("""
        array_join(concat(slice(words, 1, a),
            slice(flatten(array_repeat(slice(words, a + 1, p), cast((n - a) div p + 1 as int))),
                  1, n - a)), ' ')
    """)
    return (
        docs.select("doc_id", "text", F.when(chosen, words).alias("words"))
        .withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
        .withColumn("g", F.floor(F.crc32(F.col("doc_id").cast("string")) / 10))
        .withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)"))
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
        .select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))
    )


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(periodic(table(spark, sf_dir, "documents")))
    longest = F.expr("""
        array_max(transform(runs, r -> named_struct(
            'length', r.length, 'start', -r.start, 'period', -r.period)))
    """)
    listed = F.expr("""
        array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')
    """)
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


CHECKS["op13_source_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS MATERIALIZED (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), terms AS MATERIALIZED (
    SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term
    HAVING count(DISTINCT doc) >= 3
), cells AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN terms USING (lang, term)
    GROUP BY lang, source, term
), langs AS (
    SELECT lang, sum(total) AS lang_total, count(*) AS v FROM terms GROUP BY lang
), grp AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(t.n, 0)::HUGEINT AS total, coalesce(v, 0)::HUGEINT AS v,
           lang_total::HUGEINT AS lang_total
    FROM (SELECT DISTINCT lang, source FROM d) AS g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cells GROUP BY lang, source) AS t
        USING (lang, source)
    LEFT JOIN langs USING (lang)
), shares AS MATERIALIZED (
    SELECT grp.lang, grp.source, term, coalesce(n, 0) AS n, terms.total AS all_n, grp.v,
           grp.lang_total,
           1 + 1000000000 * (coalesce(n, 0) + 1) // (grp.total + grp.v) AS p
    FROM grp JOIN terms USING (lang) LEFT JOIN cells USING (lang, source, term)
), pairs AS (
    SELECT g.lang, g.source, h.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM grp AS g JOIN grp AS h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares AS a JOIN shares AS b
            ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ) AS f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source
), above AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
    FROM (SELECT *, 1 + 1000000000 * (all_n::HUGEINT + 1) // (lang_total + v) AS q
          FROM shares WHERE n > 0)
    WHERE p > q
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', item, value FROM above
)
SELECT lang, source, part, item, value, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked
QUALIFY part = 'pair' OR rank <= 200
"""
