"""Exact dedup: frequent digests removed map-side, the rest by an ordinary shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored

# Misra-Gries counters. Whatever the number of rows, a digest with more than about one row in
# COUNTERS is among the WINNERS, and no other digest can load a task with more than that.
COUNTERS = 4096
WINNERS = 1024


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, digest) per row: SHA-256 of the whole text, null counting as empty."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return docs.select(F.col(key).alias("doc_id"), digest.alias("digest"))


def heavy_digests(slim: DataFrame, counters: int = COUNTERS, winners: int = WINNERS) -> DataFrame:
    """Verified frequent digests: (digest, keep_id, group_size), at most ``winners`` rows.

    A Misra-Gries sketch names candidates by a 64-bit code; an exact count of the rows with
    such a code verifies them. Each task sends one row per candidate.
    """
    coded = slim.withColumn("code", F.xxhash64("digest"))
    candidates = coded.agg(
        F.expr(f"approx_top_k(code, {winners}, {counters})").alias("top")
    ).select(F.explode("top.item").alias("code"))
    return (
        coded.join(F.broadcast(candidates), "code", "left_semi")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") > 1)
        # one candidate code may cover two digests; the limit keeps the broadcast's bound and
        # a digest left out only takes the ordinary way
        .orderBy(F.desc("group_size"), "digest")
        .limit(winners)
    )


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    counters: int = COUNTERS, winners: int = WINNERS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the
    largest id stays; of rows that repeat that id as well, one stays. An empty table gives an
    empty result; other columns of ``docs`` are not read, whatever their names. A null id is
    below every other.

    Rows of a verified winner that do not stay are settled where they are read. All other
    rows meet by digest in one shuffle of (digest, id).
    """
    return settle(stored(digests(docs, key, text)), counters, winners).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def settle(slim: DataFrame, counters: int = COUNTERS, winners: int = WINNERS) -> DataFrame:
    """The decisions over stored rows of (doc_id, digest)."""
    heavy = stored(heavy_digests(slim, counters, winners))
    marked = slim.join(
        F.broadcast(heavy.withColumnRenamed("group_size", "heavy_size")), "digest", "left"
    )
    copy = F.col("keep_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keep_id"))
    removed = marked.filter(copy).select(
        "doc_id", "keep_id", F.col("heavy_size").alias("group_size"),
        F.lit(False).alias("kept"), "digest",
    )
    group = Window.partitionBy("digest")
    rest = marked.filter(~copy).select(
        "doc_id",
        F.max("doc_id").over(group).alias("keep_id"),
        F.coalesce("heavy_size", F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.desc("doc_id"))) == 1).alias("kept"),
        "digest",
    )
    return removed.unionByName(rest)


def keep_one_of_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, with all their columns."""
    decided = stored(exact_dedup(docs, key, text))
    kept = decided.filter("kept").select(
        F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_digest")
    )
    same = F.sha2(F.coalesce(docs[text], F.lit("")), 256) == kept["_digest"]
    staying = docs.join(kept, docs[key].eqNullSafe(kept["_keep"]) & same, "left_semi")
    repeats = decided.groupBy("doc_id", "text_sha256").count().filter("count > 1")
    return staying if repeats.isEmpty() else staying.dropDuplicates([key, text])
