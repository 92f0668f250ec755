"""Readers of gene models, support levels and genome sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fusion_spark import schemas
from fusion_spark.operators.dedup import first_by, uniquify_ids
from fusion_spark.operators.sequences import CHUNK, cut_in_chunks
from fusion_spark.session import cut_lineage
from fusion_spark.sources.text import read_delimited, read_lines, with_order

# Accepted transcript id prefixes.
ID_PREFIXES = ("ENS", "MGP_")


def _fields(df: DataFrame) -> DataFrame:
    part = F.split(F.col("value"), "\t")
    return df.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(
        "_ord",
        part[0].alias("chrom"), part[2].alias("type"),
        part[3].cast("bigint").alias("start"), part[4].cast("bigint").alias("stop"),
        part[6].alias("strand"), part[7].alias("phase"), part[8].alias("attributes"),
    )


def gff_attributes(text: Column) -> Column:
    """``key=a,b;key2=c`` as a map of value lists."""
    pairs = F.filter(F.split(text, ";"), lambda p: F.contains(p, F.lit("=")))
    return F.map_from_entries(
        F.transform(
            pairs,
            lambda p: F.struct(
                F.trim(F.substring_index(p, "=", 1)),
                F.transform(
                    F.split(F.substring(p, F.locate("=", p) + 1, F.length(p)), ","),
                    lambda v: F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))),
                ),
            ),
        )
    )


def read_gff3(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_gff3(with_order(read_lines(spark, path)))


def parse_gff3(lines: DataFrame) -> DataFrame:
    """GFF3 features with unique ids: id, type, chrom, start, stop, strand, frame, parents.

    ``lines``: value and the bigint file order ``_ord``. A feature without an id is named
    after its type; later copies of an id get ``_1`` and so on in file order. ``parent`` is
    the first of the parents.
    """
    rows = _fields(lines).withColumn("attributes", gff_attributes(F.col("attributes")))
    named = rows.withColumn(
        "id",
        F.coalesce(
            F.try_element_at(F.col("attributes"), F.lit("ID"))[0],
            F.concat(F.col("type"), F.lit("_"), F.col("_ord").cast("string")),
        ),
    )
    return uniquify_ids(named, "id", "_ord").select(
        "id", "type", "chrom", "start", "stop", "strand",
        F.expr("try_cast(phase AS INT)").alias("frame"),
        F.try_element_at(F.col("attributes"), F.lit("Parent"))[0].alias("parent"),
        F.try_element_at(F.col("attributes"), F.lit("Parent")).alias("parents"),
        "attributes", "_ord",
    )


def features_of_type(features: DataFrame, kind: str) -> DataFrame:
    """``exon`` or ``CDS`` rows under the names the annotation operators use.

    A feature of several parents is a row for each of them.
    """
    parents = F.try_element_at(F.col("attributes"), F.lit("Parent"))
    return features.filter(F.col("type") == kind).select(
        "chrom", "start", "stop", "strand", "id", "frame",
        F.explode_outer(parents).alias("transcript_id"), "_ord",
    )


def gtf_value(attributes: Column, key: str) -> Column:
    """Quoted value of an attribute, ``NA`` without it."""
    value = F.regexp_extract(attributes, f'(?:^|;)\\s*{key} "([^"]*)"', 1)
    return F.when(value == "", "NA").otherwise(value)


def has_known_prefix(transcript_id: Column) -> Column:
    first, *rest = [transcript_id.startswith(p) for p in ID_PREFIXES]
    for condition in rest:
        first = first | condition
    return first


def tsl_from_attributes(
    rows: DataFrame, limit: int | None = None, check_prefix: bool = True
) -> DataFrame:
    """Support level per transcript from GTF ``transcript`` rows (attributes, ``_ord``).

    All four attributes are looked up in every row. An id without a known prefix is an
    error. ``limit`` keeps the first transcripts only; by default all are kept.
    """
    keys = ("transcript_id", "transcript_biotype", "gene_biotype", "transcript_support_level")
    values = rows.select(
        "_ord",
        *[
            gtf_value(F.col("attributes"), key).alias(name)
            for key, name in zip(keys, schemas.TSL_COLUMNS)
        ],
    )
    if check_prefix:
        values = values.withColumn(
            "transcript_id",
            F.when(has_known_prefix(F.col("transcript_id")), F.col("transcript_id")).otherwise(
                F.raise_error(
                    F.concat(F.lit("unexpected transcript id "), F.col("transcript_id"))
                )
            ),
        )
    if limit is not None:
        values = values.orderBy("_ord").limit(limit)
    return first_by(values, ["transcript_id"], ["_ord"]).drop("_ord")


def read_gtf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _fields(with_order(read_lines(spark, path)))


def read_gtf_tsl(
    spark: SparkSession, path: str | list[str], limit: int | None = None
) -> DataFrame:
    return tsl_from_attributes(
        read_gtf(spark, path).filter(F.col("type") == "transcript"), limit
    )


def read_tsl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Support level table, first row per transcript."""
    rows = with_order(read_delimited(spark, path, "\t", schemas.TSL))
    return first_by(rows, ["transcript_id"], ["_ord"]).drop("_ord")


# ---------------------------------------------------------------------------
# FASTA
# ---------------------------------------------------------------------------


def read_fasta(spark: SparkSession, path: str | list[str], size: int = CHUNK) -> DataFrame:
    """FASTA files as ``(chrom, chunk, seq)``.

    The files are read line by line in splits, never as one record per chromosome.
    """
    lines = with_order(read_lines(spark, path).withColumn("_file", F.input_file_name()))
    return parse_fasta(lines.withColumn("_split", F.shiftright("_ord", 33)), size)


def parse_fasta(
    lines: DataFrame, size: int = CHUNK, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """``(chrom, chunk, seq)`` from lines: value, ``_file``, ``_split`` and the order ``_ord``.

    Each line learns its record and offset from a running total inside its split plus what the
    earlier splits of the file end with; of those there is one row per split. The lines are
    read once: what a split knows about them is stored, and splits are summed up from there.
    """
    header = F.col("value").startswith(">")
    marked = lines.select(
        "_file", "_split", "_ord",
        F.when(header, F.regexp_extract("value", r"^>\s*(\S+)", 1)).alias("_name"),
        F.when(header, F.lit("")).otherwise(F.regexp_replace("value", r"\s", "")).alias("seq"),
    )
    so_far = Window.partitionBy("_file", "_split").orderBy("_ord").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    named = F.col("_name").isNotNull()
    local = cut(
        marked.withColumn("_head", F.last("_name", ignorenulls=True).over(so_far))
        .withColumn("_end", F.sum(F.length("seq")).over(so_far))
        .withColumn("_from", F.max(F.when(named, F.col("_end"))).over(so_far))
        .withColumn("_offset", F.col("_end") - F.length("seq") - F.coalesce("_from", F.lit(0)))
    )
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        local.groupBy("_file", "_split")
        .agg(
            F.max_by("_name", F.when(named, F.col("_ord"))).alias("_last"),
            F.max(F.when(named, F.col("_end"))).alias("_at_last"),
            F.max("_end").alias("_total"),
        )
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .withColumn("_abs", F.col("_before") + F.col("_at_last"))
        .select(
            "_file", "_split",
            F.last("_last", ignorenulls=True).over(earlier).alias("_open"),
            (F.col("_before") - F.coalesce(F.max("_abs").over(earlier), F.lit(0))).alias("_open_at"),
        )
    )
    placed = (
        local.filter(F.length("seq") > 0)
        .join(carried, ["_file", "_split"])
        .select(
            F.coalesce("_head", "_open").alias("chrom"),
            F.when(F.col("_head").isNull(), F.col("_offset") + F.col("_open_at"))
            .otherwise(F.col("_offset")).alias("offset"),
            "seq",
        )
    )
    pieces = placed.select(
        "chrom", "offset",
        F.posexplode(cut_in_chunks(F.col("seq"), size, F.col("offset"))).alias("_i", "seq"),
    ).withColumn("chunk", F.floor(F.col("offset") / size) + F.col("_i"))
    return pieces.groupBy("chrom", "chunk").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("offset", "_i", "seq"))), lambda p: p["seq"]
            ),
            "",
        ).alias("seq")
    )
