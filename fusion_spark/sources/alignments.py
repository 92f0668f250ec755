"""SAM text as an alignment table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fusion_spark.functions.reads import (
    ON_ALIGNED_QUERY, ON_QUERY, ON_REFERENCE, cigar_length,
)
from fusion_spark.sources.text import read_lines, with_order


def read_sam(spark: SparkSession, path: str | list[str], sample: str | None = None) -> DataFrame:
    """Alignments of SAM files; the sample is given, or the file name up to its first dot."""
    return parse_sam(with_order(
        read_lines(spark, path).withColumn(
            "sample",
            F.lit(sample) if sample is not None
            else F.regexp_extract(F.input_file_name(), r"([^/.]+)\.[^/]*$", 1),
        )
    ))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments in file order, unmapped ones included, from ``value``, ``sample``, ``_ord``.

    Positions are 0-based with an exclusive end.
    """
    part = F.split(F.col("value"), "\t")
    tags = F.regexp_extract("value", r"\tNH:i:(\d+)", 1)
    fields = lines.filter(~F.regexp_like("value", F.lit(r"^@[A-Z][A-Z]\t"))).select(
        "sample", F.col("_ord").alias("rid"),
        part[0].alias("qname"), part[1].cast("int").alias("flag"),
        F.when(part[2] != "*", part[2]).alias("chrom"),
        (part[3].cast("bigint") - 1).alias("pos0"),
        part[5].alias("cigar"), part[9].alias("seq"), part[10].alias("qual"),
        F.when(tags != "", tags).cast("int").alias("nh"),
    )
    mapped = F.col("cigar") != "*"
    return fields.select(
        "sample", "rid", "qname", "flag", F.coalesce("nh", F.lit(1)).alias("nh"), "chrom", "pos0",
        F.when(mapped, F.col("pos0") + cigar_length(F.col("cigar"), ON_REFERENCE)).alias("end0"),
        F.when(mapped, cigar_length(F.col("cigar"), ON_QUERY))
        .otherwise(F.length("seq").cast("bigint")).alias("qlen"),
        F.when(mapped, cigar_length(F.col("cigar"), ON_ALIGNED_QUERY))
        .otherwise(F.lit(0).cast("bigint")).alias("qalen"),
        "seq", "qual",
    )
