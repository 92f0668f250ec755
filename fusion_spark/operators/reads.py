"""Chimeric read pairs: assembly, classification, selection, quality checks, requantification."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.functions.reads import (
    PROPER_PAIR, READ1, READ2, REVERSE, SECONDARY, SUPPLEMENTARY, UNMAPPED, has_bit, is_clipped,
    is_primary_alignment, mate_group,
)
from fusion_spark.functions.sequence import reverse_complement
from fusion_spark.operators.intervals import touching_ids
from fusion_spark.schemas import ANCHOR_LENGTH

KEPT = ("star_chimeric", "unmapped", "not_proper", "soft_clip", "region_overlap")
PAIR_COUNTERS = (
    "star_chimeric", "multimapped", "unmapped", "not_proper", "soft_clip", "region_overlap",
)
_MATE_COLUMNS = ("flag", "nh", "qlen", "qalen")


def assemble_pairs(
    alignments: DataFrame, order: str = "rid", with_position: bool = False
) -> DataFrame:
    """One row per (sample, query name): member count and the first primary mates.

    ``<column>1`` / ``<column>2`` describe the mates and are NULL for a missing mate.
    Without positions the aggregate only buffers fixed-width values, so it hashes and
    combines before the shuffle.
    """
    columns = list(_MATE_COLUMNS) + (["chrom", "pos0", "end0"] if with_position else [])
    primary = is_primary_alignment(F.col("flag"))
    mates = {
        1: primary & has_bit(F.col("flag"), READ1),
        2: primary & ~has_bit(F.col("flag"), READ1) & has_bit(F.col("flag"), READ2),
    }
    firsts = [
        F.min_by(c, F.when(condition, F.col(order))).alias(f"{c}{mate}")
        for mate, condition in mates.items()
        for c in columns
    ]
    return alignments.groupBy("sample", "qname").agg(
        F.count("*").alias("members"),
        F.count_if(~primary).alias("excluded"),
        *firsts,
    )


def pair_class() -> Column:
    """Class of an assembled pair; the first test that applies decides."""

    def either(test: Callable[[str], Column]) -> Column:
        return test("1") | test("2")

    return (
        F.when(F.col("flag1").isNull() | F.col("flag2").isNull(), "missing_mate")
        .when(F.col("members") > 2, "star_chimeric")
        .when(either(lambda m: F.col(f"nh{m}") > 1), "multimapped")
        .when(either(lambda m: has_bit(F.col(f"flag{m}"), UNMAPPED)), "unmapped")
        .when(either(lambda m: ~has_bit(F.col(f"flag{m}"), PROPER_PAIR)), "not_proper")
        .when(either(lambda m: is_clipped(F.col(f"qalen{m}"), F.col(f"qlen{m}"))), "soft_clip")
        .otherwise("normal")
    )


def classify_pairs(pairs: DataFrame) -> DataFrame:
    """Adds ``class`` and ``kept`` to assembled pairs."""
    return pairs.withColumn("class", pair_class()).withColumn(
        "kept", F.col("class").isin(*KEPT)
    )


def select_pairs(alignments: DataFrame, regions: DataFrame, order: str = "rid") -> DataFrame:
    """Pair classes where otherwise unremarkable pairs are kept if a mate touches a region.

    Only the up to four read ends of such pairs take part in the region look-up, in one join;
    its hits, keyed as the pairs are, come back as a flag.
    """
    pairs = assemble_pairs(alignments, order, with_position=True).withColumn(
        "class", pair_class()
    )
    ends = [(f"chrom{mate}", f"{end}{mate}") for mate in "12" for end in ("pos0", "end0")]
    hits = touching_ids(
        pairs.filter(F.col("class") == "normal"), regions, ["sample", "qname"], ends
    ).withColumn("_hit", F.lit(True))
    return (
        pairs.join(hits, ["sample", "qname"], "left")
        .withColumn("class", F.when(F.col("_hit"), "region_overlap").otherwise(F.col("class")))
        .withColumn("kept", F.col("class").isin(*KEPT))
        .drop("_hit")
    )


def selected_alignments(alignments: DataFrame, classified: DataFrame) -> DataFrame:
    """Primary alignments of kept pairs."""
    kept = classified.filter("kept").select("sample", "qname")
    return alignments.filter(is_primary_alignment(F.col("flag"))).join(
        kept, ["sample", "qname"], "left_semi"
    )


def filter_counts(classified: DataFrame) -> DataFrame:
    """Counters of the pair filter, one row per sample."""
    return classified.groupBy("sample").agg(
        F.sum("members").alias("input_alignments"),
        F.count("*").alias("input_pairs"),
        F.count_if(F.col("kept")).alias("filtered_pairs"),
        F.sum("excluded").alias("excluded_alignments"),
        *[F.count_if(F.col("class") == c).alias(c) for c in PAIR_COUNTERS],
    )


def read_qc(counts: DataFrame, library: DataFrame | None = None) -> DataFrame:
    """Checks on the counters.

    ``qc1``: library size equals the pairs seen (needs ``library(sample, input_reads)``).
    ``qc2``: every excluded alignment belongs to a chimeric pair and the rest are pairs.
    """
    balanced = (F.col("star_chimeric") == F.col("excluded_alignments")) & (
        F.col("input_alignments") - F.col("excluded_alignments") == 2 * F.col("input_pairs")
    )
    checked = counts.withColumn("qc2", balanced).withColumn(
        "filter_ratio", F.col("filtered_pairs") / F.col("input_pairs")
    )
    if library is None:
        return checked
    return checked.join(library, "sample", "left").withColumn(
        "qc1", F.coalesce(F.col("input_reads") == F.col("input_pairs"), F.lit(False))
    )


def split_mates(alignments: DataFrame) -> DataFrame:
    """Primary reads by mate, turned back to sequencing orientation."""
    backwards = has_bit(F.col("flag"), REVERSE)
    return alignments.filter(
        ~has_bit(F.col("flag"), SECONDARY) & ~has_bit(F.col("flag"), SUPPLEMENTARY)
    ).select(
        "sample", "qname",
        mate_group(F.col("flag")).alias("mate"),
        F.when(backwards, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"),
        F.when(backwards, F.reverse(F.col("qual"))).otherwise(F.col("qual")).alias("qual"),
    )


def requantify(
    alignments: DataFrame, seq_table: DataFrame, anchor: int = ANCHOR_LENGTH,
    keys: tuple[str, ...] = ("sample", "name"),
) -> DataFrame:
    """Junction and spanning support of every sequence, zero rows included.

    ``alignments``: keys, qname, flag, pos0, end0 on the sequence ``name``;
    ``seq_table``: keys, position (bases left of the breakpoint).
    Reads are first reduced to counts of equal (start, end), pairs to counts of equal
    (inner end, inner start). A sequence is short, so even one that draws most of the reads
    leaves few rows for the join.
    """
    keys = list(keys)
    mapped = alignments.filter(
        is_primary_alignment(F.col("flag")) & ~has_bit(F.col("flag"), UNMAPPED)
    )
    reads = (
        mapped.groupBy(*keys, "pos0", "end0")
        .agg(F.count("*").alias("n"))
        .select(*keys, F.lit("read").alias("kind"), F.col("pos0").alias("lo"),
                F.col("end0").alias("hi"), "n")
    )
    pairs = (
        mapped.groupBy(*keys, "qname")
        .agg(F.min("end0").alias("lo"), F.max("pos0").alias("hi"))
        .groupBy(*keys, "lo", "hi")
        .agg(F.count("*").alias("n"))
        .select(*keys, F.lit("pair").alias("kind"), "lo", "hi", "n")
    )
    bp, lo, hi = F.col("position"), F.col("lo"), F.col("hi")
    margin = F.least(bp - lo, hi - bp)
    junction = (F.col("kind") == "read") & (margin >= anchor)
    spanning = (F.col("kind") == "pair") & (lo <= bp) & (hi >= bp)
    evidence = reads.unionByName(pairs)
    return (
        seq_table.select(*keys, "position")
        .join(evidence, keys, "left")
        .groupBy(*keys, F.col("position").alias("pos"))
        .agg(
            F.coalesce(F.sum(F.when(junction, F.col("n"))), F.lit(0)).alias("junc"),
            F.coalesce(F.sum(F.when(spanning, F.col("n"))), F.lit(0)).alias("span"),
            F.coalesce(F.max(F.when(junction, margin)), F.lit(0)).alias("anch"),
        )
    )
