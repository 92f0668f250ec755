"""Breakpoint, fusion type, boundary and frame expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fusion_spark.schemas import CHROMS, CIS_NEAR_DISTANCE, NO_FRAME


def is_primary(chrom: Column) -> Column:
    return chrom.isin(*CHROMS)


def breakpoint_text(chrom: Column, pos: Column, strand: Column) -> Column:
    """``chrom:pos:strand``; NULL if a part is missing, never a shorter text."""
    return F.concat(chrom, F.lit(":"), pos.cast("string"), F.lit(":"), strand)


def breakpoint_id(bp1: Column, bp2: Column) -> Column:
    return F.concat(bp1, F.lit("_"), bp2)


def parse_breakpoint(text: Column) -> Column:
    parts = F.split(text, ":")
    return F.struct(
        parts[0].alias("chrom"),
        parts[1].cast("bigint").alias("pos"),
        parts[2].alias("strand"),
    )


def fusion_gene(gene1: Column, gene2: Column) -> Column:
    return F.upper(F.concat_ws("_", gene1, gene2))


def plain_transcript_id(tx: Column) -> Column:
    """Strips any of the letters of ``transcript:`` from both ends of an id."""
    return F.btrim(tx, F.lit("transcript:"))


def fusion_transcript_id(
    gene1: Column, bp1: Column, tx1: Column, gene2: Column, bp2: Column, tx2: Column
) -> Column:
    return F.concat_ws(
        "_", gene1, bp1, plain_transcript_id(tx1), gene2, bp2, plain_transcript_id(tx2)
    )


def boundary(pos: Column, start: Column, stop: Column) -> Column:
    """Where a position lies on a feature; NULL feature bounds give ``NA``."""
    return (
        F.when(start.isNull(), "NA")
        .when(pos == start, "left_boundary")
        .when(pos == stop, "right_boundary")
        .when((start < pos) & (pos < stop), "within")
        .otherwise("outside")
    )


def combined_boundary(
    strand1: Column, strand2: Column, boundary1: Column, boundary2: Column
) -> Column:
    """Exon edges facing each other on both sides, one side only, or none."""
    exit_edge = F.when(strand1 == "+", "right_boundary").when(strand1 == "-", "left_boundary")
    entry_edge = F.when(strand2 == "+", "left_boundary").when(strand2 == "-", "right_boundary")
    on1 = boundary1.isin("left_boundary", "right_boundary")
    on2 = boundary2.isin("left_boundary", "right_boundary")
    return (
        F.when((boundary1 == exit_edge) & (boundary2 == entry_edge), "both")
        .when(on1 & ~on2, "5prime")
        .when(~on1 & on2, "3prime")
        .otherwise("no_match")
    )


def fusion_type(
    chrom1: Column, pos1: Column, strand1: Column,
    chrom2: Column, pos2: Column, strand2: Column,
    near: int = CIS_NEAR_DISTANCE,
) -> Column:
    ahead = F.when(strand1 == "+", pos2 - pos1).otherwise(pos1 - pos2)
    same_locus = (
        F.when(ahead < 0, "cis_trans")
        .when((ahead > 0) & (ahead <= near), "cis_near")
        .otherwise("cis_far")
    )
    return (
        F.when((chrom1 == chrom2) & (strand1 == strand2), same_locus)
        .when(chrom1 == chrom2, "cis_inv")
        .when(strand1 == strand2, "trans")
        .otherwise("trans_inv")
    )


def frame_class(frame1: Column, frame2: Column) -> Column:
    return (
        F.when(frame1 == NO_FRAME, "no_frame")
        .when(frame2 == NO_FRAME, "neo_frame")
        .when(frame1 == frame2, "in_frame")
        .otherwise("out_frame")
    )


def frame_in_cds(pos: Column, strand: Column, start: Column, stop: Column, phase: Column) -> Column:
    """Codon phase at a position inside one coding segment.

    The phase drops by one per base walked from the segment's 5' end; the end itself
    keeps the segment's own phase.
    """
    walked = F.when(strand == "+", pos - start).otherwise(stop - pos)
    return F.when(walked == 0, phase).otherwise(F.pmod(phase - walked - 1, F.lit(3))).cast("int")


def loci_overlap(
    kind: Column, start1: Column, stop1: Column, start2: Column, stop2: Column
) -> Column:
    """Do both partner transcripts cover common ground (never for trans fusions)?"""
    return F.coalesce(
        ~kind.startswith("trans") & (stop1 >= start2) & (start1 <= stop2), F.lit(False)
    )
