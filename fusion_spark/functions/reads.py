"""Alignment flag tests and CIGAR lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fusion_spark.schemas import SOFT_CLIP_LENGTH

# SAM flag bits.
PROPER_PAIR = 0x2
UNMAPPED = 0x4
REVERSE = 0x10
READ1 = 0x40
READ2 = 0x80
SECONDARY = 0x100
SUPPLEMENTARY = 0x800
LAST_PRIMARY_FLAG = 255


def has_bit(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def is_primary_alignment(flag: Column) -> Column:
    return flag <= LAST_PRIMARY_FLAG


def is_clipped(qalen: Column, qlen: Column) -> Column:
    return qalen + SOFT_CLIP_LENGTH <= qlen


def mate_group(flag: Column) -> Column:
    """``read1`` / ``read2`` when exactly that bit is set, else ``other``."""
    first, second = has_bit(flag, READ1), has_bit(flag, READ2)
    return F.when(first & ~second, "read1").when(second & ~first, "read2").otherwise("other")


def cigar_length(cigar: Column, operations: str) -> Column:
    """Summed length of the given CIGAR operations."""
    lengths = F.regexp_extract_all(cigar, F.lit(f"(\\d+)[{operations}]"), F.lit(1))
    return F.aggregate(
        lengths, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint")
    )


# Operations that consume the reference, the aligned query, the whole query.
ON_REFERENCE = "MDN=X"
ON_ALIGNED_QUERY = "MI=X"
ON_QUERY = "MIS=X"
