"""Table schemas and the fixed vocabularies the operators rely on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Chromosome names accepted as primary assembly.
# ---------------------------------------------------------------------------
CHROMS = (
    "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12", "13", "14",
    "15", "16", "17", "18", "19", "20", "21", "22", "X", "Y", "MT",
)

# ---------------------------------------------------------------------------
# Column names and order of the exchanged tables.
# ---------------------------------------------------------------------------
TOOL_COLUMNS = (
    "BPID", "Fusion_Gene", "Breakpoint1", "Breakpoint2",
    "Junction_Reads", "Spanning_Reads",
)

DETECTED_COLUMNS = TOOL_COLUMNS + ("Sample", "Tool")

ANNOTATION_COLUMNS = (
    "BPID", "Fusion_Gene", "Breakpoint1", "Breakpoint2", "FTID",
    "context_sequence_id", "context_sequence_100_id", "type", "exon_nr",
    "ft1_exon_nr", "ft2_exon_nr", "exon_starts", "exon_ends",
    "exon_boundary1", "exon_boundary2", "exon_boundary",
    "bp1_frame", "bp2_frame", "frame",
    "context_sequence", "context_sequence_bp",
    "neo_peptide_sequence", "neo_peptide_sequence_bp",
    "fusion_protein_sequence", "fusion_protein_sequence_bp",
    "context_sequence_wt1", "context_sequence_wt2",
    "context_sequence_wt1_bp", "context_sequence_wt2_bp",
    "context_sequence_100",
    "bp1_chr", "bp1_pos", "bp1_strand", "bp2_chr", "bp2_pos", "bp2_strand",
    "cds_boundary1", "cds_boundary2",
    "wt1_exon_pos", "wt2_exon_pos", "ft1_exon_pos", "ft2_exon_pos",
    "wt1_cds_pos", "wt2_cds_pos", "ft1_cds_pos", "ft2_cds_pos",
    "wt1_exon_seqs", "wt2_exon_seqs", "ft1_exon_seqs", "ft2_exon_seqs",
    "wt1_cds_seqs", "wt2_cds_seqs", "ft1_cds_seqs", "ft2_cds_seqs",
    "wt1_exon_transcripts", "wt2_exon_transcripts",
    "ft1_exon_transcripts", "ft2_exon_transcripts",
    "wt1_cds_transcripts", "wt2_cds_transcripts",
    "ft1_cds_transcripts", "ft2_cds_transcripts",
    "wt1_peptide", "wt2_peptide", "fusion_transcript", "fusion_peptide",
    "wt1_is_good_transcript", "wt2_is_good_transcript",
    "wt1_trans_biotype", "wt2_trans_biotype",
    "wt1_gene_biotype", "wt2_gene_biotype",
    "wt1_description", "wt2_description",
    "wt1_frame_at_start", "wt2_frame_at_start",
    "wt1_TSL", "wt2_TSL",
    "wt1_exon_no", "wt2_exon_no", "ft1_exon_no", "ft2_exon_no",
    "wt1_cds_no", "wt2_cds_no", "ft1_cds_no", "ft2_cds_no",
    "wt1_start_stop", "wt2_start_stop",
    "annotation_bias", "filter_comment",
)

ANNOTATION_SHORT_COLUMNS = ANNOTATION_COLUMNS[:25]

MERGE_ANNOTATION_COLUMNS = (
    "BPID", "context_sequence_id", "FTID", "Fusion_Gene", "Breakpoint1",
    "Breakpoint2", "context_sequence_100_id", "type", "exon_nr",
    "exon_starts", "exon_ends", "exon_boundary1", "exon_boundary2",
    "exon_boundary", "bp1_frame", "bp2_frame", "frame", "context_sequence",
    "context_sequence_bp", "neo_peptide_sequence", "neo_peptide_sequence_bp",
)

SEQ_TYPES = ("ft", "wt1", "wt2")

TSL_COLUMNS = ("transcript_id", "trans_biotype", "gene_biotype", "tsl")

# Factor levels of the scoring features, in model order.
TYPE_LEVELS = ("cis_near", "cis_inv", "cis_far", "cis_trans", "trans", "trans_inv")
BOUNDARY_LEVELS = ("no_match", "3prime", "5prime", "both")
FRAME_LEVELS = ("no_frame", "in_frame", "out_frame", "neo_frame")

# Defaults of the published workflow.
CIS_NEAR_DISTANCE = 1_000_000
CONTEXT_LENGTH = 400
SHORT_CONTEXT_LENGTH = 100
ANCHOR_LENGTH = 10
SOFT_CLIP_LENGTH = 10
PREDICTION_THRESHOLD = 0.5
UNKNOWN_TSL = "6"
NO_FRAME = -1


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SAMPLE_SHEET = _strings("sample", "fastq1", "fastq2")

TOOL_CALL = T.StructType(
    [T.StructField(n, T.StringType()) for n in TOOL_COLUMNS[:4]]
    + [T.StructField(n, T.LongType()) for n in TOOL_COLUMNS[4:]]
)

DETECTED = T.StructType(
    list(TOOL_CALL.fields)
    + [T.StructField("Sample", T.StringType()), T.StructField("Tool", T.StringType())]
)

TSL = _strings(*TSL_COLUMNS)

REQUANT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("junc", T.LongType()),
    T.StructField("span", T.LongType()),
    T.StructField("anch", T.LongType()),
    T.StructField("a", T.LongType()),
    T.StructField("b", T.LongType()),
])


def merged_columns(tools: list[str]) -> list[str]:
    """Column order of the merged candidate table for a given tool list."""
    cols = list(MERGE_ANNOTATION_COLUMNS)
    for tool in tools:
        cols += [f"{tool.lower()}_{m}" for m in ("detected", "junc", "span")]
    cols.append("tool_frac")
    cols += [f"{s}_{m}" for s in SEQ_TYPES for m in ("bp", "junc", "span", "anch")]
    cols += [f"{s}_{m}_cnt" for s in SEQ_TYPES for m in ("junc", "span", "anch")]
    return cols
