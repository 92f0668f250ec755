"""Fusion calls of several tools: normalising parsers, union and per-tool evidence."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fusion_spark.functions.breakpoints import (
    breakpoint_id, breakpoint_text, fusion_gene, is_primary,
)
from fusion_spark.operators.dedup import last_by
from fusion_spark.operators.skew import skew_join
from fusion_spark.schemas import TOOL_CALL

# ---------------------------------------------------------------------------
# Field expressions of the caller formats
# ---------------------------------------------------------------------------


def preferred_strand(field: Column) -> Column:
    """``gene/fusion`` strand: the fusion strand unless it is ``.``."""
    parts = F.split(field, "/")
    return F.when(parts[1] != ".", parts[1]).otherwise(parts[0])


def strip_chr(text: Column) -> Column:
    """Strips any of the letters c, h, r from both ends."""
    return F.btrim(text, F.lit("chr"))


def partner_name(dashed: Column) -> Column:
    return F.replace(dashed, F.lit("--"), F.lit("_"))


def main_gene(gene: Column, transcripts: Column) -> Column:
    """Gene of a possibly ambiguous partner.

    A list of genes is resolved to the gene named by most entries of the transcript list
    (entry text before ``:`` without its last four characters; the first seen wins ties).
    """
    names = F.transform(
        F.transform(F.split(transcripts, ";"), lambda t: F.substring_index(t, ":", 1)),
        lambda t: F.substring(t, F.lit(1), F.greatest(F.length(t) - 4, F.lit(0))),
    )

    def most_frequent(listed: Column) -> Column:
        votes = F.transform(
            listed,
            lambda n, i: F.struct(
                F.size(F.filter(listed, lambda m: m == n)).alias("n"), (-i).alias("early"),
                n.alias("name"),
            ),
        )
        return F.array_max(votes)["name"]

    # a one-element transform binds the list, so it is split once per row
    mode = F.transform(F.array(names), most_frequent)[0]
    best = F.when(~F.contains(gene, F.lit(";")), gene).otherwise(mode)
    return F.replace(best, F.lit("_"), F.lit("-"))


def first_listed(names: Column) -> Column:
    return F.substring_index(names, ",", 1)


def _chrom(bp: Column) -> Column:
    return F.substring_index(bp, ":", 1)


def _normalised(
    df: DataFrame, gene: Column, bp1: Column, bp2: Column, junction: Column, spanning: Column,
    chroms: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Common call layout, restricted to primary chromosomes; ``sample`` and ``_ord`` are kept.

    ``chroms`` names both chromosomes where the raw row has them apart from the breakpoint
    text, which keeps the filter cheap.
    """
    kept = [c for c in ("sample", "_ord") if c in df.columns]
    chrom1, chrom2 = chroms or (_chrom(bp1), _chrom(bp2))
    return df.filter(is_primary(chrom1) & is_primary(chrom2)).select(
        *kept,
        breakpoint_id(bp1, bp2).alias("BPID"),
        gene.alias("Fusion_Gene"),
        bp1.alias("Breakpoint1"),
        bp2.alias("Breakpoint2"),
        junction.cast("bigint").alias("Junction_Reads"),
        spanning.cast("bigint").alias("Spanning_Reads"),
    )


# ---------------------------------------------------------------------------
# One parser per caller; inputs are the raw string tables of ``sources.callers``
# ---------------------------------------------------------------------------


def parse_arriba(raw: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    bp = [
        F.concat_ws(":", F.col(f"breakpoint{i}"), preferred_strand(F.col(f"strand{i}(gene/fusion)")))
        for i in (1, 2)
    ]
    return _normalised(
        raw.filter(F.col("confidence") == "high"),
        fusion_gene(F.col("#gene1"), F.col("gene2")), bp[0], bp[1],
        F.col("split_reads1").cast("bigint") + F.col("split_reads2").cast("bigint"),
        F.col("discordant_mates"),
        (_chrom(F.col("breakpoint1")), _chrom(F.col("breakpoint2"))),
    )


def reciprocal_names(summary: DataFrame) -> DataFrame:
    """Upper-cased pair names of the starred summary lines that mention ``reciprocal``."""
    line = F.col("value")
    kept = [c for c in ("sample",) if c in summary.columns]
    return summary.filter(
        F.regexp_like(line, F.lit(r"^\s*\*")) & line.contains("reciprocal")
    ).select(
        *kept,
        F.upper(partner_name(F.regexp_extract(line, r"\*\s(\S*)", 1))).alias("name"),
    ).distinct()


def swap_reciprocal(
    calls: DataFrame, gene1: str, gene2: str, reciprocal: DataFrame, keys: list[str],
    spread: list[str] | None = None,
) -> DataFrame:
    """Adds ``Fusion_Gene``: partner order reversed for names listed as reciprocal."""
    names = reciprocal.withColumn("_listed", F.lit(True))
    named = calls.withColumn("name", fusion_gene(F.col(gene1), F.col(gene2)))
    return (
        skew_join(named, names, [*keys, "name"], "left", spread)
        .withColumn(
            "Fusion_Gene",
            F.when(F.col("_listed"), fusion_gene(F.col(gene2), F.col(gene1))).otherwise(
                F.col("name")
            ),
        )
        .drop("name", "_listed")
    )


def parse_fusioncatcher(raw: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``raw``: the final list; ``extra``: lines of the summary (column ``value``)."""
    gene1, gene2 = (
        "Gene_1_symbol(5end_fusion_partner)", "Gene_2_symbol(3end_fusion_partner)",
    )
    keys = [c for c in ("sample",) if c in raw.columns and extra is not None and c in extra.columns]
    if extra is None:
        named = raw.withColumn("Fusion_Gene", fusion_gene(F.col(gene1), F.col(gene2)))
    else:
        named = swap_reciprocal(raw, gene1, gene2, reciprocal_names(extra), keys)
    return _normalised(
        named, F.col("Fusion_Gene"),
        F.col("Fusion_point_for_gene_1(5end_fusion_partner)"),
        F.col("Fusion_point_for_gene_2(3end_fusion_partner)"),
        F.col("Spanning_unique_reads"), F.col("Spanning_pairs"),
    )


def parse_starfusion(raw: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    return _normalised(
        raw, F.upper(partner_name(F.col("#FusionName"))),
        strip_chr(F.col("LeftBreakpoint")), strip_chr(F.col("RightBreakpoint")),
        F.col("JunctionReadCount"), F.col("SpanningFragCount"),
    )


def parse_infusion(raw: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    genes = [main_gene(F.col(f"gene_{i}"), F.col(f"transcript_{i}")) for i in (1, 2)]
    bp = [
        breakpoint_text(F.col(f"ref{i}"), F.col(f"break_pos{i}"), F.col(f"gene_{i}_strand"))
        for i in (1, 2)
    ]
    return _normalised(
        raw, fusion_gene(*genes), bp[0], bp[1], F.col("num_split"), F.col("num_paired"),
        (F.col("ref1"), F.col("ref2")),
    )


def parse_mapsplice(raw: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``raw``: headerless lines (column ``value``), fields taken by position."""

    def field(i: int) -> Column:
        return F.substring_index(F.substring_index("value", "\t", i + 1), "\t", -1)

    chroms = [F.substring_index(field(0), "~", side) for side in (1, -1)]
    bp = [
        breakpoint_text(chroms[i], field(i + 1), F.substring(field(5), i + 1, 1)) for i in (0, 1)
    ]
    return _normalised(
        raw, fusion_gene(first_listed(field(60)), first_listed(field(61))), bp[0], bp[1],
        field(4), field(27), (chroms[0], chroms[1]),
    )


def parse_soapfuse(raw: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    bp = [
        breakpoint_text(F.col(f"{p}_chr"), F.col(f"{p}_Genome_pos"), F.col(f"{p}_strand"))
        for p in ("up", "dw")
    ]
    return _normalised(
        raw, fusion_gene(F.col("up_gene"), F.col("dw_gene")), bp[0], bp[1],
        F.col("Junc_reads_num"), F.col("Span_reads_num"),
        (F.col("up_chr"), F.col("dw_chr")),
    )


PARSERS: dict[str, Callable[..., DataFrame]] = {
    "arriba": parse_arriba,
    "fusioncatcher": parse_fusioncatcher,
    "infusion": parse_infusion,
    "mapsplice": parse_mapsplice,
    "starfusion": parse_starfusion,
    "soapfuse": parse_soapfuse,
}


def parse_tool(
    spark: SparkSession, tool: str, raw: DataFrame, extra: DataFrame | None = None
) -> DataFrame:
    """Calls of one tool by name; an unknown name gives an empty table."""
    if tool not in PARSERS:
        return spark.createDataFrame([], TOOL_CALL)
    return PARSERS[tool](raw, extra)


# ---------------------------------------------------------------------------
# Union and evidence per tool
# ---------------------------------------------------------------------------


def union_tools(calls: dict[str, DataFrame], sample: str | None = None) -> DataFrame:
    """All tools in one table with ``Sample`` and ``Tool``.

    Where every table has its arrival order ``_ord``, the union has one: tool by tool as they
    are listed, rows of a tool as they arrived.
    """
    ordered = all("_ord" in df.columns for df in calls.values())

    def tagged(place: int, tool: str, df: DataFrame) -> DataFrame:
        owner = F.col("sample") if "sample" in df.columns else F.lit(sample)
        rows = df.withColumn("Sample", owner).withColumn("Tool", F.lit(tool))
        if not ordered:
            return rows.drop("_ord")
        return rows.withColumn("_ord", F.struct(F.lit(place).alias("place"), "_ord"))

    return reduce(
        lambda a, b: a.unionByName(b),
        (tagged(place, tool, df) for place, (tool, df) in enumerate(calls.items())),
    )


def cpm(count: Column, library: Column) -> Column:
    """Counts per million input reads; an empty library leaves the count."""
    count = count.cast("double")
    return F.when(library == 0, count).otherwise(count / library.cast("double") * 1000000.0)


def tool_counts(
    calls: DataFrame, tools: list[str], order: str, library: DataFrame | None = None
) -> DataFrame:
    """Per (sample, BPID): detected / junc / span of each tool and ``tool_frac``.

    ``calls``: sample, bpid, tool, junc, span and the arrival order. The last call of a tool
    counts. ``tool_frac`` divides the number of distinct tools seen, listed or not, by the
    number of listed tools. With ``library(sample, input_reads)`` counts become CPM.
    """
    # one shuffle serves the calls of a tool, the tools of a breakpoint and a join by breakpoint
    latest = calls.repartition("sample", "bpid").groupBy("sample", "bpid", "tool").agg(
        F.max_by("junc", order).alias("junc"), F.max_by("span", order).alias("span")
    )
    columns = []
    for tool in tools:
        mine, name = F.col("tool") == tool, tool.lower()
        columns += [
            F.max(F.when(mine, 1).otherwise(0)).alias(f"{name}_detected"),
            F.coalesce(F.max(F.when(mine, F.col("junc"))), F.lit(0)).alias(f"{name}_junc"),
            F.coalesce(F.max(F.when(mine, F.col("span"))), F.lit(0)).alias(f"{name}_span"),
        ]
    counts = latest.groupBy("sample", "bpid").agg(
        *columns, (F.count("*") / F.lit(len(tools))).alias("tool_frac")
    )
    if library is None:
        return counts
    library = library.select("sample", "input_reads")
    with_library = skew_join(counts, library, ["sample"], "left", ["bpid"])
    return with_library.withColumns(tool_cpm(tools)).drop("input_reads")


def tool_cpm(tools: list[str]) -> dict[str, Column]:
    """CPM in place of the counts of ``tool_counts``; 0 where the sample has no library."""
    names = [f"{tool.lower()}_{count}" for tool in tools for count in ("junc", "span")]
    return {
        name: F.when(
            F.col(name).isNotNull(), F.coalesce(cpm(F.col(name), F.col("input_reads")), F.lit(0.0))
        )
        for name in names
    }


def latest_calls(calls: DataFrame, order: list[str]) -> DataFrame:
    return last_by(calls, ["sample", "bpid", "tool"], order)


def leading_tool(calls: DataFrame) -> DataFrame:
    """Tool with most calls per (sample, BPID); the earliest call breaks ties."""
    counted = calls.groupBy("sample", "bpid", "tool").agg(
        F.count("*").alias("n"), F.min("ord").alias("first")
    )
    return counted.groupBy("sample", "bpid").agg(
        F.max_by("tool", F.struct(F.col("n"), -F.col("first"))).alias("tool"),
        F.max("n").alias("n"),
    )
