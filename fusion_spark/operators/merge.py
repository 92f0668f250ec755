"""Sequence table, requantification pivot and the merged candidate table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.operators.calls import cpm, tool_counts, tool_cpm
from fusion_spark.operators.dedup import first_by, last_by
from fusion_spark.operators.skew import skew_join
from fusion_spark.schemas import SEQ_TYPES, merged_columns
from fusion_spark.session import cut_lineage


def seq_table(contexts: DataFrame, order: list[str]) -> DataFrame:
    """Three sequences per context id (``ft``, ``wt1``, ``wt2``), first row per id wins."""
    first = first_by(contexts, ["sample", "context_sequence_id"], order)
    return first.select(
        "sample", "context_sequence_id",
        F.expr(
            "stack(3, 'ft', context_sequence, context_sequence_bp,"
            " 'wt1', context_sequence_wt1, context_sequence_wt1_bp,"
            " 'wt2', context_sequence_wt2, context_sequence_wt2_bp)"
            " as (seq_type, sequence, position)"
        ),
    ).select(
        "sample",
        F.concat_ws(
            "_", "context_sequence_id", F.col("position").cast("string"), "seq_type"
        ).alias("name"),
        "sequence", "position",
    )


def requant_pivot(
    requant: DataFrame, order: list[str], library: DataFrame | None = None
) -> DataFrame:
    """One row per context id: bp, junc, span, anch and raw counts of each sequence type.

    The first row per (context, type) wins. Without a library junc and span stay counts.
    """
    parts = F.split(F.col("name"), "_")
    typed = requant.withColumn("context_sequence_id", parts[0]).withColumn("seq_type", parts[2])
    # one shuffle serves the first rows, the pivot and a join by context
    typed = typed.repartition("sample", "context_sequence_id")
    first = first_by(typed, ["sample", "context_sequence_id", "seq_type"], order)
    sources = {"bp": "pos", "anch": "anch", "junc_cnt": "junc", "span_cnt": "span", "anch_cnt": "anch"}
    counts = first.groupBy("sample", "context_sequence_id").agg(
        *[
            F.max(F.when(F.col("seq_type") == s, F.col(source))).alias(f"{s}_{name}")
            for s in SEQ_TYPES
            for name, source in sources.items()
        ]
    )
    if library is None:
        scaled = counts.withColumns(
            {name: count.cast("double") for name, count in _support_counts().items()})
    else:
        scaled = skew_join(
            counts, library, ["sample"], "left", ["context_sequence_id"]
        ).withColumns(_support_cpm())
    return scaled.select(
        "sample", "context_sequence_id",
        *[
            f"{s}_{name}" for s in SEQ_TYPES
            for name in ("bp", "junc", "span", "anch", "junc_cnt", "span_cnt", "anch_cnt")
        ],
    )


def _support_counts() -> dict[str, Column]:
    return {f"{s}_{c}": F.col(f"{s}_{c}_cnt") for s in SEQ_TYPES for c in ("junc", "span")}


def _support_cpm() -> dict[str, Column]:
    return {name: cpm(count, F.col("input_reads")) for name, count in _support_counts().items()}


def merge_candidates(
    annotated: DataFrame, calls: DataFrame, requant: DataFrame, library: DataFrame,
    tools: list[str], strict: bool = False, ftid_names_bpid: bool = False,
    cut: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """The candidate table: annotation, tool evidence and requantification side by side.

    ``annotated`` and ``requant`` carry ``sample`` and an arrival order ``_ord``; ``calls``
    sample, bpid, tool, junc, span, ``_ord``; ``library`` sample and input_reads. The last
    annotation row per FTID wins. A context without counts gives NULLs, or an error when
    ``strict``.

    ``ftid_names_bpid`` tells that rows of one FTID have one BPID, as the FTIDs of the annotation
    spell the breakpoints out. Rows that lie by sample and BPID (``repartition``) then stay
    there for the choice of the last ones and the join with the evidence. Rows carry counts;
    the few rows of ``library`` are stored, and their size decides how they are joined to the
    finished table.
    """
    ids = ["sample", "BPID", "FTID"] if ftid_names_bpid else ["sample", "FTID"]
    rows = last_by(annotated, ids, ["_ord"]).drop("_ord")
    evidence = tool_counts(calls, tools, "_ord").withColumnRenamed("bpid", "BPID")
    support = requant_pivot(requant, ["_ord"])
    spread = ["FTID"]
    merged = skew_join(rows, evidence, ["sample", "BPID"], "left", spread)
    merged = skew_join(merged, support, ["sample", "context_sequence_id"], "left", spread)
    merged = skew_join(merged, cut(library.select("sample", "input_reads")), ["sample"], "left", spread)
    merged = merged.withColumns(tool_cpm(tools) | _support_cpm())
    if strict:
        missing = F.greatest(*[F.col(f"{s}_bp").isNull().cast("int") for s in SEQ_TYPES]) == 1
        merged = merged.withColumn(
            "ft_bp",
            F.when(
                missing,
                F.raise_error(
                    F.concat(F.lit("no counts for context "), F.col("context_sequence_id"))
                ).cast("bigint"),
            ).otherwise(F.col("ft_bp")),
        )
    return merged.select("sample", *merged_columns(tools))
