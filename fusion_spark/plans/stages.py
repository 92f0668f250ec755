"""The analysis from caller results and alignments to scored candidates, many samples at once.

Each stage is a function of DataFrames. ``run`` chains them over a folder of stage tables:
a stage that was lost can be read back or recomputed from the tables before it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fusion_spark.operators import model
from fusion_spark.operators.calls import union_tools
from fusion_spark.operators.intervals import merge_intervals, parse_ranges
from fusion_spark.operators.merge import merge_candidates, seq_table
from fusion_spark.operators.reads import (
    assemble_pairs, classify_pairs, requantify, select_pairs, selected_alignments,
)
from fusion_spark.plans.annotate import annotate, distinct_fusions, filtered_annotation
from fusion_spark.schemas import CIS_NEAR_DISTANCE, CONTEXT_LENGTH, PREDICTION_THRESHOLD
from fusion_spark.session import cut_lineage
from fusion_spark.sources.text import with_order


@dataclass
class GeneModel:
    """Annotation tables shared by all samples."""

    exons: DataFrame
    cds: DataFrame
    transcripts: DataFrame
    tsl: DataFrame
    genome: DataFrame


def filter_reads(alignments: DataFrame) -> DataFrame:
    """Alignments of putative fusion pairs."""
    return selected_alignments(alignments, classify_pairs(assemble_pairs(alignments)))


def detect(calls_by_tool: dict[str, DataFrame], sample: str | None = None) -> DataFrame:
    """Normalised calls of all tools with their arrival order.

    Tables read with ``ordered`` bring the order of their files; others are numbered here.
    """
    union = union_tools(calls_by_tool, sample)
    return union if "_ord" in union.columns else with_order(union)


def regions_of_interest(annotated: DataFrame, by_sample: bool = False) -> DataFrame:
    """Merged ranges of the transcripts behind the annotated fusions, of all or each sample."""
    owner = ["sample"] if by_sample else []
    ranges = annotated.select(
        *owner, F.explode(F.array("wt1_start_stop", "wt2_start_stop")).alias("range")
    ).distinct()
    return merge_intervals(parse_ranges(ranges, "range"), [*owner, "chrom"])


def select_reads(alignments: DataFrame, annotated: DataFrame) -> DataFrame:
    """Alignments worth mapping to the context sequences of their own sample.

    A chromosome of a sample counts as a chromosome of its own.
    """
    own = F.concat_ws("\t", "sample", "chrom")
    regions = regions_of_interest(annotated, by_sample=True).withColumn("chrom", own)
    return selected_alignments(
        alignments, select_pairs(alignments.withColumn("chrom", own), regions)
    )


def contexts(annotated: DataFrame) -> DataFrame:
    """Context sequences to map reads to."""
    return seq_table(annotated, ["BPID", "FTID", "context_sequence_id"])


def merge(
    annotated: DataFrame, detected: DataFrame, requant: DataFrame, library: DataFrame,
    tools: list[str], strict: bool = False,
) -> DataFrame:
    rows = annotated if "_ord" in annotated.columns else annotated.withColumn(
        "_ord", F.struct("BPID", "FTID")
    )
    calls = detected.select(
        F.col("Sample").alias("sample"), F.col("BPID").alias("bpid"), F.col("Tool").alias("tool"),
        F.col("Junction_Reads").alias("junc"), F.col("Spanning_Reads").alias("span"), "_ord",
    )
    counts = requant if "_ord" in requant.columns else requant.withColumn("_ord", F.col("name"))
    rows = rows.repartition("sample", "BPID")
    return merge_candidates(rows, calls, counts, library, tools, strict, ftid_names_bpid=True)


def predict(
    merged: DataFrame, fitted: PipelineModel, features: list[str],
    threshold: float = PREDICTION_THRESHOLD,
) -> DataFrame:
    return model.score(merged, fitted, features, threshold)


@dataclass
class StageTables:
    """Stage tables of many samples under ``folder``, with a manifest of what is there.

    The manifest has a row per stage and sample, also for samples without rows. With
    ``resume`` a stage is made for the samples it lacks only, and replaces no other sample's
    partition; otherwise it is made for all samples of ``sheet``.
    """

    spark: SparkSession
    folder: str
    sheet: DataFrame
    resume: bool = False

    def manifest(self) -> DataFrame:
        schema = "stage string, sample string, layout string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/manifest")
        except AnalysisException:  # nothing was stored yet
            return self.spark.createDataFrame([], schema)

    def stored(
        self, stage: str, make: Callable[[DataFrame], DataFrame], by: str = "sample"
    ) -> DataFrame:
        """The table of ``stage``; ``make`` gets the samples to compute, one column."""
        known = self.manifest().filter(F.col("stage") == stage)
        todo = self.sheet.select("sample").distinct()
        if self.resume:
            todo = todo.join(known, "sample", "left_anti")
        todo = cut_lineage(todo)
        if todo.isEmpty():
            layout = T.StructType.fromJson(json.loads(known.first()["layout"]))
        else:
            rows = make(todo)
            layout = rows.schema
            (
                rows.hint("rebalance", by).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic" if self.resume else "static")
                .partitionBy(by).parquet(f"{self.folder}/{stage}")
            )
            todo.select(
                F.lit(stage).alias("stage"), "sample", F.lit(layout.json()).alias("layout")
            ).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        read = self.spark.read.schema(layout).parquet(f"{self.folder}/{stage}")
        mine = self.sheet.select(F.col("sample").alias(by)).distinct()
        return read.select(*layout.names).join(mine, by, "left_semi")


def _of(df: DataFrame, todo: DataFrame, by: str = "sample") -> DataFrame:
    return df.join(todo.select(F.col("sample").alias(by)), by, "left_semi")


def filtered_reads(tables: StageTables, alignments: DataFrame) -> DataFrame:
    """First part of an analysis: the reads that the callers get."""
    return tables.stored("filtered_reads", lambda todo: filter_reads(_of(alignments, todo)))


def run(
    spark: SparkSession, folder: str, calls_by_tool: dict[str, DataFrame], genes: GeneModel,
    context_alignments: DataFrame, library: DataFrame, tools: list[str],
    fitted: PipelineModel | None = None, features: list[str] | None = None,
    excluded_tsl: str = "4,5,NA", near: int = CIS_NEAR_DISTANCE,
    context_length: int = CONTEXT_LENGTH, alignments: DataFrame | None = None,
    sheet: DataFrame | None = None, resume: bool = False,
) -> DataFrame:
    """Calls to candidates; every stage is stored under ``folder`` and read back.

    ``context_alignments``: reads mapped to the context sequences (sample, name, qname,
    flag, pos0, end0), the result of the aligner outside this package. With ``alignments``
    to the genome the read filter and the selection of reads for that aligner are stages,
    too: ``filtered_reads`` and ``selected_reads``. ``sheet`` lists the samples, by default
    those with calls; with ``resume`` only samples that a stage lacks are computed.
    """
    if sheet is None:
        sheet = detect(calls_by_tool).select(F.col("Sample").alias("sample")).distinct()
    tables = StageTables(spark, folder, cut_lineage(sheet.select("sample").distinct()), resume)
    if alignments is not None:
        filtered_reads(tables, alignments)
    detected = tables.stored(
        "detected", lambda todo: _of(detect(calls_by_tool), todo, "Sample"), "Sample")
    annotated = tables.stored(
        "annotated",
        lambda todo: annotate(
            distinct_fusions(_of(detected, todo, "Sample")), genes.exons, genes.cds,
            genes.transcripts, genes.tsl, genes.genome, near, context_length,
        ),
    )
    kept = filtered_annotation(annotated, excluded_tsl)
    if alignments is not None:
        tables.stored(
            "selected_reads",
            lambda todo: select_reads(_of(alignments, todo), _of(annotated, todo)),
        )
    sequences = tables.stored("sequences", lambda todo: contexts(_of(kept, todo)))
    counts = tables.stored(
        "requantified",
        lambda todo: requantify(_of(context_alignments, todo), _of(sequences, todo)),
    )
    merged = tables.stored(
        "merged",
        lambda todo: merge(
            _of(kept, todo), _of(detected, todo, "Sample"), _of(counts, todo), library, tools),
    )
    if fitted is None:
        return merged
    return tables.stored(
        "scored", lambda todo: predict(_of(merged, todo), fitted, features or []))
