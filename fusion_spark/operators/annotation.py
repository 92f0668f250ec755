"""Gene-model tables and breakpoint annotation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.functions.breakpoints import boundary
from fusion_spark.operators.dedup import first_by
from fusion_spark.operators.intervals import interval_join
from fusion_spark.operators.skew import shuffled, skew_join
from fusion_spark.schemas import UNKNOWN_TSL
from fusion_spark.session import cut_lineage

EXON_FIELDS = ["start", "stop", "id", "seq"]
CDS_FIELDS = ["start", "stop", "id", "frame", "seq"]


def attribute(name: str, *fallbacks: str, default: str = "") -> Column:
    """First value of the first attribute present, else ``default``."""
    values = [F.try_element_at(F.col("attributes"), F.lit(n)) for n in (name, *fallbacks)]
    return F.coalesce(F.try_element_at(F.coalesce(*values), F.lit(1)), F.lit(default))


def ancestors(
    features: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """(id, ancestor, depth): every feature above a feature, by the shortest way up.

    ``features``: id and ``parents``, an array that may be null, hold several parents or name
    features that are not there. Each round takes the last round's ancestors one level up and
    keeps what was not known, so it ends after as many rounds as the hierarchy is deep, also
    where features lie in a circle (a feature is not its own ancestor).
    """
    edges = cut(
        features.select("id", F.explode("parents").alias("ancestor"))
        .filter("id <> ancestor").distinct()
    )
    up = edges.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next"))
    found = edges.withColumn("depth", F.lit(1))
    last, depth = edges, 1
    while True:
        depth += 1
        higher = skew_join(last, up, ["ancestor"], "inner", ["id"]).select(
            "id", F.col("next").alias("ancestor")).filter("id <> ancestor").distinct()
        last = cut(higher.join(found, ["id", "ancestor"], "left_anti"))
        if last.isEmpty():
            return found
        found = cut(found.unionByName(last.withColumn("depth", F.lit(depth))))


def _is_transcript() -> Column:
    return F.col("id").startswith("transcript") | F.col("type").isin("mRNA", "transcript")


def _with_parents(features: DataFrame) -> DataFrame:
    if "parents" in features.columns:
        return features
    return features.withColumn("parents", F.array_compact(F.array("parent")))


def feature_hierarchy(
    features: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """Transcripts with the properties of their gene, from GFF3 features.

    ``features``: id, type, attributes (map of value lists) and ``parents`` or ``parent``.
    The gene is an ancestor at any depth, the nearest one, of equally near ones the first in
    order of ids.
    """
    is_gene = F.col("id").startswith("gene") | (F.col("type") == "gene")
    genes = features.filter(is_gene).select(
        F.col("id").alias("gene"),
        attribute("Name", "gene_name", "gene_id").alias("gene_name"),
        attribute("biotype", "gene_biotype").alias("gene_biotype"),
        clean_description(attribute("description", default="NA")).alias("description"),
    )
    transcripts = features.filter(_is_transcript()).select(
        F.col("id").alias("transcript_id"),
        attribute("biotype", "transcript_biotype").alias("trans_biotype"),
    )
    above = ancestors(_with_parents(features), cut).withColumnsRenamed(
        {"id": "transcript_id", "ancestor": "gene"})
    nearest = (
        skew_join(above, genes.select("gene"), ["gene"], "left_semi", ["transcript_id"])
        .groupBy("transcript_id").agg(F.min_by("gene", F.struct("depth", "gene")).alias("gene"))
    )
    return (
        skew_join(transcripts.join(nearest, "transcript_id", "left"), genes, ["gene"], "left",
                  ["transcript_id"])
        .fillna("", ["gene_name", "gene_biotype", "description"])
        .drop("gene")
    )


def features_below_transcripts(
    features: DataFrame, kind: str, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """``exon`` or ``CDS`` features of every transcript above them, at any depth.

    Columns as the annotation operators use them; a feature of several transcripts is a row
    for each.
    """
    wanted = features.filter(F.col("type") == kind).select(
        "chrom", "start", "stop", "strand", "id", "frame", "_ord")
    transcripts = features.filter(_is_transcript()).select(F.col("id").alias("transcript_id"))
    above = ancestors(_with_parents(features), cut).select(
        "id", F.col("ancestor").alias("transcript_id"))
    mine = skew_join(above, transcripts, ["transcript_id"], "left_semi", ["id"])
    return skew_join(mine, wanted, ["id"], "inner", ["transcript_id"]).select(
        "chrom", "start", "stop", "strand", "id", "frame", "transcript_id", "_ord")


def clean_description(text: Column) -> Column:
    return F.translate(text, ";", " ")


def feature_lengths(features: DataFrame) -> DataFrame:
    return features.withColumn("length", F.col("stop") - F.col("start") + 1)


def feature_type_counts(features: DataFrame, column: str = "type") -> DataFrame:
    """Feature types present and how often."""
    return features.groupBy(column).agg(F.count("*").alias("n"))


def transcript_arrays(
    features: DataFrame, fields: list[str], name: str, keys: list[str] | None = None
) -> DataFrame:
    """Features of each transcript as an array ordered by start.

    One array per gene-model transcript: the list a transcript has in the annotation,
    independent of the amount of reads, calls and samples.
    """
    return features.groupBy(*(keys or ["transcript_id"])).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias(name)
    )


def with_tsl(
    transcripts: DataFrame, tsl: DataFrame, key: str = "transcript_id",
    normalize_ids: bool = False,
) -> DataFrame:
    """Support level per transcript, ``6`` when unlisted.

    Ids are compared as they are; ``normalize_ids`` drops a ``transcript:`` prefix first.
    """
    levels = first_by(tsl, ["transcript_id"], ["_ord"]) if "_ord" in tsl.columns else tsl
    levels = levels.select(F.col("transcript_id").alias("_tsl_id"), "tsl")
    bare = F.regexp_replace(key, "^transcript:", "") if normalize_ids else F.col(key)
    return (
        skew_join(transcripts.withColumn("_tsl_id", bare), shuffled(levels), ["_tsl_id"], "left")
        .drop("_tsl_id")
        .fillna(UNKNOWN_TSL, ["tsl"])
    )


def passes_tsl(bias: Column, tsl1: Column, tsl2: Column, excluded: str) -> Column:
    """Keep rule: no annotation bias and neither level listed in ``excluded`` (exact text)."""
    levels = excluded.split(",")
    return ~(bias | tsl1.isin(*levels) | tsl2.isin(*levels))


def breakpoint_hits(breakpoints: DataFrame, exons: DataFrame, cds: DataFrame) -> DataFrame:
    """Exons at each distinct breakpoint, with the first coding segment of the same transcript.

    ``breakpoints``: chrom, pos, strand; ``exons`` / ``cds``: chrom, start, stop,
    transcript_id, ``_ord`` and for cds ``frame``. Adds both boundaries.
    """
    points = breakpoints.select("chrom", "pos", "strand").distinct()
    at_exon = interval_join(
        points,
        exons.select(
            "chrom", "start", "stop", "transcript_id", F.col("_ord").alias("exon_ord")
        ),
    )
    at_cds = (
        interval_join(
            points.select("chrom", "pos").distinct(),
            cds.select("chrom", "start", "stop", "transcript_id", F.col("_ord")),
        )
        .groupBy("chrom", "pos", "transcript_id")
        .agg(
            F.min_by("start", "_ord").alias("cds_start"),
            F.min_by("stop", "_ord").alias("cds_stop"),
        )
    )
    return (
        at_exon.join(at_cds, ["chrom", "pos", "transcript_id"], "left")
        .withColumn("exon_boundary", boundary(F.col("pos"), F.col("start"), F.col("stop")))
        .withColumn(
            "cds_boundary", boundary(F.col("pos"), F.col("cds_start"), F.col("cds_stop"))
        )
        .select(
            "chrom", "pos", "strand", "transcript_id", "exon_ord",
            "exon_boundary", "cds_boundary",
        )
    )


def pair_sides(
    fusions: DataFrame, side: DataFrame, number: int, spread: list[str]
) -> DataFrame:
    """Joins the transcripts at breakpoint 1 or 2 to fusions; columns get the side's number.

    Applied for both sides it yields every transcript combination of a fusion, as the
    annotation table lists them.
    """
    keys = ["chrom", "pos", "strand"]
    renamed = side.withColumnsRenamed({c: f"{c}{number}" for c in side.columns})
    return skew_join(fusions, shuffled(renamed), [f"{k}{number}" for k in keys], "inner", spread)


def collect_flags(flagged: DataFrame, keys: list[str]) -> DataFrame:
    """Union of flag arrays per key; equal flags are folded before they are gathered."""
    return (
        flagged.select(*keys, F.explode("flags").alias("flag"))
        .distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("flag")).alias("flags"))
    )
