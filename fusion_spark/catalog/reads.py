"""Queries over paired alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from fusion_spark.catalog.registry import query
from fusion_spark.catalog.views import view
from fusion_spark.operators import reads as R
from fusion_spark.operators.annotation import transcript_arrays
from fusion_spark.operators.intervals import merge_intervals, overlaps_regions

_FIRST = "min_by({c}, rid) FILTER (WHERE flag <= 255 AND (flag & {bit}) <> 0) AS {c}{m}"
_MATES = ", ".join(
    _FIRST.format(c=c, bit=bit, m=m)
    for m, bit in ((1, 64), (2, 128))
    for c in ("flag", "nh", "qlen", "qalen", "chrom", "pos0", "end0")
)
_PAIRS = f"""
pairs AS (SELECT sample, qname, count(*) AS members, count(*) FILTER (WHERE flag > 255) AS excluded,
                 {_MATES} FROM fx_aln GROUP BY sample, qname),
classed AS (SELECT *, CASE
  WHEN flag1 IS NULL OR flag2 IS NULL THEN 'missing_mate'
  WHEN members > 2 THEN 'star_chimeric'
  WHEN nh1 > 1 OR nh2 > 1 THEN 'multimapped'
  WHEN (flag1 & 4) <> 0 OR (flag2 & 4) <> 0 THEN 'unmapped'
  WHEN (flag1 & 2) = 0 OR (flag2 & 2) = 0 THEN 'not_proper'
  WHEN qalen1 + 10 <= qlen1 OR qalen2 + 10 <= qlen2 THEN 'soft_clip'
  ELSE 'normal' END AS class FROM pairs)
"""
_KEPT = "class NOT IN ('missing_mate', 'multimapped', 'normal')"
_LOCI = "loci AS (SELECT chrom, min(start) AS start, max(stop) AS stop FROM fx_exons GROUP BY chrom, gene)"


def _hit(chrom: str, start: str, end: str) -> str:
    return (
        f"EXISTS (SELECT 1 FROM loci r WHERE r.chrom = {chrom} AND ("
        f"({start} >= r.start AND {start} <= r.stop) OR ({end} >= r.start AND {end} <= r.stop)))"
    )


def _regions(spark, sf_dir):
    exons = view(spark, sf_dir, "fx_exons")
    loci = transcript_arrays(exons, ["start", "stop"], "exons", ["tx", "chrom"]).select(
        "chrom", F.element_at("exons", 1)["start"].alias("start"),
        F.element_at("exons", -1)["stop"].alias("stop"),
    )
    return merge_intervals(loci)


@query("assemble_pairs", "fx_aln", f"""
WITH {_PAIRS}
SELECT sample, qname, members, excluded, flag1, nh1, qlen1, qalen1, flag2, nh2, qlen2, qalen2
FROM pairs
""")
def assemble_pairs(spark, sf_dir):
    return R.assemble_pairs(view(spark, sf_dir, "fx_aln"))


@query("classify_pairs", "fx_aln", f"""
WITH {_PAIRS} SELECT sample, qname, class, {_KEPT} AS kept FROM classed
""")
def classify_pairs(spark, sf_dir):
    pairs = R.assemble_pairs(view(spark, sf_dir, "fx_aln"))
    return R.classify_pairs(pairs).select("sample", "qname", "class", "kept")


_COUNTS = f"""
counts AS (SELECT sample, CAST(sum(members) AS BIGINT) AS input_alignments,
  count(*) AS input_pairs,
  count(*) FILTER (WHERE {_KEPT}) AS filtered_pairs,
  CAST(sum(excluded) AS BIGINT) AS excluded_alignments,
  {", ".join(f"count(*) FILTER (WHERE class = '{c}') AS {c}" for c in R.PAIR_COUNTERS)}
FROM classed GROUP BY sample)
"""


@query("filter_counts", "fx_aln", f"WITH {_PAIRS}, {_COUNTS} SELECT * FROM counts")
def filter_counts(spark, sf_dir):
    return R.filter_counts(R.classify_pairs(R.assemble_pairs(view(spark, sf_dir, "fx_aln"))))


@query("read_qc", "fx_aln", f"""
WITH {_PAIRS}, {_COUNTS},
library AS (SELECT sample, count(DISTINCT qname) AS input_reads FROM fx_aln GROUP BY sample)
SELECT c.sample, star_chimeric = excluded_alignments
         AND input_alignments - excluded_alignments = 2 * input_pairs AS qc2,
       filtered_pairs / input_pairs AS filter_ratio, input_reads = input_pairs AS qc1
FROM counts c JOIN library l ON c.sample = l.sample
""")
def read_qc(spark, sf_dir):
    alignments = view(spark, sf_dir, "fx_aln")
    counts = R.filter_counts(R.classify_pairs(R.assemble_pairs(alignments)))
    library = alignments.groupBy("sample").agg(F.countDistinct("qname").alias("input_reads"))
    return R.read_qc(counts, library).select("sample", "qc1", "qc2", "filter_ratio")


@query("region_overlap", "fx_aln fx_exons", f"""
WITH {_LOCI}
SELECT rid, {_hit('a.chrom', 'a.pos0', 'a.end0')} AS overlaps FROM fx_aln a
""")
def region_overlap(spark, sf_dir):
    reads = view(spark, sf_dir, "fx_aln").select("rid", "chrom", "pos0", "end0")
    return overlaps_regions(reads, _regions(spark, sf_dir)).select(
        "rid", "overlaps"
    )


@query("select_pairs", "fx_aln fx_exons", f"""
WITH {_PAIRS}, {_LOCI},
marked AS (SELECT sample, qname, CASE WHEN class = 'normal' AND (
  {_hit('p.chrom1', 'p.pos01', 'p.end01')} OR {_hit('p.chrom2', 'p.pos02', 'p.end02')})
  THEN 'region_overlap' ELSE class END AS class FROM classed p)
SELECT sample, qname, class, {_KEPT} AS kept FROM marked
""")
def select_pairs(spark, sf_dir):
    return R.select_pairs(view(spark, sf_dir, "fx_aln"), _regions(spark, sf_dir)).select(
        "sample", "qname", "class", "kept"
    )


@query("selected_alignments", "fx_aln", f"""
WITH {_PAIRS}
SELECT a.rid, a.sample, a.qname, a.flag FROM fx_aln a
JOIN classed c ON a.sample = c.sample AND a.qname = c.qname
WHERE {_KEPT} AND a.flag <= 255
""")
def selected_alignments(spark, sf_dir):
    alignments = view(spark, sf_dir, "fx_aln")
    classified = R.classify_pairs(R.assemble_pairs(alignments))
    return R.selected_alignments(
        alignments.select("rid", "sample", "qname", "flag"), classified
    )


@query("split_mates", "fx_seq", """
SELECT CASE flag & 192 WHEN 64 THEN 'read1' WHEN 128 THEN 'read2' ELSE 'other' END AS mate,
       qname, CASE WHEN (flag & 16) <> 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq
              END AS seq
FROM (SELECT doc_id AS qname, seq, CAST(doc_id % 256 AS INT)
               + CASE WHEN length(seq) > 3000 THEN 2048 ELSE 0 END AS flag FROM fx_seq) t
WHERE (flag & 2304) = 0
""")
def split_mates(spark, sf_dir):
    reads = view(spark, sf_dir, "fx_seq").select(
        F.lit("S0").alias("sample"), F.col("doc_id").alias("qname"), "seq",
        F.col("seq").alias("qual"),
        ((F.col("doc_id") % 256).cast("int")
         + F.when(F.length("seq") > 3000, 2048).otherwise(0)).alias("flag"),
    )
    return R.split_mates(reads).select("mate", "qname", "seq")


@query("requantify", "fx_contexts fx_rq_aln", """
WITH r AS (SELECT * FROM fx_rq_aln WHERE flag <= 255 AND (flag & 4) = 0),
junctions AS (
  SELECT c.sample, c.name, count(*) AS junc, max(least(position - pos0, end0 - position)) AS anch
  FROM fx_contexts c JOIN r ON c.sample = r.sample AND c.name = r.name
  WHERE pos0 + 10 <= position AND end0 >= position + 10 GROUP BY c.sample, c.name),
spans AS (
  SELECT sample, name, count(*) AS span FROM (
    SELECT c.sample, c.name, qname FROM fx_contexts c JOIN r ON c.sample = r.sample AND c.name = r.name
    GROUP BY c.sample, c.name, qname, position
    HAVING bool_or(end0 <= position) AND bool_or(pos0 >= position)) p
  GROUP BY sample, name)
SELECT c.sample, c.name, c.position AS pos, coalesce(junc, 0) AS junc, coalesce(span, 0) AS span,
       coalesce(anch, 0) AS anch
FROM fx_contexts c LEFT JOIN junctions j ON c.sample = j.sample AND c.name = j.name
LEFT JOIN spans s ON c.sample = s.sample AND c.name = s.name
""")
def requantify(spark, sf_dir):
    return R.requantify(view(spark, sf_dir, "fx_rq_aln"), view(spark, sf_dir, "fx_contexts"))
