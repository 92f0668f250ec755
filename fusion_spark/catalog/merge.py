"""Queries on sequence tables, requantification pivots and the merged candidate table."""

from __future__ import annotations

from pyspark.sql import functions as F

from fusion_spark.catalog.registry import query
from fusion_spark.catalog.views import view
from fusion_spark.operators import merge as M
from fusion_spark.operators import model
from fusion_spark.schemas import MERGE_ANNOTATION_COLUMNS

_SEQS = """
ctx AS (SELECT *, CAST(floor(doc_id / 2) AS BIGINT) AS id, length(seq) AS len FROM fx_seq),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn
                         FROM ctx) t WHERE rn = 1)
"""


def _contexts(spark, sf_dir):
    seq = F.col("seq")
    return view(spark, sf_dir, "fx_seq").select(
        F.lit("S0").alias("sample"), "doc_id",
        F.floor(F.col("doc_id") / 2).cast("string").alias("context_sequence_id"),
        seq.alias("context_sequence"), F.length(seq).alias("context_sequence_bp"),
        F.reverse(seq).alias("context_sequence_wt1"), F.lit(0).alias("context_sequence_wt1_bp"),
        F.lower(seq).alias("context_sequence_wt2"),
        F.length(seq).alias("context_sequence_wt2_bp"),
    )


@query("seq_table_unpivot", "fx_seq", f"""
WITH {_SEQS}
SELECT concat(id, '_', len, '_ft') AS name, seq AS sequence, len AS position FROM first
UNION ALL SELECT concat(id, '_0_wt1'), reverse(seq), 0 FROM first
UNION ALL SELECT concat(id, '_', len, '_wt2'), lower(seq), len FROM first
""")
def seq_table_unpivot(spark, sf_dir):
    return M.seq_table(_contexts(spark, sf_dir), ["doc_id"]).select("name", "sequence", "position")


# Counts per sequence, composed from the calls: a call's junction and spanning reads become
# the counts of one sequence of the context named after its gene pair.
_REQUANT = """
requant AS (SELECT sample, concat(gene1, '.', gene2) AS ctx,
                   CASE l_linenumber % 3 WHEN 0 THEN 'ft' WHEN 1 THEN 'wt1' ELSE 'wt2' END AS t,
                   300 + span AS pos, junc, span, junc % 25 AS anch, ord FROM fx_calls),
library AS (SELECT sample, CAST(sum(junc + span) AS BIGINT) AS input_reads FROM fx_calls GROUP BY sample),
first AS (SELECT r.*, input_reads FROM (
            SELECT *, row_number() OVER (PARTITION BY sample, ctx, t ORDER BY ord) AS rn
            FROM requant) r JOIN library l ON l.sample = r.sample WHERE rn = 1)
"""


def _case(t: str, value: str, name: str) -> str:
    return f"max(CASE WHEN t = '{t}' THEN {value} END) AS {t}_{name}"


_CPM = "CAST({c} AS DOUBLE) / CAST(input_reads AS DOUBLE) * 1000000.0"
_SUPPORT = ",\n".join(
    _case(t, value, name)
    for t in ("ft", "wt1", "wt2")
    for name, value in (
        ("bp", "pos"), ("junc", _CPM.format(c="junc")), ("span", _CPM.format(c="span")),
        ("anch", "anch"), ("junc_cnt", "junc"), ("span_cnt", "span"), ("anch_cnt", "anch"),
    )
)


def _requant(calls):
    kind = F.col("l_linenumber") % 3
    return calls.select(
        "sample",
        F.concat(
            "gene1", F.lit("."), "gene2", F.lit("_"), 300 + F.col("span"),
            F.when(kind == 0, "_ft").when(kind == 1, "_wt1").otherwise("_wt2"),
        ).alias("name"),
        (300 + F.col("span")).alias("pos"), "junc", "span", (F.col("junc") % 25).alias("anch"),
        F.col("ord").alias("_ord"),
    )


def _library(calls):
    return calls.groupBy("sample").agg(F.sum(F.col("junc") + F.col("span")).alias("input_reads"))


@query("requant_pivot", "fx_calls", f"""
WITH {_REQUANT}
SELECT sample, ctx AS context_sequence_id, {_SUPPORT} FROM first GROUP BY sample, ctx
""")
def requant_pivot(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls")
    return M.requant_pivot(_requant(calls), ["_ord"], _library(calls))


# Annotation columns the merge passes through, from the calls.
_PASSED = {
    "BPID": "bpid", "context_sequence_id": "concat(gene1, '.', gene2)",
    "FTID": "concat(gene1, '_', bpid, '_', gene2)", "Fusion_Gene": "concat(gene1, '_', gene2)",
    "Breakpoint1": "bp1", "Breakpoint2": "bp2",
}
_PASSED |= {c: f"'{c}'" for c in MERGE_ANNOTATION_COLUMNS if c not in _PASSED}
_PASSED["neo_peptide_sequence"] = "tool"
_TOOLS = ["fusioncatcher", "starfusion", "arriba"]


def _evidence(tool: str) -> str:
    return (
        f"max(CASE WHEN tool = '{tool}' THEN 1 ELSE 0 END) AS {tool}_detected,"
        f" coalesce(max(CASE WHEN tool = '{tool}' THEN {_CPM.format(c='junc')} END), 0) AS {tool}_junc,"
        f" coalesce(max(CASE WHEN tool = '{tool}' THEN {_CPM.format(c='span')} END), 0) AS {tool}_span"
    )


@query("merged_candidates", "fx_calls", f"""
WITH {_REQUANT},
annotated AS (SELECT * FROM (
  SELECT sample, {", ".join(f'{v} AS "{k}"' for k, v in _PASSED.items())},
         row_number() OVER (PARTITION BY sample, concat(gene1, '_', bpid, '_', gene2)
                            ORDER BY ord DESC, tool DESC) AS rn
  FROM fx_calls) t WHERE rn = 1),
latest AS (SELECT c.*, input_reads FROM (
  SELECT *, row_number() OVER (PARTITION BY sample, bpid, tool ORDER BY ord DESC) AS rn
  FROM fx_calls) c JOIN library l ON l.sample = c.sample WHERE rn = 1),
evidence AS (SELECT sample, bpid, {", ".join(_evidence(t) for t in _TOOLS)},
             count(*) / 3 AS tool_frac FROM latest GROUP BY sample, bpid),
support AS (SELECT sample, ctx, {_SUPPORT} FROM first GROUP BY sample, ctx)
SELECT a.* EXCLUDE (rn), e.* EXCLUDE (sample, bpid), s.* EXCLUDE (sample, ctx)
FROM annotated a
LEFT JOIN evidence e ON e.sample = a.sample AND e.bpid = a."BPID"
LEFT JOIN support s ON s.sample = a.sample AND s.ctx = a.context_sequence_id
""")
def merged_candidates(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls")
    # moved before the columns that repeat its gene names and breakpoints are made
    moved = calls.select("sample", "tool", "gene1", "gene2", "bpid", "ord").repartition(
        "sample", "bpid"
    ).withColumns({
        "bp1": F.substring_index("bpid", "_", 1), "bp2": F.substring_index("bpid", "_", -1),
    })
    annotated = moved.select(
        "sample", *[F.expr(v).alias(k) for k, v in _PASSED.items()],
        F.struct("ord", "tool").alias("_ord"),
    )
    evidence = calls.select("sample", "bpid", "tool", "junc", "span", F.col("ord").alias("_ord"))
    return M.merge_candidates(
        annotated, evidence, _requant(calls), _library(calls), _TOOLS, ftid_names_bpid=True)


@query("rf_score", "", """
SELECT doc_id, in_range, prediction_class, in_range AS agrees FROM (
  SELECT doc_id,
         CASE WHEN lang IN ('en', 'fr', 'de') AND n_chars IS NOT NULL THEN true END AS in_range,
         CASE WHEN n_chars IS NOT NULL THEN
           CASE lang WHEN 'en' THEN 'positive' WHEN 'fr' THEN 'negative' WHEN 'de' THEN 'negative' END
         END AS prediction_class
  FROM documents) t
""")
def rf_score(spark, sf_dir):
    """Forest trained on the labelled documents, applied to all.

    The label follows from the frame, so SQL knows the class of every record. Languages
    outside the frame's levels get no prediction.
    """
    frame = (
        F.when(F.col("lang") == "en", "in_frame").when(F.col("lang") == "fr", "no_frame")
        .when(F.col("lang") == "de", "out_frame").otherwise("other")
    )
    features = view(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), frame.alias("frame"),
    )
    names = ["n_chars", "frame"]
    labelled = features.join(view(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    fitted = model.fit_model(
        labelled.withColumn("label", (F.col("frame") == "in_frame").cast("double")), names, trees=20
    )
    prob, kind = F.col("prediction_prob"), F.col("prediction_class")
    return model.score(features, fitted, names).select(
        "doc_id", prob.between(0, 1).alias("in_range"), kind.alias("prediction_class"),
        ((kind == model.POSITIVE) == (prob >= model.PREDICTION_THRESHOLD)).alias("agrees"),
    )


@query("level_index", "fx_calls", """
SELECT l_orderkey, l_linenumber, ord,
       CASE WHEN list_position(['no_match', '3prime', '5prime', 'both'], v) > 0
            THEN list_position(['no_match', '3prime', '5prime', 'both'], v) - 1 END AS level,
       CASE WHEN junc / 50.0 >= 0.5 THEN 'positive' ELSE 'negative' END AS prediction_class
FROM (SELECT *, CASE confidence WHEN 'high' THEN 'both' WHEN 'medium' THEN '3prime'
                WHEN 'low' THEN CASE WHEN span > 5 THEN 'no_match' ELSE 'other' END END AS v
      FROM fx_calls) t
""")
def level_index(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").withColumn(
        "exon_boundary",
        F.when(F.col("confidence") == "high", "both").when(F.col("confidence") == "medium", "3prime")
        .when(F.col("span") <= 5, "other"),
    )
    known = F.col("exon_boundary").isNotNull()
    indexed = model.level_indexer("exon_boundary").transform(model.prepare_features(calls))
    return indexed.select(
        "l_orderkey", "l_linenumber", "ord",
        F.when(known, F.col("_exon_boundary_idx").cast("bigint")).alias("level"),
        model.prediction_class(F.col("junc") / 50.0).alias("prediction_class"),
    )
