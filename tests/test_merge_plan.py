"""The candidate table moves each input once, and the joined rows once more."""

import os
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from fusion_spark.operators import merge as M
from fusion_spark.schemas import merged_columns

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_each_input_moves_once(no_broadcast):
    df = queries()["merged_candidates"](no_broadcast, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(sample#\d+, [a-zA-Z]", plan)) == 4


@pytest.mark.parametrize("ftid_names_bpid", [True, False])
def test_counts_become_cpm_last(spark, ftid_names_bpid):
    tools = ["a", "b"]
    annotated = spark.createDataFrame(
        [("s", "b1", "f1", "c1", 1), ("s", "b1", "f1", "c2", 2), ("t", "b1", "f1", "c2", 1),
         ("u", "b1", "f1", "c2", 1), ("s", "b2", "f2", "c2", 1)],
        "sample string, BPID string, FTID string, context_sequence_id string, _ord bigint")
    for name in merged_columns(tools)[:21]:
        if name not in annotated.columns:
            annotated = annotated.withColumn(name, F.lit("v"))
    calls = spark.createDataFrame(
        [(s, "b1", *call) for s in "stu" for call in [
            ("a", 9, 9, 1), ("a", 3, None, 2), ("other", 1, 1, 3), (None, 1, 1, 4)]],
        "sample string, bpid string, tool string, junc bigint, span bigint, _ord bigint")
    requant = spark.createDataFrame(
        [(s, "c2_7_ft", p, None, 5, 2, p) for s in "stu" for p in (7, 8)],
        "sample string, name string, pos bigint, junc bigint, span bigint, anch bigint, _ord bigint")
    library = spark.createDataFrame([("s", 1000), ("t", 0)], "sample string, input_reads bigint")
    if ftid_names_bpid:
        annotated = annotated.repartition(3, "sample", "BPID")
    merged = M.merge_candidates(
        annotated, calls, requant, library, tools, ftid_names_bpid=ftid_names_bpid)
    got = {
        (r.sample, r.FTID): (r.context_sequence_id, r.a_detected, r.a_junc, r.a_span, r.b_junc,
                             r.tool_frac, r.ft_bp, r.ft_junc, r.ft_span, r.ft_span_cnt, r.wt1_span)
        for r in merged.collect()
    }
    assert got == {
        ("s", "f1"): ("c2", 1, 3000.0, 0.0, 0.0, 1.5, 7, None, 5000.0, 5, None),
        ("t", "f1"): ("c2", 1, 3.0, 0.0, 0.0, 1.5, 7, None, 5.0, 5, None),
        ("u", "f1"): ("c2", 1, 0.0, 0.0, 0.0, 1.5, 7, None, None, 5, None),
        ("s", "f2"): ("c2", None, None, None, None, None, 7, None, 5000.0, 5, None),
    }
