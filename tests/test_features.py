import random

import pytest
from pyspark.sql import functions as F

from fusion_spark.functions import breakpoints as B
from fusion_spark.functions import features as X

CDS = "array<struct<start:bigint,stop:bigint,frame:int>>"


def value(spark, expr, schema=None, *row):
    df = spark.createDataFrame([row], schema) if schema else spark.range(1)
    return df.select(expr.alias("v")).first().v


@pytest.mark.parametrize("pos, start, stop, expected", [
    (100, 100, 200, "left_boundary"), (100, 1, 100, "right_boundary"), (100, 50, 150, "within"),
    (100, 101, 200, "outside"), (100, None, None, "NA"),
])
def test_boundary(spark, pos, start, stop, expected):
    bounds = [F.lit(x).cast("bigint") for x in (pos, start, stop)]
    assert value(spark, B.boundary(*bounds)) == expected


def test_frames_golden(spark):
    cds = [(50, 100, 1), (75, 125, 1), (3, 4, 2)]
    schema = f"cds {CDS}"
    assert value(spark, X.frame_at_start(F.col("cds"), F.lit("+")), schema, cds) == 1
    assert value(spark, X.frame_at(F.col("cds"), F.lit(100), F.lit("+")), schema, cds) == 2
    assert value(spark, X.frame_at_start(F.col("cds"), F.lit("-")), schema, cds) == 2
    assert value(spark, X.frame_at(F.col("cds"), F.lit(1), F.lit("-")), schema, cds) == -1
    assert value(spark, X.frame_at_start(F.col("cds"), F.lit("+")), schema, []) == -1


def test_frame_against_table(spark):
    # phases met when walking into a segment, by the segment's own phase
    walk = {0: [0, 2, 1], 1: [1, 0, 2], 2: [2, 1, 0]}
    rows = [(s, p, f) for s in "+-" for p in range(100, 121) for f in range(3)]
    got = spark.createDataFrame(rows, "s string, p bigint, f int").select(
        "s", "p", "f", B.frame_in_cds(F.col("p"), F.col("s"), F.lit(100), F.lit(120), F.col("f")).alias("v")
    ).collect()
    for r in got:
        inner = r.p - 100 if r.s == "+" else 120 - r.p
        expected = r.f if inner == 0 else walk[r.f][(inner + 1) % 3]
        assert r.v == expected


@pytest.mark.parametrize("bp1, bp2, expected", [
    (("1", 100, "+"), ("1", 200, "+"), "cis_near"), (("1", 100, "+"), ("1", 2000000, "+"), "cis_far"),
    (("1", 200, "+"), ("1", 100, "+"), "cis_trans"), (("1", 100, "+"), ("1", 100, "+"), "cis_far"),
    (("1", 200, "-"), ("1", 100, "-"), "cis_near"), (("1", 100, "+"), ("1", 200, "-"), "cis_inv"),
    (("1", 100, "+"), ("2", 200, "+"), "trans"), (("1", 100, "+"), ("2", 200, "-"), "trans_inv"),
])
def test_fusion_type(spark, bp1, bp2, expected):
    assert value(spark, B.fusion_type(*[F.lit(x) for x in bp1 + bp2])) == expected


@pytest.mark.parametrize("strands, sides, expected", [
    ("+-", ("right_boundary", "right_boundary"), "both"),
    ("++", ("right_boundary", "right_boundary"), "no_match"),
    ("++", ("right_boundary", "left_boundary"), "both"),
    ("-+", ("left_boundary", "left_boundary"), "both"),
    ("--", ("left_boundary", "right_boundary"), "both"),
    ("++", ("right_boundary", "within"), "5prime"), ("++", ("within", "left_boundary"), "3prime"),
    ("++", ("within", "outside"), "no_match"),
])
def test_combined_boundary(spark, strands, sides, expected):
    args = [F.lit(x) for x in (*strands, *sides)]
    assert value(spark, B.combined_boundary(*args)) == expected


@pytest.mark.parametrize("f1, f2, expected", [
    (-1, 0, "no_frame"), (0, -1, "neo_frame"), (1, 1, "in_frame"), (1, 2, "out_frame"),
])
def test_frame_class(spark, f1, f2, expected):
    assert value(spark, B.frame_class(F.lit(f1), F.lit(f2))) == expected


def kept(features, pos, left):
    """Features on one side of a position, edge cut to it."""
    out = [list(f) for f in features if (f[0] <= pos if left else f[1] >= pos)]
    if not out:
        return []
    edge = out[-1] if left else out[0]
    near, far = (0, 1) if left else (1, 0)
    if edge[near] == pos:
        out.remove(edge)
    elif min(edge) <= pos <= max(edge):
        edge[far] = pos
    return [tuple(f) for f in out]


def test_truncation_property(spark):
    random.seed(7)
    rows = []
    for i in range(300):
        at, features = 0, []
        for _ in range(random.randint(0, 5)):
            at += random.randint(1, 6)
            end = at + random.randint(0, 6)
            features.append((at, end))
            at = end + 1
        rows.append((i, features, random.randint(0, 40), random.choice("+-")))
    df = spark.createDataFrame(rows, "i int, f array<struct<start:bigint,stop:bigint>>, p bigint, s string")
    for second in (False, True):
        got = df.select(
            "f", "p", "s",
            X.truncate_features(F.col("f"), F.col("p"), F.col("s"), second, ["start", "stop"]).alias("v"),
        ).collect()
        for r in got:
            expected = kept([tuple(x) for x in r.f], r.p, (r.s == "+") != second)
            assert [tuple(x) for x in r.v] == expected


def test_truncation_cuts_sequences(spark):
    schema = "f array<struct<start:bigint,stop:bigint,seq:string>>"
    f = [(10, 14, "ACGTA"), (20, 22, "GGC")]
    cut = X.truncate_features(F.col("f"), F.lit(21), F.lit("+"), False, ["start", "stop", "seq"])
    assert [tuple(x) for x in value(spark, cut, schema, f)] == [(10, 14, "ACGTA"), (20, 21, "GG")]
    cut = X.truncate_features(F.col("f"), F.lit(12), F.lit("+"), True, ["start", "stop", "seq"])
    assert [tuple(x) for x in value(spark, cut, schema, f)] == [(12, 14, "GTA"), (20, 22, "GGC")]


def test_containment_and_flags(spark):
    schema = f"e array<struct<start:bigint,stop:bigint>>, c {CDS}"
    row = ([(1, 10), (20, 30), (40, 50)], [(2, 10, 0), (20, 30, 1), (60, 70, 2)])
    inside = value(spark, X.cds_in_exons(F.col("e"), F.col("c")), schema, *row)
    assert [tuple(c) for c in inside] == [(2, 10, 0), (20, 30, 1)]
    flags = value(spark, X.cds_mismatch_flags(F.col("e"), F.col("c")), schema, *row)
    assert flags == ["cds != exon at no 0"]


@pytest.mark.parametrize("need, leading, trailing", [
    (-2, "1", "50"), (0, "1", "50"), (9, "1", "50"), (10, "1|20", "50"), (19, "1|20", "30|50"),
    (1000, "1|20|40", "10|30|50"),
])
def test_prefix_sums(spark, need, leading, trailing):
    schema = "e array<struct<start:bigint,stop:bigint>>"
    exons = [(1, 10), (20, 30), (40, 50)]
    first = X.joined(X.leading_features(F.col("e"), F.lit(need)), "start")
    last = X.joined(X.trailing_features(F.col("e"), F.lit(need)), "stop")
    assert value(spark, first, schema, exons) == leading
    assert value(spark, last, schema, exons) == trailing
    assert value(spark, X.joined(X.trailing_features(F.col("e"), F.lit(need)), "stop"), schema, []) == ""


def test_breakpoint_with_a_missing_part_is_null(spark):
    from fusion_spark.functions.breakpoints import breakpoint_id, breakpoint_text

    rows = spark.createDataFrame(
        [("1", 5, "+"), (None, 5, "+"), ("1", None, "+"), ("1", 5, None)],
        "chrom string, pos bigint, strand string",
    )
    text = breakpoint_text(rows.chrom, rows.pos, rows.strand)
    got = [tuple(r) for r in rows.select(text, breakpoint_id(text, text)).collect()]
    assert got == [("1:5:+", "1:5:+_1:5:+")] + [(None, None)] * 3
