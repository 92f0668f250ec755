"""Comments tell of coding segments and frames of both partners, as the annotation does."""

from __spark_entry__ import queries


def test_all_reasons(spark, tmp_path):
    # odd keys below are without coding segments
    part = [(76, 31), (77, 31), (266, 7), (267, 7), (402, 15), (288, 30), (289, 30)]
    spark.createDataFrame(
        [(key, "PROMO" if key % 2 else "STANDARD", size) for key, size in part],
        "p_partkey bigint, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    # (line, part, supplier, status): the parts of the second gene follow from the supplier
    lines = [(1, 76, 18, "O"), (2, 76, 18, "F"), (3, 402, 6, "O")]
    spark.createDataFrame(
        [(n, part, supplier, n, 5.0, 0.05, "N", status) for n, part, supplier, status in lines],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_discount double, l_returnflag string, l_linestatus string",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = queries()["filter_comment"](spark, str(tmp_path)).collect()
    got = {(r.tx, r.tx2, r.strand2): r.filter_comment for r in rows}
    assert len(got) == len(rows)
    assert got == {
        # the last coding segment kept of 76 ends before its breakpoint
        (76, 266, "-"): "bp1 after cds end", (76, 267, "-"): "bp1 after cds end",
        (77, 266, "-"): "no ft1 cds", (77, 267, "-"): "no ft1 cds",
        # on this strand the exon of the second breakpoint goes
        (76, 266, "+"): "bp1 after cds end|bp2 not in exons",
        (76, 267, "+"): "bp1 after cds end|bp2 not in exons",
        (77, 266, "+"): "no ft1 cds|bp2 not in exons", (77, 267, "+"): "no ft1 cds|bp2 not in exons",
        # in frame, but the segment at the breakpoint only starts there; 289 has no frame
        (402, 288, "-"): "no ft2 cds", (402, 289, "-"): "pass",
    }
    assert {(r.pos, r.strand, r.pos2) for r in rows if r.tx == 402} == {(2010080, "-", 1440005)}
