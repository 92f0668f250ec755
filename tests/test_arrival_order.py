"""Last and first rows by arrival do not depend on how files are split or packed."""

import random

import pytest

from fusion_spark import schemas
from fusion_spark.operators.calls import tool_counts, union_tools
from fusion_spark.plans import stages
from fusion_spark.plans.annotate import distinct_fusions
from fusion_spark.sources import callers, tables

HEAD = ["#FusionName", "LeftBreakpoint", "RightBreakpoint", "JunctionReadCount",
        "SpanningFragCount"]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """Three files, the middle one the largest, so tasks do not get them in order of path."""
    draw = random.Random(5)
    folder, rows = tmp_path_factory.mktemp("calls"), []
    for name, n in (("a", 40), ("b", 900), ("c", 60)):
        part = []
        for i in range(n):
            site = draw.randrange(30)
            part.append([f"A--B{site}", f"1:{site}:+", f"2:{site}:-", str(len(rows) + i),
                         str(draw.randrange(9))])
        rows += part
        lines = ["\t".join(r) for r in [HEAD, *part]]
        (folder / f"{name}.tsv").write_text("\n".join(lines) + "\n")
    return str(folder), rows


@pytest.mark.parametrize("block", [700, 10_000, 1 << 27])
def test_last_call_wins(spark, files, block):
    folder, rows = files
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(block))
    try:
        calls = callers.read_tool(spark, "starfusion", folder, ordered=True)
        detected = stages.detect({"starfusion": calls, "again": calls}, "s").repartition(7)
        first = {r["bpid"] for r in distinct_fusions(detected).collect()}
        named = detected.selectExpr(
            "Sample AS sample", "BPID AS bpid", "Tool AS tool", "Junction_Reads AS junc",
            "Spanning_Reads AS span", "_ord")
        got = {r["bpid"]: (r["starfusion_junc"], r["starfusion_span"])
               for r in tool_counts(named, ["starfusion"], "_ord").collect()}
    finally:
        spark.conf.set(name, before)
    last = {f"{r[1]}_{r[2]}": (int(r[3]), int(r[4])) for r in rows}
    assert got == last and first == set(last)


def test_order_of_tools(spark, files):
    folder, _ = files
    calls = callers.read_tool(spark, "starfusion", folder, ordered=True)
    both = stages.detect({"second": calls, "first": calls}, "s").orderBy("_ord").collect()
    assert [r["Tool"] for r in both] == ["second"] * 1000 + ["first"] * 1000
    # without an order in every table the rows are numbered
    plain = callers.read_tool(spark, "starfusion", folder)
    assert "_ord" not in union_tools({"x": calls, "y": plain}, "s").columns
    assert dict(stages.detect({"x": calls, "y": plain}, "s").dtypes)["_ord"] == "bigint"


def test_tables_read_again(spark, tmp_path):
    expected = []
    for name, n in (("a", 3), ("b", 50), ("c", 2)):
        rows = [[f"{name}{i}", "g", "1:2:+", "1:3:+", "1", "2", "s", "t"] for i in range(n)]
        expected += [row[0] for row in rows]
        (tmp_path / f"{name}.csv").write_text(
            "\n".join(map(";".join, [schemas.DETECTED_COLUMNS, *rows])))
    read = tables.detected_fusions(spark, str(tmp_path)).repartition(5).orderBy("_ord")
    assert [r["BPID"] for r in read.collect()] == expected
