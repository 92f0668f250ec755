import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from fusion_spark import schemas
from fusion_spark.operators.annotation import (
    ancestors, feature_hierarchy, feature_type_counts, features_below_transcripts,
)
from fusion_spark.operators.calls import parse_tool, union_tools
from fusion_spark.operators.reads import split_mates
from fusion_spark.sinks import writers as K
from fusion_spark.sources import alignments, annotation, callers, tables

FC_HEAD = [
    "Gene_1_symbol(5end_fusion_partner)", "Gene_2_symbol(3end_fusion_partner)", "Spanning_pairs",
    "Spanning_unique_reads", "Fusion_point_for_gene_1(5end_fusion_partner)",
    "Fusion_point_for_gene_2(3end_fusion_partner)",
]


def put(path, rows, sep="\t"):
    with open(path, "w") as out:
        for row in rows:
            out.write(sep.join(row) + "\n")
    return str(path)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def text(path):
    lines = []
    for part in sorted(glob.glob(f"{path}/**/part-*", recursive=True)):
        lines += open(part).read().splitlines()
    return lines


def test_arriba(spark, tmp_path):
    head = ["#gene1", "gene2", "strand1(gene/fusion)", "strand2(gene/fusion)", "breakpoint1",
            "breakpoint2", "split_reads1", "split_reads2", "discordant_mates", "confidence"]
    path = put(tmp_path / "a.tsv", [
        head,
        ["a1", "b2", "+/-", "-/.", "1:10", "X:20", "3", "4", "5", "high"],
        ["a1", "b2", "+/-", "-/.", "1:10", "X:20", "3", "4", "5", "low"],
        ["a1", "b2", "+/-", "-/.", "GL1:10", "X:20", "3", "4", "5", "high"],
    ])
    assert got(callers.read_tool(spark, "arriba", path)) == [
        ("1:10:-_X:20:-", "A1_B2", "1:10:-", "X:20:-", 7, 5)]


def test_fusioncatcher(spark, tmp_path):
    path = put(tmp_path / "f.tsv", [
        FC_HEAD, ["A", "B", "367", "16", "21:1:-", "7:2:-"], ["C", "D", "1", "2", "3:3:+", "4:4:+"],
    ])
    summary = put(tmp_path / "f.txt", [
        ["Found 2 fusions"], ["  * A--B  (known fusion)"], ["\t* C--D  (reciprocal fusion)"]])
    assert got(callers.read_tool(spark, "fusioncatcher", path, summary)) == [
        ("21:1:-_7:2:-", "A_B", "21:1:-", "7:2:-", 16, 367),
        ("3:3:+_4:4:+", "D_C", "3:3:+", "4:4:+", 2, 1)]


def test_starfusion(spark, tmp_path):
    path = put(tmp_path / "s.tsv", [
        ["#FusionName", "LeftBreakpoint", "RightBreakpoint", "JunctionReadCount", "SpanningFragCount"],
        ["a--b", "chr1:5:+", "chrMT:6:-", "8", "9"], ["a--b", "chr1:5:+", "chrUn:6:-", "8", "9"]])
    assert got(callers.read_tool(spark, "starfusion", path)) == [
        ("1:5:+_MT:6:-", "A_B", "1:5:+", "MT:6:-", 8, 9)]


def test_infusion(spark, tmp_path):
    head = ["gene_1", "gene_2", "transcript_1", "transcript_2", "ref1", "ref2", "break_pos1",
            "break_pos2", "gene_1_strand", "gene_2_strand", "num_split", "num_paired"]
    path = put(tmp_path / "i.tsv", [
        head,
        ["x_1", "p;q", "t", "P-001:1;Q-002:2;Q-003:3;P-004:4", "1", "2", "7", "8", "+", "-", "1", "2"]])
    assert got(callers.read_tool(spark, "infusion", path)) == [
        ("1:7:+_2:8:-", "X-1_P", "1:7:+", "2:8:-", 1, 2)]


def test_mapsplice_and_soapfuse(spark, tmp_path):
    row = ["."] * 64
    for i, v in {0: "1~X", 1: "10", 2: "20", 4: "5", 5: "+-", 27: "6", 60: "a,x", 61: "b,"}.items():
        row[i] = v
    path = put(tmp_path / "m.tsv", [row])
    expected = [("1:10:+_X:20:-", "A_B", "1:10:+", "X:20:-", 5, 6)]
    assert got(callers.read_tool(spark, "mapsplice", path)) == expected
    path = put(tmp_path / "so.tsv", [
        ["up_gene", "dw_gene", "up_chr", "dw_chr", "up_Genome_pos", "dw_Genome_pos", "up_strand",
         "dw_strand", "Junc_reads_num", "Span_reads_num"],
        ["a", "b", "1", "X", "10", "20", "+", "-", "5", "6"]])
    assert got(callers.read_tool(spark, "soapfuse", path)) == expected


def test_unknown_tool_is_empty(spark, tmp_path):
    empty = parse_tool(spark, "nothing", None)
    assert empty.columns == list(schemas.TOOL_COLUMNS) and empty.count() == 0
    assert callers.read_tool(spark, "nothing", "x").count() == 0


def test_calls_round_trip(spark, tmp_path):
    calls = spark.createDataFrame([("1:1:+_2:2:-", "A_B", "1:1:+", "2:2:-", 3, 4)], schemas.TOOL_CALL)
    K.write_tool_calls(calls, str(tmp_path / "t.csv"))
    assert got(tables.tool_calls(spark, str(tmp_path / "t.csv"))) == got(calls)
    detected = union_tools({"x": calls, "y": calls}, "s1")
    K.write_detected(detected, str(tmp_path / "d.csv"), str(tmp_path / "d"))
    back = tables.detected_fusions(spark, str(tmp_path / "d.csv"))
    assert got(back.drop("_ord")) == got(detected) and len(got(detected)) == 2
    assert os.path.isdir(tmp_path / "d" / "Sample=s1" / "Tool=x")


def test_sheet_logs_and_fastq(spark, tmp_path):
    path = put(tmp_path / "sheet.tsv", [["s1", "a.fq", "b.fq"], ["s2", "c.fq", "d.fq"]])
    sheet = tables.sample_sheet(spark, path)
    assert got(sheet) == [("s1", "a.fq", "b.fq"), ("s2", "c.fq", "d.fq")]
    os.makedirs(tmp_path / "logs" / "s1")
    put(tmp_path / "logs" / "s1" / "Log.final.out", [
        ["  Started job on |\tFeb 07"], ["   Number of input reads |\t20220"]])
    logs = tables.aligner_logs(spark, str(tmp_path / "logs" / "*" / "Log.final.out"))
    assert got(tables.library_sizes(logs, sheet)) == [("s1", 20220), ("s2", -1)]
    with gzip.open(tmp_path / "a.fq.gz", "wt") as out:
        out.write("@r\nAC\n+\nII\n" * 5)
    counts = tables.fastq_read_counts(spark, str(tmp_path / "*.fq.gz"))
    assert counts.first().reads == 5
    zipped = sheet.withColumn("fastq1", F.concat(F.lit("reads/"), "fastq1", F.lit(".gz")))
    assert got(tables.fastq_library_sizes(counts, zipped)) == [("s1", 5), ("s2", -1)]


def test_gff3(spark, tmp_path):
    rows = [
        ["##gff-version 3"],
        ["1", "x", "gene", "1", "99", ".", "+", ".", "ID=gene:G1;Name=ABC;biotype=pc;description=a%3Bb"],
        ["1", "x", "mRNA", "1", "99", ".", "+", ".", "ID=transcript:T1;Parent=gene:G1;transcript_biotype=tb"],
        ["1", "x", "exon", "1", "20", ".", "+", ".", "ID=e1;Parent=transcript:T1"],
        ["1", "x", "CDS", "5", "20", ".", "+", "0", "ID=CDS:P1;Parent=transcript:T1"],
        ["1", "x", "CDS", "30", "40", ".", "+", "2", "ID=CDS:P1;Parent=transcript:T1"],
    ]
    features = annotation.read_gff3(spark, put(tmp_path / "g.gff3", rows))
    cds = annotation.features_of_type(features, "CDS")
    assert sorted((r.id, r.start, r.frame, r.transcript_id) for r in cds.collect()) == [
        ("CDS:P1", 5, 0, "transcript:T1"), ("CDS:P1_1", 30, 2, "transcript:T1")]
    assert got(feature_type_counts(features)) == [("CDS", 2), ("exon", 1), ("gene", 1), ("mRNA", 1)]
    assert got(feature_hierarchy(features)) == [("transcript:T1", "tb", "ABC", "pc", "a b")]


def test_features_of_several_parents(spark, tmp_path):
    path = put(tmp_path / "g.gff3", [
        ["1", "x", "exon", "1", "20", ".", "+", ".", "ID=e1;Parent=transcript:T1,transcript:T2"],
        ["1", "x", "exon", "30", "40", ".", "+", ".", "ID=e2;Parent=transcript:T2"],
    ])
    exons = annotation.features_of_type(annotation.read_gff3(spark, path), "exon")
    assert got(exons.select("transcript_id", "id", "start")) == [
        ("transcript:T1", "e1", 1), ("transcript:T2", "e1", 1), ("transcript:T2", "e2", 30)]


def test_tables_have_few_files_per_sample(spark, tmp_path):
    rows = spark.range(4000, numPartitions=8).select(
        "id", (F.col("id") % 5).cast("string").alias("sample"))
    K.write_table(rows, str(tmp_path / "t"))
    assert len(glob.glob(f"{tmp_path}/t/sample=*/part-*")) == 5
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000


GTF = ('gene_id "G"; transcript_id "{t}"; transcript_biotype "pc"; gene_biotype "gb"; '
       'transcript_support_level "{l}";')


def gtf(tmp_path, *ids):
    rows = [["#!genome"]]
    for i, t in enumerate(ids):
        for kind in ("transcript", "exon"):
            rows.append(["1", "x", kind, "1", "2", ".", "+", ".", GTF.format(t=t, l=i)])
    return put(tmp_path / "a.gtf", rows)


def test_gtf_support_levels(spark, tmp_path):
    path = gtf(tmp_path, "ENST1", "ENST2", "ENST1", "MGP_1")
    tsl = annotation.read_gtf_tsl(spark, path)
    assert got(tsl) == [("ENST1", "pc", "gb", "0"), ("ENST2", "pc", "gb", "1"), ("MGP_1", "pc", "gb", "3")]
    assert annotation.read_gtf_tsl(spark, path, limit=2).count() == 2
    K.write_tsl(tsl, str(tmp_path / "tsl"))
    assert text(tmp_path / "tsl")[0] == "transcript_id\ttrans_biotype\tgene_biotype\ttsl"
    assert got(annotation.read_tsl(spark, str(tmp_path / "tsl"))) == got(tsl)


def test_unexpected_id_fails(spark, tmp_path):
    with pytest.raises(Exception, match="unexpected transcript id"):
        annotation.read_gtf_tsl(spark, gtf(tmp_path, "XX1")).collect()


def test_sam(spark, tmp_path):
    path = put(tmp_path / "s1.filtered.sam", [
        ["@HD", "VN:1.0"],
        ["r1", "99", "1", "101", "60", "5S10M100N20M2I3S", "=", "200", "9", "A" * 40, "I" * 40, "NH:i:2"],
        ["r1", "133", "*", "0", "0", "*", "=", "200", "9", "ACGT", "IIII"],
    ])
    rows = {r.flag: r for r in alignments.read_sam(spark, path).collect()}
    r = rows[99]
    assert (r.sample, r.pos0, r.end0, r.qlen, r.qalen, r.nh, r.chrom) == ("s1", 100, 230, 40, 32, 2, "1")
    assert (rows[133].chrom, rows[133].nh, rows[133].qlen) == (None, 1, 4)
    assert rows[99].rid < rows[133].rid


def test_mates(spark, tmp_path):
    rows = [("s", "a", 65, "ACG", "abc"), ("s", "a", 145, "ACG", "abc"), ("s", "b", 0, "T", "x"),
            ("s", "a", 2113, "ACG", "abc")]
    reads = spark.createDataFrame(rows, "sample string, qname string, flag int, seq string, qual string")
    split = split_mates(reads)
    assert got(split.select("mate", "seq", "qual")) == [
        ("other", "T", "x"), ("read1", "ACG", "abc"), ("read2", "CGT", "cba")]
    K.write_mates(split, str(tmp_path / "m"))
    assert os.path.isdir(tmp_path / "m" / "sample=s" / "mate=read2")


def test_candidates_and_predictions(spark, tmp_path):
    assert K.all_path("out/fusions.csv") == "out/fusions.all.csv"
    df = spark.createDataFrame(
        [("s", "a", None, 0.7, "positive"), ("s", "b", 2, 0.2, "negative")],
        "sample string, FTID string, ft_bp bigint, prediction_prob double, prediction_class string")
    assert K.write_candidates(df, str(tmp_path / "m.csv")) == (2, 4)
    assert "a;NA;0.7;positive" in text(tmp_path / "m.csv" / "sample=s")
    back = tables.merged_candidates(spark, str(tmp_path / "m.csv"))
    assert sorted((r.FTID, r.ft_bp) for r in back.collect()) == [("a", None), ("b", 2)]
    assert dict(back.dtypes)["prediction_prob"] == "double"
    K.write_predictions(df, str(tmp_path / "p.csv"))
    assert len(text(tmp_path / "p.csv")) == 2
    assert {t.split(";")[0] for t in text(tmp_path / "p.all.csv")} == {"FTID", "a", "b"}


def test_requant_and_long_fields(spark, tmp_path):
    path = put(tmp_path / "q.tsv", [["name", "pos", "junc", "span", "anch", "a", "b"],
                                    ["c_400_ft", "400", "205", "296", "25", "521", "378"]])
    assert got(tables.requant_counts(spark, path).drop("_ord")) == [("c_400_ft", 400, 205, 296, 25, 521, 378)]
    long = "A" * 2_000_000
    path = put(tmp_path / "l.csv", [["BPID", "context_sequence"], ["x", long]], ";")
    assert tables.annotated_fusions(spark, path).select(F.length("context_sequence")).first()[0] == len(long)


def test_hierarchy_of_any_depth(spark, tmp_path):
    rows = [
        ("gene", "ID=gene:A;Name=a"), ("gene", "ID=gene:B;Name=b"),
        ("cluster", "ID=c1;Parent=gene:B"),
        ("mRNA", "ID=transcript:T1;Parent=c1,gene:A"), ("mRNA", "ID=transcript:T2;Parent=c1"),
        ("mRNA", "ID=transcript:T3;Parent=gone"), ("mRNA", "ID=transcript:T4"),
        ("part", "ID=p1;Parent=transcript:T1,transcript:T2"), ("exon", "ID=e1;Parent=p1"),
        ("exon", "ID=e2;Parent=transcript:T4"), ("exon", "ID=e3;Parent=loop1"),
        ("x", "ID=loop1;Parent=loop2"), ("x", "ID=loop2;Parent=loop1"),
    ]
    lines = [f"1\tx\t{kind}\t{i}\t{i + 1}\t.\t+\t0\t{text}" for i, (kind, text) in enumerate(rows)]
    path = tmp_path / "deep.gff3"
    path.write_text("\n".join(lines))
    features = annotation.read_gff3(spark, str(path))
    found = {(r.id, r.ancestor): r.depth for r in ancestors(features).collect()}
    assert found["e1", "gene:B"] == 4 and found["e1", "gene:A"] == 3
    assert found["transcript:T1", "gene:A"] == 1 and found["transcript:T1", "gene:B"] == 2
    assert found["e3", "loop2"] == 2 and ("loop1", "loop1") not in found
    names = {r.transcript_id: r.gene_name for r in feature_hierarchy(features).collect()}
    assert names == {"transcript:T1": "a", "transcript:T2": "b", "transcript:T3": "",
                     "transcript:T4": ""}
    owners = {(r.id, r.transcript_id) for r in features_below_transcripts(features, "exon").collect()}
    assert owners == {("e1", "transcript:T1"), ("e1", "transcript:T2"), ("e2", "transcript:T4")}
    assert ancestors(features.limit(0)).collect() == []
