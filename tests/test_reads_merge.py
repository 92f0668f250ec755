import glob
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fusion_spark.operators import calls as C
from fusion_spark.operators import merge as M
from fusion_spark.operators import model
from fusion_spark.operators import reads as R
from fusion_spark.schemas import merged_columns

ALN = "sample string, rid bigint, qname string, flag int, nh int, chrom string, pos0 bigint, end0 bigint, qlen bigint, qalen bigint"


def pair(name, f1=99, f2=147, nh=1, clip=0, extra=(), pos=1000):
    rows = [(name, f1, nh, pos, 100 - clip), (name, f2, 1, pos + 200, 100)]
    return rows + [(name, f, 1, pos, 40) for f in extra]


@pytest.fixture(scope="module")
def alignments(spark):
    rows = (
        pair("normal") + pair("chimeric", extra=(2113,)) + pair("multi", nh=2) + pair("unmapped", f1=69 | 2)
        + pair("improper", f1=97) + pair("clipped", clip=10) + pair("clip9", clip=9)
        + pair("region", pos=5000) + [("alone", 99, 1, 1, 100)] + pair("dup", f2=147 + 1024)
    )
    return spark.createDataFrame(
        [("s", i, q, f, nh, "1", p, p + a, 100, a) for i, (q, f, nh, p, a) in enumerate(rows)], ALN)


def test_classes(alignments):
    got = {r.qname: (r["class"], r.kept) for r in R.classify_pairs(R.assemble_pairs(alignments)).collect()}
    assert got == {
        "normal": ("normal", False), "chimeric": ("star_chimeric", True), "multi": ("multimapped", False),
        "unmapped": ("unmapped", True), "improper": ("not_proper", True), "clipped": ("soft_clip", True),
        "clip9": ("normal", False), "region": ("normal", False), "alone": ("missing_mate", False),
        "dup": ("missing_mate", False),
    }


@pytest.mark.parametrize("large", [False, True])
def test_region_selection(spark, request, alignments, large):
    if large:
        request.getfixturevalue("no_broadcast")
    regions = spark.createDataFrame([("1", 5100, 5150), ("2", 1, 9)], "chrom string, start bigint, stop bigint")
    got = {r.qname: r["class"] for r in R.select_pairs(alignments, regions).collect()}
    assert got["region"] == "region_overlap" and got["normal"] == "normal" and len(got) == 10
    kept = R.selected_alignments(alignments, R.select_pairs(alignments, regions))
    assert kept.filter("qname = 'chimeric'").count() == 2  # the supplementary one stays behind


def test_counts_and_checks(spark, alignments):
    counts = R.filter_counts(R.classify_pairs(R.assemble_pairs(alignments)))
    row = counts.first()
    assert (row.input_alignments, row.input_pairs, row.filtered_pairs, row.excluded_alignments) == (20, 10, 4, 2)
    library = spark.createDataFrame([("s", 10)], "sample string, input_reads bigint")
    checked = R.read_qc(counts, library).first()
    assert checked.qc1 and not checked.qc2 and checked.filter_ratio == 0.4
    clean = R.filter_counts(R.classify_pairs(R.assemble_pairs(alignments.filter("qname in ('normal', 'chimeric')"))))
    assert R.read_qc(clean).first().qc2


def test_requantify_equals_brute_force(spark):
    random.seed(8)
    table = [("s", f"c{i}_{100 + i}_ft", 100 + i) for i in range(6)]
    reads = []
    for q in range(400):
        name = table[random.choice([0, 0, 0, 1, 2, 3, 4])][1]  # one sequence draws most reads
        for flag in (65, 129):
            start = random.randint(0, 180)
            reads.append(("s", name, q, flag + random.choice([0, 0, 0, 4, 256]), start, start + random.randint(20, 60)))
    got = R.requantify(
        spark.createDataFrame(reads, "sample string, name string, qname bigint, flag int, pos0 bigint, end0 bigint"),
        spark.createDataFrame(table, "sample string, name string, position bigint"),
    ).collect()
    assert len(got) == 6
    for r in got:
        mine = [x for x in reads if x[1] == r.name and x[3] <= 255 and not x[3] & 4]
        junctions = [min(r.pos - s, e - r.pos) for *_, s, e in mine if s + 10 <= r.pos and e >= r.pos + 10]
        mates = defaultdict(list)
        for x in mine:
            mates[x[2]].append(x[4:])
        span = sum(any(e <= r.pos for _, e in m) and any(s >= r.pos for s, _ in m) for m in mates.values())
        assert (r.junc, r.span, r.anch) == (len(junctions), span, max(junctions, default=0))


def test_cpm(spark):
    df = spark.createDataFrame([(100, 20220), (100, 0), (100, -1)], "c bigint, n bigint")
    got = [r.v for r in df.select(C.cpm(F.col("c"), F.col("n")).alias("v")).collect()]
    assert round(got[0]) == 4946 and got[1] == 100 and got[2] == -100_000_000


def test_merge(spark):
    tools = ["fusioncatcher", "Starfusion"]
    annotated = spark.createDataFrame(
        [("s", "b1", "f1", "c1", 1), ("s", "b1", "f1", "c2", 2), ("s", "b2", "f2", "c3", 3)],
        "sample string, BPID string, FTID string, context_sequence_id string, _ord bigint")
    for name in merged_columns(tools)[:21]:
        if name not in annotated.columns:
            annotated = annotated.withColumn(name, F.lit("v"))
    calls = spark.createDataFrame(
        [("s", "b1", "fusioncatcher", 1, 2, 1), ("s", "b1", "fusioncatcher", 10, 20, 2),
         ("s", "b1", "other", 5, 5, 3)],
        "sample string, bpid string, tool string, junc bigint, span bigint, _ord bigint")
    requant = spark.createDataFrame(
        [("s", f"c2_{p}_{t}", p, 100, 2, 25, o) for o, (p, t) in enumerate([(400, "ft"), (300, "wt1"), (9, "wt2"), (401, "ft")])],
        "sample string, name string, pos bigint, junc bigint, span bigint, anch bigint, _ord bigint")
    library = spark.createDataFrame([("s", 20220)], "sample string, input_reads bigint")
    merged = M.merge_candidates(annotated, calls, requant, library, tools)
    assert merged.columns == ["sample", *merged_columns(tools)] and len(merged_columns(["a", "b", "c"])) == 52
    rows = {r.FTID: r for r in merged.collect()}
    one, two = rows["f1"], rows["f2"]
    assert one.context_sequence_id == "c2"  # the last row of a transcript pair counts
    assert (one.fusioncatcher_detected, one.starfusion_detected, one.tool_frac) == (1, 0, 1.0)
    assert one.fusioncatcher_junc == 10 / 20220 * 1e6 and one.starfusion_span == 0
    assert (one.ft_bp, one.ft_junc_cnt, round(one.ft_junc), one.wt2_bp, one.ft_anch) == (400, 100, 4946, 9, 25)
    assert two.tool_frac is None and two.ft_bp is None
    with pytest.raises(Exception, match="no counts for context c3"):
        M.merge_candidates(annotated, calls, requant, library, tools, strict=True).collect()


def test_seq_table(spark):
    rows = spark.createDataFrame(
        [("s", "c", "AC", 1, "GG", 0, "TT", 2, 1), ("s", "c", "AC", 1, "other", 0, "TT", 2, 2)],
        "sample string, context_sequence_id string, context_sequence string, context_sequence_bp int,"
        " context_sequence_wt1 string, context_sequence_wt1_bp int, context_sequence_wt2 string,"
        " context_sequence_wt2_bp int, o int")
    got = sorted(tuple(r) for r in M.seq_table(rows, ["o"]).drop("sample").collect())
    assert got == [("c_0_wt1", "GG", 0), ("c_1_ft", "AC", 1), ("c_2_wt2", "TT", 2)]


def test_model(spark):
    rows = [(t, b, "in_frame", float(i % 7), float(b == "both"))
            for i, (t, b) in enumerate([("trans", "both"), ("cis_near", "no_match"), ("odd", None)] * 20)]
    df = spark.createDataFrame(rows, "type string, exon_boundary string, frame string, ft_junc double, label double")
    features = ["type", "exon_boundary", "frame", "ft_junc"]
    # an observed write before scoring leaves state on the session that cannot be serialized
    df.observe(Observation(), F.count("*").alias("n")).collect()
    fitted = model.fit_model(df, features, trees=5)
    assert not fitted.stages[-1].hasSummary
    scored = model.score(df, fitted, features)
    assert scored.columns == df.columns + ["prediction_prob", "prediction_class"]
    classes = {(r.exon_boundary, r.prediction_class) for r in scored.collect()}
    assert classes == {("both", "positive"), ("no_match", "negative"), ("no_match", None)}
    assert model.positives(scored).count() == 20
    with pytest.warns(UserWarning, match="ft_junc"):
        blank = model.score(df.drop("ft_junc"), fitted, features)
    assert {r.prediction_prob for r in blank.collect()} == {None}


def test_stages_from_calls_to_candidates(spark, no_broadcast, tmp_path):
    """All stages over stored tables, one sample, then only what is missing of three."""
    from fusion_spark.operators.sequences import chunk_sequences
    from fusion_spark.plans import stages
    from fusion_spark.schemas import TOOL_CALL

    random.seed(9)
    genome = {c: "".join(random.choice("ACGT") for _ in range(2000)) for c in ("1", "2")}
    exons = [("1", 101, 200, "e1", "T1", 0), ("2", 301, 400, "e2", "T2", 1)]
    genes = stages.GeneModel(
        exons=spark.createDataFrame(
            exons, "chrom string, start bigint, stop bigint, id string, transcript_id string, _ord bigint"),
        cds=spark.createDataFrame(
            [(c, s, e, f"c{i}", 0, t, o) for i, (c, s, e, _, t, o) in enumerate(exons)],
            "chrom string, start bigint, stop bigint, id string, frame int, transcript_id string, _ord bigint"),
        transcripts=spark.createDataFrame(
            [("T1", "pc", "G1", "pc", "d"), ("T2", "pc", "G2", "pc", "d")],
            "transcript_id string, trans_biotype string, gene_name string, gene_biotype string, description string"),
        tsl=spark.createDataFrame([("T1", "1"), ("T2", "1")], "transcript_id string, tsl string"),
        genome=chunk_sequences(spark.createDataFrame(list(genome.items()), "chrom string, seq string")),
    )
    call = ("1:200:+_2:301:+", "G1_G2", "1:200:+", "2:301:+", 5, 6)
    calls = spark.createDataFrame([call], TOOL_CALL)
    both = {
        tool: calls.withColumn("sample", F.explode(F.split(F.lit(samples), "")))
        for tool, samples in (("x", "ab"), ("y", "a"))
    }
    context = genome["1"][100:200] + genome["2"][300:400]
    name = f"{xxhash_hex(context)}_100_ft"
    reads = spark.createDataFrame(
        [("a", name, "r", 65, 50, 150), ("b", name, "r", 65, 95, 195)],
        "sample string, name string, qname string, flag int, pos0 bigint, end0 bigint")
    library = spark.createDataFrame([("a", 1000), ("b", 0)], "sample string, input_reads bigint")
    # of two pairs inside the exons of the fusion, the one of the sample without it stays out
    genomic = spark.createDataFrame(
        [(s, i, q, f, 1, c, p, p + 90, 90, 90) for i, (s, q, f, c, p) in enumerate([
            ("a", "in", 99, "1", 110), ("a", "in", 147, "1", 110), ("a", "far", 99, "1", 900),
            ("a", "far", 147, "1", 990), ("c", "in", 99, "1", 110), ("c", "in", 147, "1", 110),
            ("b", "odd", 97, "3", 5), ("b", "odd", 145, "3", 5)])], ALN)
    sheet = spark.createDataFrame([("a",), ("b",), ("c",)], "sample string")
    first = stages.run(
        spark, str(tmp_path), {t: d.filter("sample = 'a'") for t, d in both.items()}, genes, reads,
        library, ["x", "y"], alignments=genomic, sheet=sheet.limit(1), resume=True)
    assert [r.sample for r in first.collect()] == ["a"]
    done = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_path}/*/*ample=a/*.parquet")}
    assert len({f.split("/")[-3] for f in done}) == 6  # no read of a passes the filter
    merged = stages.run(spark, str(tmp_path), both, genes, reads, library, ["x", "y"],
                        alignments=genomic, sheet=sheet, resume=True)
    # a was not computed again; c has no calls, but is known to be done
    assert all(os.path.getmtime(f) == t for f, t in done.items())
    tables = stages.StageTables(spark, str(tmp_path), sheet, True)
    noted = [(r.stage, r.sample) for r in tables.manifest().collect()]
    assert len(noted) == len(set(noted)) == 7 * 3
    assert {(r.sample, r.qname) for r in spark.read.parquet(f"{tmp_path}/selected_reads").collect()} \
        == {("a", "in"), ("b", "odd")}
    assert {r.qname for r in spark.read.parquet(f"{tmp_path}/filtered_reads").collect()} == {"odd"}
    again = stages.run(spark, str(tmp_path), both, genes, reads, library, ["x", "y"],
                       sheet=sheet, resume=True)
    assert again.count() == 2
    fresh = stages.run(spark, f"{tmp_path}/fresh", both, genes, reads, library, ["x", "y"])
    assert sorted(map(str, fresh.collect())) == sorted(map(str, again.collect()))
    rows = {r.sample: r for r in merged.collect()}
    assert set(rows) == {"a", "b"} and rows["a"].context_sequence == context
    assert (rows["a"].tool_frac, rows["b"].tool_frac) == (1.0, 0.5)
    assert (rows["a"].x_junc, rows["b"].x_junc, rows["b"].y_detected) == (5000.0, 5.0, 0)
    assert (rows["a"].ft_junc_cnt, rows["a"].ft_anch, rows["a"].wt1_junc_cnt) == (1, 50, 0)
    assert rows["b"].ft_junc_cnt == 0
    assert rows["a"].exon_boundary == "both" and rows["a"].type == "trans"
    kept = stages.regions_of_interest(spark.read.parquet(f"{tmp_path}/annotated"))
    assert sorted(tuple(r) for r in kept.collect()) == [("1", 101, 200), ("2", 301, 400)]


def xxhash_hex(text):
    import xxhash

    return xxhash.xxh64(text).hexdigest()
