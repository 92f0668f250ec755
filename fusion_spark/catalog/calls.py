"""Queries over fusion calls: parsing fields, union, de-duplication and tool evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from fusion_spark.catalog.registry import query
from fusion_spark.catalog.views import view
from fusion_spark.functions import breakpoints as B
from fusion_spark.operators import calls as C
from fusion_spark.operators.annotation import passes_tsl
from fusion_spark.operators.dedup import first_by, mark_repeats, number_in_key, uniquify_ids
from fusion_spark.operators.skew import hot_keys, skew_join
from fusion_spark.schemas import CHROMS

TOOLS = ["fusioncatcher", "starfusion", "arriba"]
_CHROM_LIST = ", ".join(f"'{c}'" for c in CHROMS)


@query("union_tools", "fx_calls", """
SELECT sample AS "Sample", tool AS "Tool", bpid AS "BPID", junc AS "Junction_Reads",
       span AS "Spanning_Reads"
FROM fx_calls
""")
def union_tools(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select(
        F.col("sample"), "tool", F.col("bpid").alias("BPID"),
        F.col("junc").alias("Junction_Reads"), F.col("span").alias("Spanning_Reads"),
    )
    parts = {t: calls.filter(F.col("tool") == t).drop("tool") for t in TOOLS}
    return C.union_tools(parts)


@query("filter_primary_calls", "fx_calls", f"""
SELECT sample, tool, bpid, junc, span FROM fx_calls
WHERE confidence = 'high' AND chrom1 IN ({_CHROM_LIST}) AND chrom2 IN ({_CHROM_LIST})
""")
def filter_primary_calls(spark, sf_dir):
    return view(spark, sf_dir, "fx_calls").filter(
        (F.col("confidence") == "high")
        & B.is_primary(F.col("chrom1")) & B.is_primary(F.col("chrom2"))
    ).select("sample", "tool", "bpid", "junc", "span")


@query("bp_strings", "fx_calls", """
SELECT l_orderkey, l_linenumber, upper(concat(gene1, '_', gene2)) AS fusion_gene,
       concat_ws(':', chrom1, pos1, strand1) AS breakpoint1,
       concat_ws(':', chrom1, pos1, strand1) || '_' || concat_ws(':', chrom2, pos2, strand2)
         AS breakpoint_pair,
       split_part(bp2, ':', 1) AS chrom, CAST(split_part(bp2, ':', 2) AS BIGINT) AS pos,
       split_part(bp2, ':', 3) AS strand
FROM fx_calls
""")
def bp_strings(spark, sf_dir):
    bp1 = B.breakpoint_text(F.col("chrom1"), F.col("pos1"), F.col("strand1"))
    bp2 = B.breakpoint_text(F.col("chrom2"), F.col("pos2"), F.col("strand2"))
    return view(spark, sf_dir, "fx_calls").select(
        "l_orderkey", "l_linenumber",
        B.fusion_gene(F.col("gene1"), F.col("gene2")).alias("fusion_gene"),
        bp1.alias("breakpoint1"), B.breakpoint_id(bp1, bp2).alias("breakpoint_pair"),
        B.parse_breakpoint(F.col("bp2")).alias("b"),
    ).select("*", "b.chrom", "b.pos", "b.strand").drop("b")


@query("strand_pref", "fx_calls", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN split_part(s, '/', 2) <> '.' THEN split_part(s, '/', 2)
            ELSE split_part(s, '/', 1) END AS strand
FROM (SELECT l_orderkey, l_linenumber, concat(strand1, '/',
             CASE WHEN confidence = 'low' THEN '.' ELSE strand2 END) AS s FROM fx_calls) t
""")
def strand_pref(spark, sf_dir):
    field = F.concat_ws(
        "/", "strand1", F.when(F.col("confidence") == "low", ".").otherwise(F.col("strand2"))
    )
    return view(spark, sf_dir, "fx_calls").select(
        "l_orderkey", "l_linenumber", C.preferred_strand(field).alias("strand")
    )


@query("strip_chr", "fx_calls", """
SELECT l_orderkey, l_linenumber, trim(concat('chr', bp1, 'rch'), 'chr') AS breakpoint1
FROM fx_calls
""")
def strip_chr(spark, sf_dir):
    return view(spark, sf_dir, "fx_calls").select(
        "l_orderkey", "l_linenumber",
        C.strip_chr(F.concat(F.lit("chr"), "bp1", F.lit("rch"))).alias("breakpoint1"),
    )


@query("reciprocal_swap", "fx_calls", """
WITH listed AS (SELECT DISTINCT upper(concat(gene1, '_', gene2)) AS name FROM fx_calls
                WHERE span >= 9)
SELECT l_orderkey, l_linenumber, bpid,
       upper(CASE WHEN name IS NULL THEN concat(gene1, '_', gene2)
                  ELSE concat(gene2, '_', gene1) END) AS "Fusion_Gene"
FROM fx_calls LEFT JOIN listed ON name = upper(concat(gene1, '_', gene2))
""")
def reciprocal_swap(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls")
    summary = calls.filter(F.col("span") >= 9).select(
        F.concat(F.lit("  * "), "gene1", F.lit("--"), "gene2", F.lit("  (reciprocal)")).alias(
            "value"
        )
    )
    return C.swap_reciprocal(
        calls.select("l_orderkey", "l_linenumber", "bpid", "gene1", "gene2"),
        "gene1", "gene2", C.reciprocal_names(summary), [], ["l_orderkey", "l_linenumber"],
    ).drop("gene1", "gene2")


@query("gene_mode_first_tie", "fx_calls", """
WITH entries AS (
  SELECT l_orderkey, l_linenumber, ord, bpid,
         unnest([concat(gene1, '-201:a'), concat(gene2, '-202:b'), concat(gene1, '-203:c'),
                 concat(gene2, '-201:d'), concat('gene', junc, '-201:e')]) AS entry,
         unnest([1, 2, 3, 4, 5]) AS i
  FROM fx_calls),
names AS (SELECT *, left(split_part(entry, ':', 1), -4) AS name FROM entries),
counted AS (SELECT l_orderkey, l_linenumber, ord, bpid, name, count(*) AS n, min(i) AS first
            FROM names GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ord, bpid
                                        ORDER BY n DESC, first) AS rn FROM counted)
SELECT l_orderkey, l_linenumber, bpid, replace(name, '_', '-') AS gene
FROM ranked WHERE rn = 1
""")
def gene_mode_first_tie(spark, sf_dir):
    listed = F.concat_ws(
        ";",
        F.concat("gene1", F.lit("-201:a")), F.concat("gene2", F.lit("-202:b")),
        F.concat("gene1", F.lit("-203:c")), F.concat("gene2", F.lit("-201:d")),
        F.concat(F.lit("gene"), "junc", F.lit("-201:e")),
    )
    # equal calls are folded as the SQL side's grouping does
    return (
        view(spark, sf_dir, "fx_calls")
        .select("l_orderkey", "l_linenumber", "ord", "bpid", "gene1", "gene2", "junc")
        .distinct()
        .select(
            "l_orderkey", "l_linenumber", "bpid",
            C.main_gene(F.concat_ws(";", "gene1", "gene2"), listed).alias("gene"),
        )
    )


@query("dedup_first", "fx_calls", """
SELECT sample, bpid, tool, junc, span FROM (
  SELECT *, row_number() OVER (PARTITION BY sample, bpid ORDER BY ord, tool) AS rn
  FROM fx_calls) t WHERE rn = 1
""")
def dedup_first(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "tool", "junc", "span", "ord"
    )
    return first_by(calls, ["sample", "bpid"], ["ord", "tool"]).drop("ord")


@query("dedup_last", "fx_calls", """
SELECT sample, bpid, tool, junc, span FROM (
  SELECT *, row_number() OVER (PARTITION BY sample, bpid, tool ORDER BY ord DESC) AS rn
  FROM fx_calls) t WHERE rn = 1
""")
def dedup_last(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "tool", "junc", "span", "ord"
    )
    return C.latest_calls(calls, ["ord"]).drop("ord")


@query("distinct_breakpoints", "fx_calls", """
SELECT DISTINCT sample, bpid, chrom1, pos1, strand1, chrom2, pos2, strand2 FROM fx_calls
""")
def distinct_breakpoints(spark, sf_dir):
    return view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "chrom1", "pos1", "strand1", "chrom2", "pos2", "strand2"
    ).dropDuplicates()


@query("uniquify_ids", "fx_exons", """
SELECT tx, exon_no, CASE WHEN rn = 1 THEN id ELSE concat(id, '_', rn - 1) END AS id FROM (
  SELECT tx, exon_no, concat('exon', gene, '.', exon_no) AS id,
         row_number() OVER (PARTITION BY gene, exon_no ORDER BY ord) AS rn
  FROM fx_exons) t
""")
def feature_ids(spark, sf_dir):
    exons = view(spark, sf_dir, "fx_exons").select(
        "tx", "exon_no", "ord",
        F.concat(F.lit("exon"), "gene", F.lit("."), "exon_no").alias("id"),
    )
    return uniquify_ids(exons, "id", "ord").drop("ord")


@query("number_in_key", "fx_exons", """
SELECT tx, exon_no, chrom, row_number() OVER (PARTITION BY chrom ORDER BY ord) AS nth
FROM fx_exons
""")
def numbered_features(spark, sf_dir):
    exons = view(spark, sf_dir, "fx_exons").select("tx", "exon_no", "chrom", "ord")
    return number_in_key(exons, ["chrom"], "ord", "nth", span=1 << 12).drop("ord")


@query("tool_pivot", "fx_calls", """
WITH library AS (SELECT sample, sum(junc + span) AS input_reads FROM fx_calls GROUP BY sample),
latest AS (
  SELECT t.sample, bpid, tool, CAST(junc AS DOUBLE) / CAST(input_reads AS DOUBLE) * 1000000.0 AS junc,
         CAST(span AS DOUBLE) / CAST(input_reads AS DOUBLE) * 1000000.0 AS span
  FROM (SELECT *, row_number() OVER (PARTITION BY sample, bpid, tool ORDER BY ord DESC) AS rn
        FROM fx_calls) t JOIN library l ON t.sample = l.sample WHERE rn = 1)
SELECT sample, bpid,
       max(CASE WHEN tool = 'fusioncatcher' THEN 1 ELSE 0 END) AS fusioncatcher_detected,
       coalesce(max(CASE WHEN tool = 'fusioncatcher' THEN junc END), 0) AS fusioncatcher_junc,
       coalesce(max(CASE WHEN tool = 'fusioncatcher' THEN span END), 0) AS fusioncatcher_span,
       max(CASE WHEN tool = 'starfusion' THEN 1 ELSE 0 END) AS starfusion_detected,
       coalesce(max(CASE WHEN tool = 'starfusion' THEN junc END), 0) AS starfusion_junc,
       coalesce(max(CASE WHEN tool = 'starfusion' THEN span END), 0) AS starfusion_span,
       max(CASE WHEN tool = 'arriba' THEN 1 ELSE 0 END) AS arriba_detected,
       coalesce(max(CASE WHEN tool = 'arriba' THEN junc END), 0) AS arriba_junc,
       coalesce(max(CASE WHEN tool = 'arriba' THEN span END), 0) AS arriba_span,
       count(DISTINCT tool) / 3 AS tool_frac
FROM latest GROUP BY sample, bpid
""")
def tool_pivot(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "tool", "junc", "span", "ord"
    )
    library = calls.groupBy("sample").agg(F.sum(F.col("junc") + F.col("span")).alias("input_reads"))
    return C.tool_counts(calls, TOOLS, "ord", library)


@query("top_tool_per_pair", "fx_calls", """
SELECT sample, bpid, tool, n FROM (
  SELECT *, row_number() OVER (PARTITION BY sample, bpid ORDER BY n DESC, first, tool DESC) AS rn
  FROM (SELECT sample, bpid, tool, count(*) AS n, min(ord) AS first FROM fx_calls
        GROUP BY sample, bpid, tool) c) r
WHERE rn = 1
""")
def top_tool_per_pair(spark, sf_dir):
    return C.leading_tool(view(spark, sf_dir, "fx_calls"))


@query("annotation_bias", "fx_calls", """
SELECT l_orderkey, l_linenumber, sample, bpid,
       row_number() OVER (PARTITION BY sample, gene1, gene2 ORDER BY bpid, ord, tool) > 1
         AS annotation_bias
FROM fx_calls
""")
def annotation_bias(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select(
        "l_orderkey", "l_linenumber", "sample", "bpid", "gene1", "gene2", "ord", "tool"
    )
    return mark_repeats(
        calls, ["sample", "gene1", "gene2"], ["bpid", "ord", "tool"], "annotation_bias"
    ).drop("gene1", "gene2", "ord", "tool")


@query("fusion_type", "fx_calls", """
SELECT sample, bpid, ord, CASE
  WHEN chrom1 = chrom2 AND strand1 = strand2 THEN
    CASE WHEN d < 0 THEN 'cis_trans' WHEN d > 0 AND d <= 1000000 THEN 'cis_near'
         ELSE 'cis_far' END
  WHEN chrom1 = chrom2 THEN 'cis_inv' WHEN strand1 = strand2 THEN 'trans'
  ELSE 'trans_inv' END AS fusion_type
FROM (SELECT *, CASE WHEN strand1 = '+' THEN pos2 - pos1 ELSE pos1 - pos2 END AS d
      FROM fx_calls) t
""")
def fusion_type(spark, sf_dir):
    sides = [F.col(f"{c}{i}") for i in (1, 2) for c in ("chrom", "pos", "strand")]
    return view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "ord", B.fusion_type(*sides).alias("fusion_type")
    )


@query("caller_string_ops", "fx_calls", """
SELECT l_orderkey, l_linenumber,
       upper(replace(concat(gene1, '--', gene2), '--', '_')) AS starfusion_name,
       upper(concat(gene1, '_', gene2)) AS mapsplice_name,
       concat(chrom1, ':', pos1, ':', strand1) AS mapsplice_bp1,
       concat(chrom2, ':', pos2, ':', strand2) AS mapsplice_bp2,
       junc + span AS arriba_junc
FROM fx_calls
""")
def caller_string_ops(spark, sf_dir):
    chroms, strands = F.concat("chrom1", F.lit("~"), "chrom2"), F.concat("strand1", "strand2")
    lists = [F.concat(f"gene{i}", F.lit(",alt")) for i in (1, 2)]
    return view(spark, sf_dir, "fx_calls").select(
        "l_orderkey", "l_linenumber",
        F.upper(C.partner_name(F.concat("gene1", F.lit("--"), "gene2"))).alias("starfusion_name"),
        B.fusion_gene(C.first_listed(lists[0]), C.first_listed(lists[1])).alias("mapsplice_name"),
        B.breakpoint_text(
            F.split(chroms, "~")[0], F.col("pos1"), F.substring(strands, 1, 1)
        ).alias("mapsplice_bp1"),
        B.breakpoint_text(
            F.split(chroms, "~")[1], F.col("pos2"), F.substring(strands, 2, 1)
        ).alias("mapsplice_bp2"),
        (F.col("junc").cast("string").cast("bigint") + F.col("span")).alias("arriba_junc"),
    )


# Raw caller lines composed from the calls, parsed back by the caller's own parser.
_PARSED = """
SELECT sample, bpid AS "BPID", upper(concat(gene1, '_', gene2)) AS "Fusion_Gene",
       bp1 AS "Breakpoint1", bp2 AS "Breakpoint2", junc AS "Junction_Reads",
       span AS "Spanning_Reads"
FROM fx_calls WHERE chrom1 <> 'GL000220.1' AND chrom2 <> 'GL000220.1'
"""


@query("parse_arriba", "fx_calls", _PARSED + " AND confidence = 'high'")
def parse_arriba(spark, sf_dir):
    raw = view(spark, sf_dir, "fx_calls").select(
        "sample", F.col("gene1").alias("#gene1"), "gene2", "confidence",
        F.concat(F.lit("-/"), "strand1").alias("strand1(gene/fusion)"),
        F.concat("strand2", F.lit("/.")).alias("strand2(gene/fusion)"),
        F.concat_ws(":", "chrom1", "pos1").alias("breakpoint1"),
        F.concat_ws(":", "chrom2", "pos2").alias("breakpoint2"),
        (F.col("junc") - 1).cast("string").alias("split_reads1"),
        F.lit("1").alias("split_reads2"),
        F.col("span").cast("string").alias("discordant_mates"),
    )
    return C.parse_tool(spark, "arriba", raw)


@query("parse_fusioncatcher", "fx_calls", """
WITH listed AS (SELECT DISTINCT sample AS s, upper(concat(gene1, '_', gene2)) AS name
                FROM fx_calls WHERE junc > 45)
SELECT sample, bpid AS "BPID",
       upper(CASE WHEN name IS NULL THEN concat(gene1, '_', gene2)
                  ELSE concat(gene2, '_', gene1) END) AS "Fusion_Gene",
       bp1 AS "Breakpoint1", bp2 AS "Breakpoint2", junc AS "Junction_Reads",
       span AS "Spanning_Reads"
FROM fx_calls LEFT JOIN listed ON s = sample AND name = upper(concat(gene1, '_', gene2))
WHERE chrom1 <> 'GL000220.1' AND chrom2 <> 'GL000220.1'
""")
def parse_fusioncatcher(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls")
    raw = calls.select(
        "sample",
        F.col("gene1").alias("Gene_1_symbol(5end_fusion_partner)"),
        F.col("gene2").alias("Gene_2_symbol(3end_fusion_partner)"),
        F.col("bp1").alias("Fusion_point_for_gene_1(5end_fusion_partner)"),
        F.col("bp2").alias("Fusion_point_for_gene_2(3end_fusion_partner)"),
        F.col("junc").cast("string").alias("Spanning_unique_reads"),
        F.col("span").cast("string").alias("Spanning_pairs"),
    )
    mark = F.when(F.col("junc") > 45, "  (reciprocal fusion)").otherwise("  (known fusion)")
    summary = calls.select(
        "sample", F.concat(F.lit("  * "), "gene1", F.lit("--"), "gene2", mark).alias("value")
    )
    return C.parse_tool(spark, "fusioncatcher", raw, summary)


@query("parse_starfusion", "fx_calls", _PARSED)
def parse_starfusion(spark, sf_dir):
    raw = view(spark, sf_dir, "fx_calls").select(
        "sample", F.concat_ws("--", "gene1", "gene2").alias("#FusionName"),
        F.concat(F.lit("chr"), "bp1").alias("LeftBreakpoint"),
        F.concat(F.lit("chr"), "bp2").alias("RightBreakpoint"),
        F.col("junc").cast("string").alias("JunctionReadCount"),
        F.col("span").cast("string").alias("SpanningFragCount"),
    )
    return C.parse_tool(spark, "starfusion", raw)


@query("parse_infusion", "fx_calls", _PARSED)
def parse_infusion(spark, sf_dir):
    columns = {"junc": "num_split", "span": "num_paired"}
    for i in (1, 2):
        columns |= {f"chrom{i}": f"ref{i}", f"strand{i}": f"gene_{i}_strand"}
    raw = view(spark, sf_dir, "fx_calls").select(
        "sample",
        F.concat("gene1", F.lit(";other")).alias("gene_1"),
        F.concat_ws(
            ";", F.lit("other-201:1"), F.concat("gene1", F.lit("-201:1")),
            F.concat("gene1", F.lit("-202:2")),
        ).alias("transcript_1"),
        F.col("gene2").alias("gene_2"), F.lit("").alias("transcript_2"),
        F.col("pos1").cast("string").alias("break_pos1"),
        F.col("pos2").cast("string").alias("break_pos2"),
        *[F.col(k).cast("string").alias(v) for k, v in columns.items()],
    )
    return C.parse_tool(spark, "infusion", raw)


@query("parse_mapsplice", "fx_calls", _PARSED)
def parse_mapsplice(spark, sf_dir):
    def unread(n):
        return F.lit("\t".join("." * n))

    # fields 0-5, 6-26 unread, 27, 28-59 unread, 60, 61
    line = F.concat_ws(
        "\t", F.concat_ws("~", "chrom1", "chrom2"), "pos1", "pos2", unread(1), "junc",
        F.concat("strand1", "strand2"), unread(21), "span", unread(32),
        F.concat("gene1", F.lit(",x")), F.concat("gene2", F.lit(",y")),
    )
    raw = view(spark, sf_dir, "fx_calls").select("sample", line.alias("value"))
    return C.parse_tool(spark, "mapsplice", raw)


@query("parse_soapfuse", "fx_calls", _PARSED)
def parse_soapfuse(spark, sf_dir):
    names = {
        "gene1": "up_gene", "gene2": "dw_gene", "chrom1": "up_chr", "chrom2": "dw_chr",
        "pos1": "up_Genome_pos", "pos2": "dw_Genome_pos", "strand1": "up_strand",
        "strand2": "dw_strand", "junc": "Junc_reads_num", "span": "Span_reads_num",
    }
    raw = view(spark, sf_dir, "fx_calls").select(
        "sample", *[F.col(k).cast("string").alias(v) for k, v in names.items()]
    )
    return C.parse_tool(spark, "soapfuse", raw)


@query("fusion_ids", "fx_calls", """
SELECT l_orderkey, l_linenumber, ord, bpid, concat(gene1, '_', gene2) AS fusion_gene,
       concat_ws('_', gene1, bp1, trim(concat('transcript:ENST', pos1), 'transcript:'), gene2,
                 bp2, trim(concat('transcript:', gene2, 'tr'), 'transcript:')) AS ftid
FROM fx_calls
""")
def fusion_ids(spark, sf_dir):
    return view(spark, sf_dir, "fx_calls").select(
        "l_orderkey", "l_linenumber", "ord", "bpid",
        F.concat_ws("_", "gene1", "gene2").alias("fusion_gene"),
        B.fusion_transcript_id(
            F.col("gene1"), F.col("bp1"), F.concat(F.lit("transcript:ENST"), "pos1"),
            F.col("gene2"), F.col("bp2"), F.concat(F.lit("transcript:"), "gene2", F.lit("tr")),
        ).alias("ftid"),
    )


@query("sample_stage_join", "fx_calls", """
SELECT a.sample, total_junc, total_span, calls FROM
  (SELECT sample, CAST(sum(junc) AS BIGINT) AS total_junc FROM fx_calls GROUP BY sample) a
  JOIN (SELECT sample, CAST(sum(span) AS BIGINT) AS total_span FROM fx_calls GROUP BY sample) b
    ON a.sample = b.sample
  JOIN (SELECT sample, count(*) AS calls FROM fx_calls GROUP BY sample) c ON a.sample = c.sample
""")
def sample_stage_join(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls")
    stages = [
        calls.groupBy("sample").agg(F.sum("junc").alias("total_junc")),
        calls.groupBy("sample").agg(F.sum("span").alias("total_span")),
        calls.groupBy("sample").agg(F.count("*").alias("calls")),
    ]
    return stages[0].join(stages[1], "sample").join(stages[2], "sample")


@query("tsl_drop_rule", "fx_calls", """
SELECT l_orderkey, l_linenumber, ord FROM fx_calls
WHERE NOT (span > 8 OR CAST(junc % 6 AS VARCHAR) IN ('4', '5', 'NA')
           OR concat(span % 6, CASE WHEN junc > 40 THEN ' (assigned to previous version 1)'
                                    ELSE '' END) IN ('4', '5', 'NA'))
""")
def tsl_drop_rule(spark, sf_dir):
    tsl2 = F.concat(
        (F.col("span") % 6).cast("string"),
        F.when(F.col("junc") > 40, " (assigned to previous version 1)").otherwise(""),
    )
    return view(spark, sf_dir, "fx_calls").filter(
        passes_tsl(F.col("span") > 8, (F.col("junc") % 6).cast("string"), tsl2, "4,5,NA")
    ).select("l_orderkey", "l_linenumber", "ord")


@query("hot_key_join", "fx_calls", """
SELECT l_orderkey, l_linenumber, ord, c.strand1, n FROM fx_calls c
JOIN (SELECT strand1, count(*) AS n FROM fx_calls GROUP BY strand1) s ON c.strand1 = s.strand1
""")
def hot_key_join(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select("l_orderkey", "l_linenumber", "ord", "strand1")
    sizes = calls.groupBy("strand1").agg(F.count("*").alias("n"))
    return skew_join(
        calls, sizes, ["strand1"], spread=["l_orderkey", "l_linenumber"],
        hot=hot_keys(calls, ["strand1"], 5000),
    )
