"""Genomic views of the given tables, as the same SQL for Spark and for the SQL check.

``part`` becomes a gene model (two transcripts per gene), ``lineitem`` fusion calls of
three tools and four samples, ``events`` paired alignments and ``documents`` nucleotide
sequences. Every view covers its whole table and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Chromosome of a gene number; 'GL000220.1' stands for a contig outside the primary set.
_CHROM = (
    "CASE {g} % 7 WHEN 5 THEN 'MT' WHEN 6 THEN 'GL000220.1'"
    " ELSE CAST({g} % 7 + 1 AS STRING) END"
)


def _chrom(gene: str) -> str:
    return _CHROM.replace("{g}", gene)


_EXONS = f"""
SELECT tx, gene, {_chrom('gene')} AS chrom,
       CASE WHEN gene % 2 = 0 THEN '+' ELSE '-' END AS strand, coding, exon_no,
       gene*10000 + exon_no*40 AS start,
       gene*10000 + exon_no*40 + 20 + extra AS stop,
       tx*8 + exon_no AS ord
FROM (SELECT p_partkey AS tx, CAST(floor(p_partkey / 2) AS BIGINT) AS gene,
             p_type <> 'PROMO' AS coding, p_size % 15 AS extra,
             @exon_numbers AS exon_no
      FROM {{part}}) t
"""

_CDS = """
SELECT tx, gene, chrom, strand, exon_no,
       start + CASE WHEN exon_no = 0 THEN 5 ELSE 0 END AS start,
       stop - CASE WHEN exon_no % 3 = 2 THEN 3 ELSE 0 END AS stop,
       CAST(exon_no % 3 AS INT) AS frame, ord
FROM {fx_exons} WHERE coding
"""

_CALLS = f"""
SELECT *, concat(chrom1, ':', pos1, ':', strand1) AS bp1,
       concat(chrom2, ':', pos2, ':', strand2) AS bp2,
       concat(chrom1, ':', pos1, ':', strand1, '_', chrom2, ':', pos2, ':', strand2) AS bpid
FROM (
SELECT concat('S', s % 4) AS sample,
       CASE l_linenumber % 3 WHEN 0 THEN 'arriba' WHEN 1 THEN 'starfusion'
            ELSE 'fusioncatcher' END AS tool,
       concat('gene', g1) AS gene1, concat('gene', g2) AS gene2,
       {_chrom('g1')} AS chrom1,
       g1*10000 + (s % 4)*40 + (CASE s % 5 WHEN 0 THEN -1 WHEN 1 THEN 0 WHEN 2 THEN 10
                                WHEN 3 THEN 20 ELSE 25 END) AS pos1,
       CASE WHEN g1 % 2 = 0 THEN '+' ELSE '-' END AS strand1,
       {_chrom('g2')} AS chrom2,
       g2*10000 + (s % 2)*40 + (CASE s % 5 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 21
                                WHEN 3 THEN 27 ELSE 36 END) AS pos2,
       CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand2,
       CASE l_returnflag WHEN 'N' THEN 'high' WHEN 'A' THEN 'medium' ELSE 'low' END
         AS confidence,
       junc, span, l_orderkey, l_linenumber,
       (l_orderkey*8 + l_linenumber)*1024 + junc*16 + span AS ord
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
             l_suppkey % 20 AS s, CAST(floor(l_partkey / 2) AS BIGINT) AS g1,
             CAST(floor(abs(l_partkey - 19*(l_suppkey % 20)) / 2) AS BIGINT) AS g2,
             CAST(l_quantity AS BIGINT) AS junc,
             CAST(round(l_discount*100) AS BIGINT) AS span
      FROM {{lineitem}}) t) u
"""

_ALN = f"""
SELECT rid, concat('S', qname % 4) AS sample, qname, CAST(flag AS INT) AS flag,
       CAST(nh AS INT) AS nh, {_chrom('gene')} AS chrom, pos0, pos0 + qalen AS end0,
       CAST(100 AS BIGINT) AS qlen, qalen
FROM (
SELECT event_id*2 AS rid, CAST(floor(event_id / 2) AS BIGINT) AS qname,
       1 + CASE WHEN event_id % 2 = 0 THEN 64 ELSE 128 END
         + CASE WHEN event_type = 'error' THEN 4 ELSE 0 END
         + CASE WHEN event_type <> 'click' THEN 2 ELSE 0 END
         + CASE WHEN value > 150 THEN 256 ELSE 0 END AS flag,
       CASE WHEN user_id % 9 = 0 THEN 2 ELSE 1 END AS nh,
       CAST(floor(event_id / 2) * 2000 AS BIGINT) + (event_id % 2)*150 + user_id % 200 AS pos0,
       CAST(floor(floor(event_id / 2) / 5) AS BIGINT) AS gene,
       100 - CAST(floor(value) AS BIGINT) % 15 AS qalen
FROM {{events}}
UNION ALL
SELECT event_id*2 + 1, CAST(floor(event_id / 2) AS BIGINT), 2113, 1,
       CAST(floor(event_id / 2) * 2000 AS BIGINT) + user_id,
       CAST(floor(floor(event_id / 2) / 5) AS BIGINT), 40
FROM {{events}} WHERE event_type = 'signup' AND value > 60) t
"""

_SEQ = """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'MT' ELSE '1' END AS chrom,
       CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand,
       CAST(doc_id % 4 AS INT) - 1 AS frame,
       translate(@regexp_all(text, '[^a-zA-Z]', ''),
                 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTAC') AS seq
FROM {documents}
"""

# Contexts of requantification: one per customer, each with a fusion and two wild types.
_CONTEXTS = """
SELECT 'S0' AS sample, concat(c_custkey, '_', 300 + c_custkey % 200, '_', seq_type) AS name,
       300 + c_custkey % 200 AS position
FROM (SELECT c_custkey, @seq_types AS seq_type FROM {customer}) t
"""

_RQ_ALN = """
SELECT 'S0' AS sample, concat(ctx, '_', 300 + ctx % 200, '_', seq_type) AS name, qname,
       flag, pos0, pos0 + qalen AS end0
FROM (SELECT CAST(floor(event_id / 16) AS BIGINT) AS ctx,
             CASE CAST(floor(event_id / 2) AS BIGINT) % 3 WHEN 0 THEN 'ft' WHEN 1 THEN 'wt1'
                  ELSE 'wt2' END AS seq_type,
             CAST(floor(event_id / 2) AS BIGINT) AS qname,
             1 + CASE WHEN event_id % 2 = 0 THEN 64 ELSE 128 END
               + CASE WHEN event_type = 'error' THEN 4 ELSE 0 END AS flag,
             (event_id * 37) % 700 AS pos0,
             100 - CAST(floor(value) AS BIGINT) % 25 AS qalen
      FROM {events}) t
"""

VIEWS = {
    "fx_exons": _EXONS, "fx_cds": _CDS, "fx_calls": _CALLS, "fx_aln": _ALN, "fx_seq": _SEQ,
    "fx_contexts": _CONTEXTS, "fx_rq_aln": _RQ_ALN,
}
_BASE = {
    "fx_exons": ["part"], "fx_cds": ["fx_exons"], "fx_calls": ["lineitem"],
    "fx_aln": ["events"], "fx_seq": ["documents"], "fx_contexts": ["customer"],
    "fx_rq_aln": ["events"],
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view as a DataFrame over the parquet tables in ``sf_dir``."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = (
        VIEWS[name]
        .replace("@exon_numbers", "explode(sequence(0L, CAST(1 + p_size % 6 AS BIGINT)))")
        .replace("@regexp_all(", "regexp_replace(")
        .replace("@seq_types", "explode(array('ft', 'wt1', 'wt2'))")
    )
    return spark.sql(text, **{b: view(spark, sf_dir, b) for b in _BASE[name]})


def _check_text(name: str) -> str:
    text = (
        VIEWS[name]
        .replace("@exon_numbers", "unnest(range(0, 2 + p_size % 6))")
        .replace("@regexp_all(text, '[^a-zA-Z]', '')",
                 "regexp_replace(text, '[^a-zA-Z]', '', 'g')")
        .replace("@seq_types", "unnest(['ft', 'wt1', 'wt2'])")
        .replace("STRING", "VARCHAR")
    )
    for base in _BASE[name]:
        text = text.replace("{" + base + "}", base)
    return text


def with_views(sql: str, *names: str) -> str:
    """Prefixes a query for the SQL check with the definitions of the views it reads."""
    needed: list[str] = []

    def add(name: str) -> None:
        for base in _BASE[name]:
            if base in VIEWS:
                add(base)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    body = sql.strip()
    definitions = ",\n".join(f"{n} AS ({_check_text(n)})" for n in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {definitions},\n{body[5:]}"
    return f"WITH {definitions}\n{body}"
