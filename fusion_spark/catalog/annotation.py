"""Queries over gene models and breakpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from fusion_spark.catalog.registry import query
from fusion_spark.catalog.views import view
from fusion_spark.functions import breakpoints as B
from fusion_spark.functions import features as X
from fusion_spark.operators import annotation as A
from fusion_spark.operators.intervals import interval_join, merge_intervals, parse_ranges
from fusion_spark.operators.skew import shuffled, skew_join
from fusion_spark.sources.annotation import (
    gtf_value, has_known_prefix, parse_gff3, tsl_from_attributes,
)

_BOUNDARY = """CASE WHEN {s} IS NULL THEN 'NA' WHEN {p} = {s} THEN 'left_boundary'
  WHEN {p} = {e} THEN 'right_boundary' WHEN {s} < {p} AND {p} < {e} THEN 'within'
  ELSE 'outside' END"""


def _boundary(p: str, s: str, e: str) -> str:
    return _BOUNDARY.format(p=p, s=s, e=e)


# Breakpoints of both sides, the exons at them with boundaries, reading frames.
_HITS = f"""
bps AS MATERIALIZED (SELECT chrom1 AS chrom, pos1 AS pos, strand1 AS strand FROM fx_calls
        UNION SELECT chrom2, pos2, strand2 FROM fx_calls),
binned_exons AS MATERIALIZED (
  SELECT *, unnest(range((start - 1) // 16384, (stop + 1) // 16384 + 1)) AS bin FROM fx_exons),
binned_cds AS MATERIALIZED (
  SELECT *, unnest(range((start - 1) // 16384, (stop + 1) // 16384 + 1)) AS bin FROM fx_cds),
cds_hits AS MATERIALIZED (SELECT concat(chrom, ':', pos, ':', tx) AS place, start, stop FROM (
  SELECT b.chrom, b.pos, c.tx, c.start, c.stop,
         row_number() OVER (PARTITION BY b.chrom, b.pos, c.tx ORDER BY c.ord) AS rn
  FROM (SELECT DISTINCT chrom, pos FROM bps) b JOIN binned_cds c
    ON b.chrom = c.chrom AND b.pos // 16384 = c.bin AND c.start <= b.pos + 1 AND c.stop >= b.pos - 1) t WHERE rn = 1),
exon_hits AS MATERIALIZED (
  SELECT b.chrom, b.pos, b.strand, e.tx, e.ord AS exon_ord, e.start, e.stop,
         concat(b.chrom, ':', b.pos, ':', e.tx) AS place
  FROM bps b JOIN binned_exons e
    ON b.chrom = e.chrom AND b.pos // 16384 = e.bin AND e.start <= b.pos + 1 AND e.stop >= b.pos - 1),
hits AS MATERIALIZED (
  SELECT b.chrom, b.pos, b.strand, b.tx, exon_ord,
         {_boundary('b.pos', 'b.start', 'b.stop')} AS exon_boundary,
         {_boundary('b.pos', 'h.start', 'h.stop')} AS cds_boundary
  FROM exon_hits b LEFT JOIN cds_hits h ON h.place = b.place)
"""
_FRAMES = """
starts AS MATERIALIZED (SELECT tx, min_by(frame, start) AS first_frame, max_by(frame, start) AS last_frame
           FROM fx_cds GROUP BY tx),
framed AS MATERIALIZED (
  SELECT h.chrom, h.pos, h.strand, h.tx, h.exon_ord, h.exon_boundary, h.cds_boundary,
         coalesce(CASE WHEN h.strand = '+' THEN first_frame ELSE last_frame END, -1)
           AS frame_at_start,
         coalesce(CAST(CASE WHEN h.strand = '+' THEN
             CASE WHEN h.pos = c.start THEN c.frame
                  ELSE (c.frame + 3 - (h.pos - c.start + 1) % 3) % 3 END
           ELSE CASE WHEN h.pos = c.stop THEN c.frame
                     ELSE (c.frame + 3 - (c.stop - h.pos + 1) % 3) % 3 END END AS INT), -1)
           AS frame_at_bp
  FROM hits h LEFT JOIN starts s ON s.tx = h.tx
  LEFT JOIN fx_cds c ON c.tx = h.tx AND c.start <= h.pos AND h.pos <= c.stop)
"""
# Hits are listed in one row per breakpoint, so a fusion meets one row a side in any join order.
_PAIRS = """
loci AS MATERIALIZED (SELECT tx, min(start) AS start, max(stop) AS stop FROM fx_exons GROUP BY tx),
located AS MATERIALIZED (
  SELECT concat(chrom, ':', pos, ':', strand) AS bp, {'tx': f.tx, 'exon_ord': exon_ord,
      'exon_boundary': exon_boundary, 'frame': frame_at_bp, 'start': l.start, 'stop': l.stop} AS hit
  FROM framed f JOIN loci l ON l.tx = f.tx),
listed AS MATERIALIZED (SELECT bp, list(hit) AS hits FROM located GROUP BY bp),
fusions AS MATERIALIZED (
  SELECT DISTINCT sample, bpid, chrom1, pos1, strand1, chrom2, pos2, strand2, bp1, bp2
  FROM fx_calls),
first_side AS MATERIALIZED (
  SELECT f.*, unnest(hits) AS a FROM fusions f JOIN listed ON bp = bp1),
both_sides AS MATERIALIZED (
  SELECT f.*, unnest(hits) AS b FROM first_side f JOIN listed ON bp = bp2),
pairs AS MATERIALIZED (
  SELECT sample, bpid, chrom1, pos1, strand1, chrom2, pos2, strand2,
         a.tx AS tx1, b.tx AS tx2, a.exon_ord AS exon_ord1, b.exon_ord AS exon_ord2,
         a.exon_boundary AS exon_boundary1, b.exon_boundary AS exon_boundary2,
         a.frame AS frame1, b.frame AS frame2,
         a.start AS start1, a.stop AS stop1, b.start AS start2, b.stop AS stop2
  FROM both_sides)
"""


def _model(spark, sf_dir):
    """Exons and coding segments under the operators' column names."""
    exons, cds = view(spark, sf_dir, "fx_exons"), view(spark, sf_dir, "fx_cds")
    names = {"tx": "transcript_id", "ord": "_ord"}
    return exons.withColumnsRenamed(names), cds.withColumnsRenamed(names)


def _fusions(spark, sf_dir):
    return view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "chrom1", "pos1", "strand1", "chrom2", "pos2", "strand2"
    ).distinct()


def _points(calls):
    sides = [
        calls.select(*[F.col(f"{c}{i}").alias(c) for c in ("chrom", "pos", "strand")])
        for i in (1, 2)
    ]
    return sides[0].unionByName(sides[1])


def _hits(spark, sf_dir):
    exons, cds = _model(spark, sf_dir)
    return A.breakpoint_hits(_points(view(spark, sf_dir, "fx_calls")), exons, cds)


def _cds_lists(cds):
    return A.transcript_arrays(cds, ["start", "stop", "frame"], "cds")


def _framed(spark, sf_dir):
    _, cds = _model(spark, sf_dir)
    return (
        skew_join(_hits(spark, sf_dir), shuffled(_cds_lists(cds)), ["transcript_id"], "left",
                  ["chrom", "pos", "strand"])
        .withColumn("cds", F.coalesce("cds", F.array().cast("array<struct<start:bigint,stop:bigint,frame:int>>")))
        .withColumn("frame_at_start", X.frame_at_start(F.col("cds"), F.col("strand")))
        .withColumn("frame_at_bp", X.frame_at(F.col("cds"), F.col("pos"), F.col("strand")))
        .drop("cds")
    )


def _pairs(spark, sf_dir):
    exons, _ = _model(spark, sf_dir)
    loci = exons.groupBy("transcript_id").agg(
        F.min("start").alias("locus_start"), F.max("stop").alias("locus_stop")
    )
    sides = skew_join(
        _framed(spark, sf_dir), shuffled(loci), ["transcript_id"], "inner", ["chrom", "pos", "strand"]
    )
    first = A.pair_sides(_fusions(spark, sf_dir), sides, 1, ["sample", "bpid"])
    return A.pair_sides(first, sides, 2, ["sample", "bpid", "exon_ord1"])


@query("interval_join_exon", "fx_calls fx_exons", """
SELECT c.sample, c.bpid, c.tool, c.ord, e.tx, e.exon_no
FROM fx_calls c JOIN fx_exons e
  ON c.chrom1 = e.chrom AND e.start <= c.pos1 + 1 AND e.stop >= c.pos1 - 1
""")
def interval_join_exon(spark, sf_dir):
    calls = view(spark, sf_dir, "fx_calls").select(
        "sample", "bpid", "tool", "ord", F.col("chrom1").alias("chrom"), F.col("pos1").alias("pos")
    )
    exons = view(spark, sf_dir, "fx_exons").select("chrom", "start", "stop", "tx", "exon_no")
    return interval_join(calls, exons).select(
        "sample", "bpid", "tool", "ord", "tx", "exon_no"
    )


@query("interval_join_boundary", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS} SELECT * FROM hits
""")
def interval_join_boundary(spark, sf_dir):
    return _hits(spark, sf_dir).withColumnRenamed("transcript_id", "tx")


@query("frame_at_bp", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS}, {_FRAMES}
SELECT DISTINCT chrom, pos, strand, tx, frame_at_start, frame_at_bp FROM framed
""")
def frame_at_bp(spark, sf_dir):
    return _framed(spark, sf_dir).select(
        "chrom", "pos", "strand", F.col("transcript_id").alias("tx"), "frame_at_start",
        "frame_at_bp",
    ).distinct()


@query("tx_pairs", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS}, {_FRAMES}, {_PAIRS}
SELECT sample, bpid, tx1, exon_ord1, tx2, exon_ord2,
       chrom1 = chrom2 AND stop1 >= start2 AND start1 <= stop2 AS loci_overlap
FROM pairs
""")
def tx_pairs(spark, sf_dir):
    kind = B.fusion_type(*[F.col(f"{c}{i}") for i in (1, 2) for c in ("chrom", "pos", "strand")])
    return _pairs(spark, sf_dir).select(
        "sample", "bpid", F.col("transcript_id1").alias("tx1"), "exon_ord1",
        F.col("transcript_id2").alias("tx2"), "exon_ord2",
        B.loci_overlap(
            kind, F.col("locus_start1"), F.col("locus_stop1"), F.col("locus_start2"),
            F.col("locus_stop2"),
        ).alias("loci_overlap"),
    )


@query("combined_boundary", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS}, {_FRAMES}, {_PAIRS}
SELECT sample, bpid, exon_ord1, exon_ord2, CASE
  WHEN (strand1, strand2, exon_boundary1, exon_boundary2) IN (
    ('+', '+', 'right_boundary', 'left_boundary'), ('+', '-', 'right_boundary', 'right_boundary'),
    ('-', '+', 'left_boundary', 'left_boundary'), ('-', '-', 'left_boundary', 'right_boundary'))
    THEN 'both'
  WHEN exon_boundary1 LIKE '%_boundary' AND exon_boundary2 NOT LIKE '%_boundary' THEN '5prime'
  WHEN exon_boundary1 NOT LIKE '%_boundary' AND exon_boundary2 LIKE '%_boundary' THEN '3prime'
  ELSE 'no_match' END AS exon_boundary
FROM pairs
""")
def combined_boundary(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "sample", "bpid", "exon_ord1", "exon_ord2",
        B.combined_boundary(
            F.col("strand1"), F.col("strand2"), F.col("exon_boundary1"), F.col("exon_boundary2")
        ).alias("exon_boundary"),
    )


@query("frame_class", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS}, {_FRAMES}, {_PAIRS}
SELECT sample, bpid, exon_ord1, exon_ord2, CASE WHEN frame1 = -1 THEN 'no_frame'
  WHEN frame2 = -1 THEN 'neo_frame' WHEN frame1 = frame2 THEN 'in_frame'
  ELSE 'out_frame' END AS frame
FROM pairs
""")
def frame_class(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "sample", "bpid", "exon_ord1", "exon_ord2",
        B.frame_class(F.col("frame_at_bp1"), F.col("frame_at_bp2")).alias("frame"),
    )


@query("exon_cds_containment", "fx_exons fx_cds", """
WITH e AS (SELECT tx, ord, exon_no, start + CASE WHEN exon_no % 5 = 4 THEN 8 ELSE 0 END AS start,
                  stop FROM fx_exons),
c AS (SELECT tx, start, stop, row_number() OVER (PARTITION BY tx ORDER BY start, stop) - 1 AS i
      FROM fx_cds),
m AS (SELECT e.tx, c.i, c.start, c.start = e.start AND c.stop = e.stop AS fills
      FROM e JOIN c ON e.tx = c.tx AND c.start >= e.start AND c.stop <= e.stop),
kept AS (SELECT tx, string_agg(CAST(start AS VARCHAR), '|' ORDER BY start) AS kept,
                string_agg(concat('cds != exon at no ', i), '|' ORDER BY i)
                  FILTER (WHERE NOT fills) AS mismatches FROM m GROUP BY tx)
SELECT t.tx, coalesce(kept, '') AS kept, coalesce(mismatches, '') AS mismatches
FROM (SELECT DISTINCT tx FROM fx_exons) t LEFT JOIN kept k ON t.tx = k.tx
""")
def exon_cds_containment(spark, sf_dir):
    exons, cds = _model(spark, sf_dir)
    shifted = exons.withColumn(
        "start", F.col("start") + F.when(F.col("exon_no") % 5 == 4, 8).otherwise(0)
    )
    lists = A.transcript_arrays(shifted, ["start", "stop"], "exons").join(
        _cds_lists(cds), "transcript_id", "left"
    )
    none = F.array().cast("array<struct<start:bigint,stop:bigint,frame:int>>")
    segments = F.coalesce("cds", none)
    return lists.withColumn("cds", segments).select(
        F.col("transcript_id").alias("tx"),
        X.joined(X.cds_in_exons(F.col("exons"), F.col("cds")), "start").alias("kept"),
        F.array_join(X.cds_mismatch_flags(F.col("exons"), F.col("cds")), "|").alias("mismatches"),
    )


@query("transcript_arrays", "fx_exons fx_cds", """
SELECT e.tx, exon_no, cds_no, starts, stops FROM
  (SELECT tx, count(*) AS exon_no, string_agg(CAST(start AS VARCHAR), '|' ORDER BY start) AS starts,
          string_agg(CAST(stop AS VARCHAR), '|' ORDER BY start) AS stops
   FROM fx_exons GROUP BY tx) e
  JOIN (SELECT tx, count(*) AS cds_no FROM fx_cds GROUP BY tx) c ON e.tx = c.tx
""")
def transcript_arrays(spark, sf_dir):
    exons, cds = _model(spark, sf_dir)
    lists = A.transcript_arrays(exons, ["start", "stop"], "exons").join(
        _cds_lists(cds), "transcript_id"
    )
    return lists.select(
        F.col("transcript_id").alias("tx"),
        F.size("exons").cast("bigint").alias("exon_no"),
        F.size("cds").cast("bigint").alias("cds_no"),
        X.joined(F.col("exons"), "start").alias("starts"),
        X.joined(F.col("exons"), "stop").alias("stops"),
    )


@query("locus_range", "fx_exons", """
SELECT tx, concat(chrom, ':', min(start), ':', max(stop)) AS locus FROM fx_exons GROUP BY tx, chrom
""")
def locus_range(spark, sf_dir):
    exons, _ = _model(spark, sf_dir)
    lists = A.transcript_arrays(exons, ["start", "stop"], "exons", ["transcript_id", "chrom"])
    return lists.select(
        F.col("transcript_id").alias("tx"),
        X.locus_text(F.col("chrom"), F.col("exons")).alias("locus"),
    )


# Kept features in row form: the edge feature is the last (left) or first (right) reached.
_TRUNCATED = """
sides AS (SELECT DISTINCT h.pos, h.strand, h.tx FROM hits h),
reached AS (
  SELECT s.pos, s.strand, s.tx, side, e.start, e.stop,
         (s.strand = '+') = (side = 1) AS is_left,
         row_number() OVER (PARTITION BY s.pos, s.strand, s.tx, side ORDER BY
           CASE WHEN (s.strand = '+') = (side = 1) THEN -e.start ELSE e.start END) = 1 AS edge
  FROM (SELECT *, unnest([1, 2]) AS side FROM sides) s JOIN fx_exons e ON e.tx = s.tx
  WHERE CASE WHEN (s.strand = '+') = (side = 1) THEN e.start <= s.pos ELSE s.pos <= e.stop END),
kept AS (
  SELECT pos, strand, tx, side,
         CASE WHEN edge AND NOT is_left AND start <= pos THEN pos ELSE start END AS start,
         CASE WHEN edge AND is_left AND pos <= stop THEN pos ELSE stop END AS stop
  FROM reached
  WHERE NOT (edge AND is_left AND start = pos) AND NOT (edge AND NOT is_left AND stop = pos))
"""


_KEPT_FIELDS = {"exons": ["start", "stop"], "cds": ["start", "stop", "frame"]}


def _truncated(spark, sf_dir, keys, lists):
    """The feature lists of the transcripts hit, and what a breakpoint leaves of each list as
    the first (``ft1_``) and as the second partner (``ft2_``)."""
    sides = _hits(spark, sf_dir).select(*keys, "transcript_id").distinct()
    joined = skew_join(sides, shuffled(lists), ["transcript_id"], "inner", keys)
    return joined.withColumns({
        f"ft{i}_{name}": X.truncate_features(
            F.col(name), F.col("pos"), F.col("strand"), i == 2, fields)
        for i in (1, 2) for name, fields in _KEPT_FIELDS.items() if name in lists.columns
    })


@query("truncate_features", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS}, {_TRUNCATED}
SELECT pos, strand, tx, side, start, stop FROM kept
""")
def truncate_features(spark, sf_dir):
    exons, _ = _model(spark, sf_dir)
    lists = A.transcript_arrays(exons, _KEPT_FIELDS["exons"], "exons")
    kept = _truncated(spark, sf_dir, ["pos", "strand"], lists).select(
        "pos", "strand", F.col("transcript_id").alias("tx"), F.explode(F.array(
            F.struct(F.lit(1).alias("side"), F.col("ft1_exons").alias("f")),
            F.struct(F.lit(2).alias("side"), F.col("ft2_exons").alias("f")),
        )).alias("s"),
    )
    return kept.select("pos", "strand", "tx", "s.side", F.explode("s.f").alias("e")).select(
        "pos", "strand", "tx", "side", "e.start", "e.stop"
    )


# What a breakpoint leaves of a transcript as the first and as the second partner: exons and
# the coding segments inside them. ``late`` is of use on side 1 only.
_KEPT_AT = """
features AS MATERIALIZED (
  SELECT 'exon' AS kind, tx, start, stop FROM fx_exons
  UNION ALL SELECT 'cds', c.tx, c.start, c.stop FROM fx_cds c JOIN fx_exons e
    ON e.tx = c.tx AND c.start >= e.start AND c.stop <= e.stop),
places AS MATERIALIZED (
  SELECT *, (strand = '+') = (side = 1) AS is_left
  FROM (SELECT chrom, pos, strand, tx, max(frame_at_bp) AS frame, unnest([1, 2]) AS side
        FROM framed GROUP BY chrom, pos, strand, tx) t),
cut AS (
  SELECT chrom, pos, strand, tx, side, kind, start AS from0, stop AS to0, edge, is_left,
         CASE WHEN edge AND NOT is_left AND start <= pos THEN pos ELSE start END AS start,
         CASE WHEN edge AND is_left AND pos <= stop THEN pos ELSE stop END AS stop
  FROM (SELECT p.*, kind, start, stop, row_number() OVER (
               PARTITION BY chrom, pos, strand, p.tx, side, kind
               ORDER BY CASE WHEN is_left THEN -start ELSE start END,
                        CASE WHEN is_left THEN -stop ELSE stop END) = 1 AS edge
        FROM places p JOIN features f ON f.tx = p.tx
        WHERE CASE WHEN is_left THEN start <= pos ELSE pos <= stop END) r
  WHERE NOT (edge AND is_left AND start = pos) AND NOT (edge AND NOT is_left AND stop = pos)),
told AS MATERIALIZED (
  SELECT chrom, pos, strand, tx, side, bool_or(kind = 'exon' AND start <= pos AND pos <= stop) AS inside,
         bool_or(kind = 'cds') AS coding,
         CASE WHEN strand = '+'
              THEN list(stop ORDER BY from0, to0, edge) FILTER (WHERE kind = 'cds')[-1] < pos
              ELSE list(start ORDER BY from0, to0, NOT edge) FILTER (WHERE kind = 'cds')[1] > pos END AS late
  FROM cut GROUP BY chrom, pos, strand, tx, side),
kept_at AS MATERIALIZED (
  SELECT concat(p.chrom, ':', p.pos, ':', p.strand) AS bp, p.side, list({'tx': p.tx, 'frame': frame,
         'inside': coalesce(inside, false), 'coding': coalesce(coding, false), 'late': coalesce(late, false)}) AS hits
  FROM places p LEFT JOIN told t ON t.chrom = p.chrom AND t.pos = p.pos AND t.strand = p.strand
    AND t.tx = p.tx AND t.side = p.side
  GROUP BY ALL)
"""


def _kept_at(spark, sf_dir, side):
    """What the breakpoints leave of their transcripts as partner ``side``, and the frame.

    Of the kept features only those that a comment asks for go on: the exons at the
    breakpoint, and one coding segment where there are any.
    """
    exons, cds = _model(spark, sf_dir)
    lists = A.transcript_arrays(exons, _KEPT_FIELDS["exons"], "exons").join(
        shuffled(_cds_lists(cds)), "transcript_id", "left"
    )
    none = F.array().cast("array<struct<start:bigint,stop:bigint,frame:int>>")
    lists = lists.withColumn("cds", X.cds_in_exons(F.col("exons"), F.coalesce("cds", none)))
    kept = _truncated(spark, sf_dir, ["chrom", "pos", "strand"], lists)
    pos, strand, kept_cds = F.col("pos"), F.col("strand"), F.col(f"ft{side}_cds")
    return kept.select(
        "chrom", "pos", "strand", "transcript_id",
        X.frame_at(F.col("cds"), pos, strand).alias("frame_at_bp"),
        X.after_cds_end(kept_cds, pos, strand).alias("late"),
        F.filter(f"ft{side}_exons", lambda e: (e["start"] <= pos) & (pos <= e["stop"])).alias("exons"),
        F.slice(kept_cds, 1, 1).alias("cds"),
    )


@query("filter_comment", "fx_calls fx_exons fx_cds", f"""
WITH {_HITS}, {_FRAMES}, {_KEPT_AT},
fusions AS MATERIALIZED (
  SELECT DISTINCT pos1, strand1, pos2, strand2, bp1, bp2 FROM fx_calls),
first_side AS MATERIALIZED (
  SELECT f.*, unnest(hits) AS a FROM fusions f JOIN kept_at ON bp = bp1 AND side = 1),
both_sides AS MATERIALIZED (
  SELECT f.*, unnest(hits) AS b FROM first_side f JOIN kept_at ON bp = bp2 AND side = 2),
texts AS (
  SELECT *, concat_ws('|', CASE WHEN a.late THEN 'bp1 after cds end' END,
           CASE WHEN NOT a.coding THEN 'no ft1 cds' END,
           CASE WHEN NOT b.coding AND a.frame <> -1 AND a.frame = b.frame THEN 'no ft2 cds' END,
           CASE WHEN NOT a.inside THEN 'bp1 not in exons' END,
           CASE WHEN NOT b.inside THEN 'bp2 not in exons' END) AS t FROM both_sides)
SELECT pos1 AS pos, strand1 AS strand, a.tx AS tx, pos2, strand2, b.tx AS tx2,
       CASE WHEN t = '' THEN 'pass' ELSE t END AS filter_comment FROM texts
""")
def filter_comment(spark, sf_dir):
    """Every fusion transcript: the first partner, the second one and the comment."""
    places = [f"{name}{i}" for i in (1, 2) for name in ("chrom", "pos", "strand")]
    fusions = view(spark, sf_dir, "fx_calls").select(*places).distinct()
    first = A.pair_sides(fusions, _kept_at(spark, sf_dir, 1), 1, places)
    pairs = A.pair_sides(first, _kept_at(spark, sf_dir, 2), 2, [*places, "transcript_id1"])
    c = F.col
    return pairs.select(
        c("pos1").alias("pos"), c("strand1").alias("strand"), c("transcript_id1").alias("tx"),
        "pos2", "strand2", c("transcript_id2").alias("tx2"),
        X.filter_comment(
            c("late1"), c("cds1"), c("cds2"), B.frame_class(c("frame_at_bp1"), c("frame_at_bp2")),
            c("exons1"), c("pos1"), c("exons2"), c("pos2"),
        ).alias("filter_comment"),
    )


@query("exon_prefix_sum", "fx_exons", """
WITH sums AS (
  SELECT tx, start, stop, 20 + tx % 90 AS n,
         coalesce(sum(stop - start) OVER (PARTITION BY tx ORDER BY start
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before,
         coalesce(sum(stop - start) OVER (PARTITION BY tx ORDER BY start DESC
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS behind
  FROM fx_exons)
SELECT tx, string_agg(CAST(start AS VARCHAR), '|' ORDER BY start) FILTER (WHERE before < n)
         AS leading_starts,
       string_agg(CAST(stop AS VARCHAR), '|' ORDER BY start) FILTER (WHERE behind < n)
         AS trailing_stops
FROM sums GROUP BY tx
""")
def exon_prefix_sum(spark, sf_dir):
    exons, _ = _model(spark, sf_dir)
    lists = A.transcript_arrays(exons, ["start", "stop"], "exons")
    n = 20 + F.col("transcript_id") % 90
    return lists.select(
        F.col("transcript_id").alias("tx"),
        X.joined(X.leading_features(F.col("exons"), n), "start").alias("leading_starts"),
        X.joined(X.trailing_features(F.col("exons"), n), "stop").alias("trailing_stops"),
    )


@query("tsl_filter", "fx_exons", """
WITH t AS (SELECT DISTINCT tx, gene FROM fx_exons),
tsl AS (SELECT p_partkey AS tx, CASE WHEN p_size % 6 = 0 THEN 'NA'
               WHEN p_size % 7 = 0 THEN concat(p_size % 6, ' (assigned to previous version 1)')
               ELSE CAST(p_size % 6 AS VARCHAR) END AS tsl FROM part WHERE p_type <> 'SMALL'),
leveled AS (SELECT t.tx, t.gene, coalesce(tsl, '6') AS tsl FROM t LEFT JOIN tsl ON t.tx = tsl.tx)
SELECT a.tx AS tx1, b.tx AS tx2, a.tsl AS tsl1, b.tsl AS tsl2
FROM leveled a JOIN leveled b ON b.gene = a.gene + 1
WHERE a.tsl NOT IN ('4', '5', 'NA') AND b.tsl NOT IN ('4', '5', 'NA')
""")
def tsl_filter(spark, sf_dir):
    size = F.col("p_size") % 6
    levels = view(spark, sf_dir, "part").filter(F.col("p_type") != "SMALL").select(
        F.col("p_partkey").alias("transcript_id"),
        F.when(size == 0, "NA")
        .when(F.col("p_size") % 7 == 0, F.concat(size.cast("string"), F.lit(" (assigned to previous version 1)")))
        .otherwise(size.cast("string")).alias("tsl"),
    )
    exons, _ = _model(spark, sf_dir)
    leveled = A.with_tsl(exons.select("transcript_id", "gene").distinct(), levels)
    first = leveled.select(
        F.col("transcript_id").alias("tx1"), (F.col("gene") + 1).alias("gene"), F.col("tsl").alias("tsl1")
    )
    second = leveled.select(F.col("transcript_id").alias("tx2"), "gene", F.col("tsl").alias("tsl2"))
    return first.join(second, "gene").filter(
        A.passes_tsl(F.lit(False), F.col("tsl1"), F.col("tsl2"), "4,5,NA")
    ).drop("gene")


@query("tx_flags", "fx_exons fx_cds", """
WITH c AS (SELECT c.*, row_number() OVER (PARTITION BY c.tx ORDER BY c.start) - 1 AS i,
                  e.start AS estart, e.stop AS estop, count(*) OVER (PARTITION BY c.tx) AS n
           FROM fx_cds c JOIN fx_exons e ON e.tx = c.tx AND e.exon_no = c.exon_no),
edge AS (SELECT tx, gene, strand, CASE WHEN strand = '+' THEN min_by(frame, start)
                ELSE max_by(frame, start) END AS f FROM fx_cds GROUP BY tx, gene, strand),
flags AS (SELECT gene, concat('cds != exon at no ', i) AS flag FROM c
            WHERE start <> estart OR stop <> estop
          UNION SELECT gene, 'Only 1 cds in bp1' FROM c WHERE n = 1
          UNION SELECT gene, 'cds start > 0' FROM edge WHERE f > 0)
SELECT gene, string_agg(flag, '|' ORDER BY flag) AS flags FROM flags GROUP BY gene
""")
def tx_flags(spark, sf_dir):
    exons, cds = _model(spark, sf_dir)
    lists = A.transcript_arrays(
        exons, ["start", "stop"], "exons", ["transcript_id", "gene", "strand"]
    ).join(_cds_lists(cds), "transcript_id")
    flagged = lists.select(
        "gene",
        F.array_compact(F.concat(
            X.cds_mismatch_flags(F.col("exons"), F.col("cds")),
            F.array(
                F.when(F.size("cds") == 1, "Only 1 cds in bp1"),
                F.when(X.frame_at_start(F.col("cds"), F.col("strand")) > 0, "cds start > 0"),
            ),
        )).alias("flags"),
    )
    return A.collect_flags(flagged, ["gene"]).select("gene", F.array_join("flags", "|").alias("flags"))


_RANGES = """
SELECT chrom, start, stop + CASE WHEN tx % 50 = 0 THEN 150000 WHEN tx % 3 = 0 THEN 20 ELSE 0 END
         AS stop FROM fx_exons
"""


@query("merge_intervals", "fx_exons", f"""
WITH ranges AS ({_RANGES}),
heads AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY chrom ORDER BY start, stop
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS head FROM ranges),
islands AS (SELECT *, sum(head) OVER (PARTITION BY chrom ORDER BY start, stop
              ROWS UNBOUNDED PRECEDING) AS island FROM heads)
SELECT chrom, min(start) AS start, max(stop) AS stop FROM islands GROUP BY chrom, island
""")
def merged_regions(spark, sf_dir):
    exons, _ = _model(spark, sf_dir)
    longer = F.when(F.col("transcript_id") % 50 == 0, 150000).when(
        F.col("transcript_id") % 3 == 0, 20
    ).otherwise(0)
    texts = exons.select(
        F.concat_ws(":", "chrom", F.col("start"), F.col("stop") + longer).alias("range")
    )
    return merge_intervals(parse_ranges(texts, "range"))


@query("feature_type_counts", "fx_exons fx_cds", """
SELECT 'exon' AS type, count(*) AS n FROM fx_exons
UNION ALL SELECT 'CDS', count(*) FROM fx_cds
UNION ALL SELECT 'transcript', count(DISTINCT tx) FROM fx_exons
""")
def feature_type_counts(spark, sf_dir):
    exons, cds = _model(spark, sf_dir)
    features = (
        exons.select(F.lit("exon").alias("type"))
        .unionByName(cds.select(F.lit("CDS").alias("type")))
        .unionByName(
            exons.select("transcript_id").distinct().select(F.lit("transcript").alias("type"))
        )
    )
    return A.feature_type_counts(features)


@query("feature_lengths", "fx_exons", """
SELECT tx, exon_no, stop - start + 1 AS length FROM fx_exons
""")
def feature_lengths(spark, sf_dir):
    exons = view(spark, sf_dir, "fx_exons").select("tx", "exon_no", "start", "stop")
    return A.feature_lengths(exons).drop("start", "stop")


@query("feature_hierarchy", "fx_exons", """
WITH genes AS (
  SELECT gene,
         CASE gene % 4 WHEN 0 THEN concat('Name', gene) WHEN 1 THEN concat('gn', gene)
              WHEN 2 THEN concat('GID', gene) ELSE '' END AS gene_name,
         CASE gene % 3 WHEN 0 THEN 'protein_coding' WHEN 1 THEN 'lncRNA' ELSE '' END AS gene_biotype,
         CASE WHEN gene % 2 = 0 THEN concat('a b', gene, ' c') ELSE 'NA' END AS description
  FROM (SELECT DISTINCT CAST(floor(p_partkey / 2) AS BIGINT) AS gene FROM part) g)
SELECT concat('transcript:T', p_partkey) AS transcript_id,
       CASE WHEN p_size % 3 < 2 THEN p_type ELSE '' END AS trans_biotype,
       gene_name, gene_biotype, description
FROM part JOIN genes ON gene = CAST(floor(p_partkey / 2) AS BIGINT)
""")
def feature_hierarchy(spark, sf_dir):
    part = view(spark, sf_dir, "part").withColumn("gene", F.floor(F.col("p_partkey") / 2))

    def attributes(*entries):
        pairs = F.array(*[
            F.when(condition, F.struct(F.lit(key).alias("k"), F.array(value).alias("v")))
            for key, condition, value in entries
        ])
        return F.map_from_entries(F.array_compact(pairs))

    g, size = F.col("gene"), F.col("p_size") % 3
    transcripts = part.select(
        F.concat(F.lit("transcript:T"), "p_partkey").alias("id"), F.lit("mRNA").alias("type"),
        F.concat(F.lit("gene:G"), g).alias("parent"),
        attributes(
            ("biotype", size == 0, F.col("p_type")), ("transcript_biotype", size == 1, F.col("p_type"))
        ).alias("attributes"),
    )
    genes = part.select("gene").distinct().select(
        F.concat(F.lit("gene:G"), g).alias("id"), F.lit("gene").alias("type"),
        F.lit(None).cast("string").alias("parent"),
        attributes(
            ("Name", g % 4 == 0, F.concat(F.lit("Name"), g)),
            ("gene_name", g % 4 < 2, F.concat(F.lit("gn"), g)),
            ("gene_id", g % 4 < 3, F.concat(F.lit("GID"), g)),
            ("biotype", g % 3 == 0, F.lit("protein_coding")),
            ("gene_biotype", g % 3 < 2, F.lit("lncRNA")),
            ("description", g % 2 == 0, F.concat(F.lit("a;b"), g, F.lit(";c"))),
        ).alias("attributes"),
    )
    return A.feature_hierarchy(transcripts.unionByName(genes))


_GTF_TEXT = """concat('gene_id "G', floor(p_partkey / 2), '"; transcript_id "',
  CASE WHEN p_size % 2 = 0 THEN 'ENST' ELSE 'MGP_' END, floor(p_partkey / 3), '"; gene_biotype "', p_brand, '"; ',
  CASE WHEN p_size % 3 = 0 THEN concat('transcript_biotype "', p_type, '"; ') ELSE '' END,
  CASE WHEN p_size % 5 > 0 THEN concat('transcript_support_level "', p_size % 5, '";') ELSE '' END)"""


def _gtf_rows(spark, sf_dir):
    whole = {f"floor(p_partkey / {n})": f"CAST(floor(p_partkey / {n}) AS STRING)" for n in (2, 3)}
    text = _GTF_TEXT
    for plain, cast in whole.items():
        text = text.replace(plain, cast)
    return view(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("_ord"), F.expr(text).alias("attributes")
    )


_GTF_CHECK = _GTF_TEXT.replace("floor(p_partkey / 2)", "CAST(floor(p_partkey / 2) AS BIGINT)").replace(
    "floor(p_partkey / 3)", "CAST(floor(p_partkey / 3) AS BIGINT)"
)


@query("attr_extract", "", f"""
WITH rows AS (SELECT p_partkey AS tx, {_GTF_CHECK} AS a FROM part)
SELECT tx, regexp_extract(a, 'transcript_id "([^"]*)"', 1) AS transcript_id,
       coalesce(nullif(regexp_extract(a, 'transcript_biotype "([^"]*)"', 1), ''), 'NA') AS trans_biotype,
       coalesce(nullif(regexp_extract(a, 'transcript_support_level "([^"]*)"', 1), ''), 'NA') AS tsl,
       true AS known_prefix
FROM rows
""")
def attr_extract(spark, sf_dir):
    text = F.col("attributes")
    return _gtf_rows(spark, sf_dir).select(
        F.col("_ord").alias("tx"),
        gtf_value(text, "transcript_id").alias("transcript_id"),
        gtf_value(text, "transcript_biotype").alias("trans_biotype"),
        gtf_value(text, "transcript_support_level").alias("tsl"),
        has_known_prefix(gtf_value(text, "transcript_id")).alias("known_prefix"),
    )


@query("tsl_table", "", f"""
WITH rows AS (SELECT p_partkey AS tx, {_GTF_CHECK} AS a FROM part),
parsed AS (SELECT tx, regexp_extract(a, 'transcript_id "([^"]*)"', 1) AS transcript_id,
  coalesce(nullif(regexp_extract(a, 'transcript_biotype "([^"]*)"', 1), ''), 'NA') AS trans_biotype,
  regexp_extract(a, 'gene_biotype "([^"]*)"', 1) AS gene_biotype,
  coalesce(nullif(regexp_extract(a, 'transcript_support_level "([^"]*)"', 1), ''), 'NA') AS tsl
  FROM rows)
SELECT transcript_id, trans_biotype, gene_biotype, tsl FROM (
  SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY tx) AS rn FROM parsed) t
WHERE rn = 1
""")
def tsl_table(spark, sf_dir):
    return tsl_from_attributes(_gtf_rows(spark, sf_dir))


# GFF3 lines: loci over genes, genes over transcripts, transcripts over exons, exons over
# segments. Some transcripts have two genes, some exons two transcripts.
_GFF_PARTS = {
    "locus": ("concat('ID=locus:', gene // 10, ';Name=a%3Bb')", "locus"),
    "gene": ("concat('ID=gene:G', gene, ';Parent=locus:', gene // 10)", "gene"),
    "mRNA": (
        "concat('ID=transcript:T', p_partkey, ';Parent=gene:G', gene, "
        "CASE WHEN p_size % 4 = 0 THEN concat(',gene:G', gene + 1) ELSE '' END)", "tx"),
    "exon": (
        "concat('ID=exon:E', p_partkey, ';Parent=transcript:T', p_partkey, "
        "CASE WHEN p_size % 5 = 0 THEN concat(',transcript:T', p_partkey + 1) ELSE '' END)", "tx"),
    "CDS": ("concat('ID=CDS:C', p_partkey, ';Parent=exon:E', p_partkey)", "tx"),
}


def _gff_lines(places: dict[str, str]) -> str:
    rows = []
    for number, (kind, (attributes, level)) in enumerate(_GFF_PARTS.items()):
        only = {"locus": "WHERE gene % 10 = 0 AND p_partkey % 2 = 0",
                "gene": "WHERE p_partkey % 2 = 0", "tx": ""}[level]
        rows.append(
            f"SELECT p_partkey * 8 + {number} AS ord, concat_ws({places['tab']}, '1', 'x', "
            f"'{kind}', CAST(p_partkey * 100 AS {places['text']}), "
            f"CAST(p_partkey * 100 + 50 AS {places['text']}), '.', '+', '0', {attributes}) "
            f"AS value FROM numbered {only}")
    return " UNION ALL ".join(rows)


@query("gff_ancestors", "", f"""
WITH RECURSIVE numbered AS (SELECT p_partkey, p_size, p_partkey // 2 AS gene FROM part),
lines AS ({_gff_lines({'tab': 'chr(9)', 'text': 'VARCHAR'})}),
edges AS (
  SELECT regexp_extract(value, 'ID=([^;]*)', 1) AS id,
         unnest(string_split(regexp_extract(value, 'Parent=([^;]*)', 1), ',')) AS up FROM lines),
above AS (
  SELECT id, up AS ancestor, 1 AS depth FROM edges WHERE up <> ''
  UNION SELECT a.id, e.up, a.depth + 1 FROM above a JOIN edges e ON e.id = a.ancestor WHERE e.up <> '')
SELECT id, ancestor, CAST(min(depth) AS INTEGER) AS depth FROM above GROUP BY id, ancestor
""")
def gff_ancestors(spark, sf_dir):
    part = view(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_size", "CAST(floor(p_partkey / 2) AS BIGINT) AS gene")
    text = _gff_lines({"tab": "char(9)", "text": "STRING"}).replace(
        "gene // 10", "CAST(floor(gene / 10) AS BIGINT)")
    lines = spark.sql(text.replace("FROM numbered", "FROM {numbered}"), numbered=part)
    return A.ancestors(parse_gff3(lines.withColumnRenamed("ord", "_ord")))
