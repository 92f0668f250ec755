"""How far the sources of a language stand apart in their words, by run-length columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored
from fusion_spark.llm.words import slices

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200  # ranks reported of part "term"
BLOCK_BITS = 10  # term profiles of a block of the vocabulary, as a power of two
PART = 64  # sources of a language whose pairs one group works on
HELD = 200_000  # distinct terms counted in a task before their counts are sent on
# ASCII letters in lower case and all bytes of other characters; the rest parts terms
LETTERS = bytes(
    code if code >= 128 or chr(code).islower() else code + 32 if chr(code).isupper() else 32
    for code in range(256)
)


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, count, docs): occurrences and documents, summed within a task."""

    def send(known: dict) -> pa.RecordBatch:
        rows = [(*group, term, *pair) for group, terms in known.items()
                for term, pair in terms.items()]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.binary()).cast(pa.string()),
             pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
            names=["lang", "source", "term", "count", "docs"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        size = 0
        for batch in slices(batches):
            for lang, source, text in zip(
                *(batch.column(name).to_pylist() for name in ("lang", "source", "text")),
                strict=True,
            ):
                terms = known.setdefault((lang, source), {})
                before = len(terms)
                for term, times in Counter(text.encode().translate(LETTERS).split()).items():
                    pair = terms.get(term)
                    if pair is None:
                        terms[term] = [times, 1]
                    else:
                        pair[0] += times
                        pair[1] += 1
                size += len(terms) - before
                if size > held:
                    yield send(known)
                    known, size = {}, 0
        if size:
            yield send(known)

    return docs.mapInArrow(
        run, "lang string, source string, term string, count long, docs long")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, cells) of each term in ``least_docs`` documents of its language.

    ``cells`` lists (source, count), by source: one entry per source that has the term.
    """
    counts = term_counts(docs).groupBy("lang", "term", "source").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    return (
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"),
             F.array_sort(F.collect_list(F.struct("source", "count"))).alias("cells"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term", "total", "cells")
    )


def share(count: str, total: str, terms: str) -> Column:
    """Smoothed share of a term in billionths, exact: decimals hold any count of a bigint."""
    return F.expr(
        f"1 + (cast({count} + 1 as decimal(20, 0)) * {SCALE}) div ({total} + {terms})")


def gap(p: np.ndarray, q: np.ndarray, width: np.ndarray) -> int:
    """Sum of width * floor((p - q)^2 / q); Python's integers take what 64 bits cannot."""
    value = (p - q) * (p - q) // q
    if float(value.max(initial=0)) * float(width.sum()) < 2.0 ** 62:
        return int(np.dot(value, width))
    return sum(map(int.__mul__, value.tolist(), width.tolist()))


def run_lengths(counts: np.ndarray) -> np.ndarray:
    """First place of every run of equal values."""
    return np.concatenate([[0], np.flatnonzero(np.diff(counts)) + 1])


def block_gaps(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """The gap of every pair of sources over one block of the ordered vocabulary.

    Each source's counts in the block become runs (first place, share). A pair's boundaries
    are put together, and between two of them both shares are constant.
    """
    number = {name: i for i, name in enumerate(groups["source"].to_pylist())}
    sizes = [total + terms for total, terms in zip(
        groups["total"].to_pylist(), groups["terms"].to_pylist(), strict=True)]
    mine = groups["mine"].to_pylist()
    places, place = np.unique(cells["place"].to_numpy(), return_inverse=True)
    widths = np.zeros(len(places), np.int64)
    widths[place] = cells["width"].to_numpy()
    until = np.concatenate([[0], np.cumsum(widths)])
    owner = np.fromiter(
        map(number.__getitem__, cells["source"].to_pylist()), np.int64, len(place))
    count = cells["count"].to_numpy()
    columns = []
    order = np.lexsort((place, owner))
    limits = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
    for source, size in enumerate(sizes if len(places) else []):
        own = order[limits[source]:limits[source + 1]]
        dense = np.zeros(len(places), np.int64)
        dense[place[own]] = count[own]
        begin = run_lengths(dense)
        shares = [1 + SCALE * (times + 1) // size for times in dense[begin].tolist()]
        columns.append((begin, np.array(shares, np.int64)))
    names, rows = list(number), []
    for source, own in enumerate(mine):
        for other in range(len(names)) if own else ():
            if other == source:
                continue
            value = 0
            if columns:
                (begin, p), (begin_other, q) = columns[source], columns[other]
                cuts = np.union1d(begin, begin_other)
                value = gap(
                    p[np.searchsorted(begin, cuts, "right") - 1],
                    q[np.searchsorted(begin_other, cuts, "right") - 1],
                    np.diff(until[np.append(cuts, len(places))]))
            rows.append((source, other, Decimal(value)))
    lang = groups["lang"][0].as_py()
    return pa.table({
        "lang": pa.array([lang] * len(rows), pa.string()),
        "source": pa.array([names[r[0]] for r in rows], pa.string()),
        "item": pa.array([names[r[1]] for r in rows], pa.string()),
        "gap": pa.array([r[2] for r in rows], pa.decimal128(38, 0)),
    })


def pair_gaps(terms: DataFrame, groups: DataFrame, part: int = PART) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language.

    Terms with the same count in every source become one profile with a width. Profiles are
    ordered by their counts, which brings equal counts of a source together, and cut into
    blocks. A group of the work is a block with the pairs of at most ``part`` sources; sums
    over the blocks are taken before the shuffle.
    """
    profiles = (
        terms.groupBy("lang", "cells").agg(F.count("*").alias("width"))
        .repartitionByRange("lang", "cells").sortWithinPartitions("lang", "cells")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("block", F.shiftright("at", BLOCK_BITS))
        .select("lang", "block", "width", F.col("at").bitwiseAND((1 << BLOCK_BITS) - 1).alias("place"),
                "cells")
    )
    profiles = stored(profiles)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    dealt = groups.withColumn("chunk", F.floor((rank - 1) / part))
    chunks = dealt.groupBy("lang").agg(F.max("chunk").alias("last"))
    work = (
        chunks.join(profiles.select("lang", "block").distinct(), "lang", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .withColumn("block", F.coalesce("block", F.lit(-1)))
    )
    sides = work.join(dealt, "lang").withColumn("mine", F.col("chunk") == F.col("part"))
    cells = (
        profiles.join(chunks, "lang")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .select("lang", "block", "part", "place", "width", F.inline("cells"))
    )
    key = ["lang", "block", "part"]
    found = cells.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(
        block_gaps, "lang string, source string, item string, gap decimal(38,0)")
    return found.groupBy("lang", "source", "item").agg(F.sum("gap").cast("long").alias("value"))


def source_divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    A language keeps the terms in at least ``least_docs`` of its documents. Each source of a
    language, and the language as a whole, gives each kept term a smoothed share in
    billionths; the gap from p to q is floor((p - q)^2 / q). Part ``pair`` ranks the other
    sources of the language by the gap summed over all kept terms, part ``term`` the ``top``
    terms that the source uses more than its language.

    Null text, lang and source count as ''. A source without a kept term has the share of
    count 0 everywhere; a language without one has gaps of 0; a language of one source has no
    pairs. Ties are ranked by item in UTF-8 order. Rows repeat as documents of their own, an
    empty table gives an empty result, other columns are not read.
    """
    read = docs.select(
        *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
          for name in ("lang", "source", "text")))
    terms = stored(kept_terms(read, least_docs))
    cells = terms.select("lang", "term", "total", F.inline("cells"))
    langs = terms.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.count("*").alias("terms"))
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = stored(
        read.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"])
    )
    group = Window.partitionBy("lang", "source")
    pairs = pair_gaps(terms, groups.drop("lang_total")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(group.orderBy(F.desc("value"), "item")).alias("rank"))
    above = (
        cells.withColumnRenamed("total", "all").join(groups, ["lang", "source"])
        .withColumn("p", share("count", "total", "terms"))
        .withColumn("q", share("all", "lang_total", "terms"))
        .filter("p > q")
        .withColumn("value", F.expr("((p - q) * (p - q)) div q"))
        .withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term")))
        .filter(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                "value", "rank")
    )
    return pairs.unionByName(above)
