"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Everything here is DataFrame code. A sketch has three rows of cells; a digest goes to one cell
of each row, and a cell keeps how many digests it took and the XOR of them and of their check
codes. Subtracting the cells of two texts leaves their differing digests, which peeling
recovers: a cell with one digest left gives it away and is then taken out of the other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored

HASHES = 3
WORDS = 8  # a power of two; of so many different words one ends a piece
BASE = 4  # cells in a row of the printed fingerprint
ROUNDS = 2
FEW = 100_000  # so many ids to do again, and those after them, are broadcast; more are shuffled
_NO_ID = -(1 << 63)


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of the text's paragraphs.

    A line ends a paragraph and so does, on average, one of ``WORDS`` words, chosen by the
    word's own hash. Texts of one line have several paragraphs, and a change moves no cut but
    its own, whatever the lengths of the texts are. White space within a line does not count.
    """
    def with_cuts(tokens: Column) -> Column:
        line = F.lit("\n")
        ends = F.filter(
            F.transform(tokens, lambda token, i: F.when(
                token.startswith(line) | (F.xxhash64(token).bitwiseAND(WORDS - 1) == 0)
                | (i == F.size(tokens) - 1), i)),
            lambda end: end.isNotNull())
        return F.struct(tokens.alias("tokens"), ends.alias("ends"))

    def digests(cut: Column) -> Column:
        tokens, ends = cut["tokens"], cut["ends"]

        def digest(end: Column, k: Column) -> Column:
            start = F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
            stop = F.when(F.get(tokens, end).startswith(F.lit("\n")), end).otherwise(end + 1)
            piece = F.slice(tokens, start + 1, stop - start)
            return F.when(stop > start, F.xxhash64(piece))

        return F.array_distinct(F.array_compact(F.transform(ends, digest)))

    # arrays of one element: a lambda's argument is worked out once
    tokens = F.array(F.regexp_extract_all(text, F.lit(r"\S++|\n\s*+"), F.lit(0)))
    return F.transform(F.transform(tokens, with_cuts), digests)[0]


def printed_sketch(digests: Column) -> Column:
    """The cells of a small sketch as text: count and XOR of every cell, in order."""
    def cell(row: int, place: int) -> Column:
        inside = F.filter(
            digests, lambda d: F.shiftrightunsigned(d, 2 * row).bitwiseAND(BASE - 1) == place)
        total = F.aggregate(inside, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(d))
        return F.concat(F.hex(F.size(inside)), F.lit(":"), F.lower(F.hex(total)))

    return F.concat_ws(".", *(cell(row, place) for row in range(HASHES) for place in range(BASE)))


def successors(docs: DataFrame) -> DataFrame:
    """(id, previous, reach) per distinct id: the id whose next document this is, in
    descending order of ids and from the last to the first, and how many characters of it
    the rows of ``previous`` need at most. Sorted by ranges; only the ends of the ranges,
    one row each, meet in one task."""
    ids = docs.groupBy("id").agg(F.max(F.floor(F.length("text") / 3)).alias("reach"))
    placed = stored(
        ids.orderBy(F.desc("id")).withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    here = placed.select(
        (F.col("at") + 1).alias("at"), F.col("id").alias("previous"), "reach")
    inner = placed.select("id", "at").join(here, "at").select("id", "previous", "reach")
    last = F.struct("at", "id", "reach")
    ends = placed.groupBy("part").agg(
        F.min(F.struct("at", "id")).alias("first"), F.max(last).alias("last"))
    order = Window.orderBy("part")
    very_last = F.max("last").over(Window.partitionBy())
    borders = ends.withColumn(
        "before", F.coalesce(F.lag("last").over(order), very_last)
    ).select(F.col("first.id").alias("id"), F.col("before.id").alias("previous"),
             F.col("before.reach").alias("reach"))
    return inner.unionByName(borders)


def versions(docs: DataFrame, chain: DataFrame, parts: int) -> DataFrame:
    """Per row: its text, its edited text and the digests of both and of the next text.

    Of rows with one id the greatest text is the next text of the id before.
    """
    own = docs.repartition(parts, "id")
    following = (
        own.join(chain.repartition(parts, "id"), "id")
        .select(F.col("previous").alias("id"), F.struct(
            F.expr("substring(text, 1, cast(reach as int))").alias("head"),
            paragraph_digests(F.col("text")).alias("digests"),
            F.xxhash64("text").alias("code")).alias("next"))
        .repartition(parts, "id")
    )
    repeated = docs.groupBy("id").count().filter("count > 1")
    if not repeated.isEmpty():
        following = following.groupBy("id").agg(F.max_by("next", "next.code").alias("next"))
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), size - third), F.substring("next.head", F.lit(1), third))
    return (
        own.join(following, "id")
        .select("id", "text", "next.digests", edited.alias("edited"))
        .select(
            "id", F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            paragraph_digests(F.col("text")).alias("of_text"),
            paragraph_digests(F.col("edited")).alias("of_edited"),
            F.col("digests").alias("of_next"),
        )
    )


def differences(rows: DataFrame, seed: int, grow: int) -> DataFrame:
    """Likeness of each row's text to its edited and to its next text.

    Both comparisons subtract sketches whose rows have at least ``grow`` times as many cells
    as the texts have digests, and peel row by row. ``failed`` tells that a cell was left.
    The cells of a text stay in the partition that holds it, so nothing is shuffled.
    """
    def slots(other: Column) -> Column:
        total = F.size("of_text") + F.size(other)
        return (F.pow(F.lit(2), F.ceil(F.log2(F.greatest(total, F.lit(16))))) * grow).cast("long")

    def entries(kind: int, digests: Column, sign: int) -> Column:
        return F.transform(digests, lambda d: F.struct(
            F.lit(kind).alias("kind"), d.alias("digest"), F.lit(sign).cast("long").alias("sign")))

    head = F.array(F.struct(
        F.lit(2).alias("kind"), F.lit(0).cast("long").alias("digest"),
        F.lit(0).cast("long").alias("sign")))
    info = F.struct(
        "n_chars", "edited_sha256",
        printed_sketch(F.col("of_text")).alias("fingerprint"),
        printed_sketch(F.col("of_edited")).alias("edited_fingerprint"),
        F.size("of_text").alias("size"),
    )

    def place(row: Column, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest, row, F.lit(seed)), F.col("slots"))

    def check(digest: Column) -> Column:
        return F.xxhash64(digest, F.lit(seed + 1))

    one_row = ["id", "number", "info", "kind", "slots"]
    cells = (
        rows.withColumn("number", F.monotonically_increasing_id())
        .withColumn("info", info)
        .withColumn("to_edited", slots(F.col("of_edited")))
        .withColumn("to_next", slots(F.col("of_next")))
        .select("id", "number", "info", "to_edited", "to_next", F.explode(F.concat(
            head, entries(0, F.col("of_text"), 1), entries(0, F.col("of_edited"), -1),
            entries(1, F.col("of_text"), 1), entries(1, F.col("of_next"), -1))).alias("entry"))
        .select(
            "id", "number", F.when(F.col("entry.kind") == 2, F.col("info")).alias("info"),
            "entry.kind", "entry.digest", "entry.sign",
            F.when(F.col("entry.kind") == 0, F.col("to_edited"))
            .otherwise(F.col("to_next")).alias("slots"),
            F.explode(F.when(F.col("entry.kind") == 2, F.array(F.lit(0)))
                      .otherwise(F.array(*map(F.lit, range(HASHES))))).alias("row"))
        .select(
            *one_row, "row", place(F.col("row"), F.col("digest")).alias("place"),
            F.col("sign").alias("count"), "digest", check(F.col("digest")).alias("code"))
    )

    def summed(cells: DataFrame) -> DataFrame:
        total = cells.groupBy(*one_row, "row", "place").agg(
            F.sum("count").alias("count"), F.bit_xor("digest").alias("digest"),
            F.bit_xor("code").alias("code"))
        return total.filter((F.col("kind") == 2) | (F.col("count") != 0)
                            | (F.col("digest") != 0) | (F.col("code") != 0))

    def entry(row: Column, at: Column, count: Column, digest: Column, code: Column) -> Column:
        return F.struct(row.cast("int").alias("row"), at.alias("place"), count.alias("count"),
                        digest.alias("digest"), code.alias("code"))

    zero = F.lit(0).cast("long")
    count, digest, code = F.col("count"), F.col("digest"), F.col("code")
    cells = summed(cells)
    for turn in range(ROUNDS * HASHES):
        row = turn % HASHES
        pure = (F.col("kind") < 2) & (F.col("row") == row) & (F.abs("count") == 1) & (
            code == check(digest))
        # rows 3 and 4 count what was recovered of the one and of the other text
        peeled = F.array(
            entry(F.when(count > 0, 3).otherwise(4), zero, F.lit(1).cast("long"), zero, zero),
            *(entry(F.lit(other), place(F.lit(other), digest), -count, digest, code)
              for other in range(HASHES) if other != row))
        same = F.array(entry(F.col("row"), F.col("place"), count, digest, code))
        cells = summed(cells.select(
            *one_row, F.explode(F.when(pure, peeled).otherwise(same)).alias("cell")
        ).select(*one_row, "cell.*"))

    def recovered(kind: int, row: int) -> Column:
        chosen = (F.col("kind") == kind) & (F.col("row") == row)
        return F.coalesce(F.sum(F.when(chosen, F.col("count"))), zero)

    totals = cells.groupBy("id", "number").agg(
        F.max("info").alias("info"),
        *(recovered(kind, row).alias(f"only_{kind}_{row}") for kind in (0, 1) for row in (3, 4)),
        F.count_if((F.col("kind") < 2) & (F.col("row") < HASHES)).alias("left"),
    )

    def likeness(kind: int) -> Column:
        common = F.col("info.size") - F.col(f"only_{kind}_3")
        union = F.col("info.size") + F.col(f"only_{kind}_4")
        return F.when(union == 0, 1.0).otherwise(common / union)

    return totals.select(
        "id", "info.n_chars", "info.edited_sha256", "info.fingerprint",
        "info.edited_fingerprint", likeness(0).alias("near_edited"),
        likeness(1).alias("near_next"), (F.col("left") > 0).alias("failed"),
    )


def fingerprints(docs: DataFrame, grow: int = 4) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The edited text has its last third (rounded down) of code points replaced by the first as
    many, or all, of the next document in descending order of ids; after the last comes the
    first. Likeness is the Jaccard similarity of the paragraph digests, from the differences
    that peeling recovers; two texts without words are alike. A row whose sketch cannot be
    peeled is done again with four times the cells and other hashes until it can.

    Null texts count as empty, a null id is below every other. Rows that repeat an id each
    have a result, with the greatest of the next id's texts (by hash) as the next one. An
    empty table gives an empty result; no column but ``doc_id`` and ``text`` is read.
    """
    known = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    chain = stored(successors(known))
    done = stored(differences(versions(known, chain, parts), 0, grow))
    seed = 0
    while True:
        failed = done.filter("failed").select("id").distinct()
        count = failed.count()
        if not count:
            break

        def listed(ids: DataFrame, few: bool = count <= FEW) -> DataFrame:
            return F.broadcast(ids) if few else ids

        seed, grow = seed + 2, 4 * grow
        # the failed rows and the rows that hold their next texts
        previous = failed.withColumnRenamed("id", "previous")
        links = stored(chain.join(listed(previous), "previous", "left_semi"))
        wanted = failed.union(links.select("id")).distinct()
        again = versions(known.join(listed(wanted), "id", "left_semi"), links, parts)
        redone = differences(again.join(listed(failed), "id", "left_semi"), seed, grow)
        done = stored(done.join(listed(failed), "id", "left_anti").unionByName(redone))
    return done.select(
        F.nullif("id", F.lit(_NO_ID)).alias("doc_id"), "n_chars", "edited_sha256",
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
