"""Packing token pieces into sequences by shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored
from fusion_spark.llm.words import WordEncoder, slices, texts_of

SIZE = 2048
END = array("I", [1]).tobytes()
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, tokenizer_path: str, pattern: str, size: int = SIZE) -> DataFrame:
    """Token pieces of at most ``size`` ids per document; every document ends with id 1.

    All pieces of a document but its last are full. Null texts count as empty: one piece with
    the closing id alone.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(
            {"model": file.read(), "pattern": pattern}
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder.of(shared.value).encode
        for batch in slices(batches):
            ids: list = []
            rows: list[tuple[int, int, int, int]] = []
            names = batch.column("doc_id").to_pylist()
            for name, text in zip(names, texts_of(batch, "text"), strict=True):
                code = encode(text) + END
                tokens = len(code) // 4
                for start in range(0, tokens, size):
                    piece = code[4 * start:4 * (start + size)]
                    ids.append(name)
                    rows.append((start, len(piece) // 4, zlib.crc32(piece), tokens))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first placements: (length, first rank, pieces, first pack, offset).

    Lengths are placed longest first, each into the shortest packs that still take it, else
    into new packs. Packs with equal contents are consecutive numbers and are held as one
    pattern with a count, so the work follows the histogram (at most ``size`` lengths) and
    not the number of pieces. Within a placement, rank ``first rank + i`` goes to pack
    ``first pack + i`` at ``offset``.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    sums: list[int] = []
    placed = []
    packs = 0

    def add(total: int, group: tuple[int, int]) -> None:
        if total not in groups:
            groups[total] = []
            heapq.heappush(sums, total)
        groups[total].append(group)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left and sums and sums[0] + length <= size:
            total = sums[0]
            first, count = groups[total].pop()
            taken = min(left, count)
            placed.append((length, rank, taken, first, total))
            if taken < count:
                groups[total].append((first + taken, count - taken))
            if not groups[total]:
                del groups[total]
                heapq.heappop(sums)
            add(total + length, (first, taken))
            rank, left = rank + taken, left - taken
        if left:
            each = size // length
            whole = left // each
            for place in range(each):
                if whole:
                    placed.append((length, rank, whole, packs, place * length))
                    rank += whole
            if whole:
                add(each * length, (packs, whole))
                packs += whole
            for place in range(left % each):
                placed.append((length, rank, 1, packs, place * length))
                rank += 1
            if left % each:
                add((left % each) * length, (packs, 1))
                packs += 1
    return placed


def ranked(pieces: DataFrame, share: int = 512) -> DataFrame:
    """Position (from 0) of each piece among those of its length, as column ``rank``.

    Pieces are numbered inside shares of about ``share`` rows and shifted by the sizes of the
    earlier shares, so a length that most pieces have is numbered by many tasks.
    """
    split = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("shares"))
    sizes = pieces.groupBy("length").agg(F.ceil(F.count("*") / share).alias("shares"))
    shared = stored(
        pieces.join(F.broadcast(sizes), "length").withColumn("share", split).drop("shares")
    )
    counts = shared.groupBy("length", "share").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("share").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = counts.select(
        "length", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")
    )
    own = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32")
    return (
        shared.withColumn("place", F.row_number().over(own) - 1)
        .join(shifts, ["length", "share"])
        .withColumn("rank", F.col("place") + F.col("shift"))
        .drop("place", "share", "shift")
    )


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``size`` tokens.

    Only the histogram of lengths, at most ``size`` rows, reaches the driver. The placements
    go back to the pieces by length and a range of ranks.
    """
    spark = pieces.sparkSession
    numbered = stored(ranked(pieces))
    histogram = {row["length"]: row["n"] for row in numbered.groupBy("length").agg(
        F.count("*").alias("n")).collect()}
    placements = spark.createDataFrame(
        pa.table(
            [pa.array(column, pa.int64()) for column in
             zip(*plan(histogram, size), strict=True)] or [pa.array([], pa.int64())] * 5,
            names=["length", "first_rank", "pieces", "first_pack", "offset"],
        )
    )
    # the sorted placements of a length, searched by rank: one row per length
    by_length = placements.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first_rank", "first_pack", "offset"))).alias("at")
    )
    middle = F.expr("""
        aggregate(
            sequence(1, 64),
            named_struct('low', 0, 'high', size(at) - 1),
            (s, i) -> if(s.low >= s.high, s,
                if(at[(s.low + s.high + 1) div 2].first_rank <= rank,
                   named_struct('low', cast((s.low + s.high + 1) div 2 as int), 'high', s.high),
                   named_struct('low', s.low,
                                'high', cast((s.low + s.high + 1) div 2 as int) - 1))),
            s -> at[s.low])
    """)
    return (
        numbered.join(F.broadcast(by_length), "length")
        .withColumn("_at", middle)
        .withColumn("sequence_id", F.col("_at.first_pack") + F.col("rank")
                    - F.col("_at.first_rank"))
        .withColumn("offset", F.col("_at.offset"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, pattern: str, size: int = SIZE
) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Null texts count as empty and give one piece of one id. Equal documents and repeated rows
    are packed each for itself. An empty table gives an empty result. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    return pack(stored(cut(docs, tokenizer_path, pattern, size)), size)
