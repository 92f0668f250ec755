"""Near duplicates: ProbMinHash over weighted word shingles, banding, verification."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.components import components
from fusion_spark.llm.exact_dedup import settle
from fusion_spark.llm.store import stored
from fusion_spark.llm.words import slices, texts_of

SHINGLE = 5  # words
SIMILAR = 0.8
BANDS = 20
ROWS = 5  # registers of a band: at similarity 0.8 all bands miss with probability 0.0004
CACHE_WORDS = 500_000
BLOCK = 256  # texts of a shingle, about, that meet in one part of its pairs
WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(code: np.ndarray) -> np.ndarray:
    """A 64-bit number whose bits all depend on all bits of ``code``."""
    code = (code ^ (code >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code ^ (code >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return code ^ (code >> np.uint64(31))


class Shingler:
    """Hashes of the word shingles of whole texts."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known: dict[str, int] = {}

    def shingles(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Different shingles, in order of their hashes, and how often each occurs.

        Words are runs of letters, digits and underscores in lower case. A text of fewer words
        than a shingle is one shingle; a text without words has none.
        """
        words = WORD.findall(text.lower())
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(codes))
        if not size:
            return codes, codes.astype(np.int64)
        out = np.full(len(codes) - size + 1, size, np.uint64)
        for step in range(size):
            out = (out ^ codes[step:step + len(out)]) * _ODD
            out ^= out >> np.uint64(32)
        return np.unique(mixed(out), return_counts=True)


def prob_minhash(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, registers: int
) -> np.ndarray:
    """The element of each register of each text (0 where a text has none).

    Every element sends arrivals of a Poisson process with its weight as the rate, each to a
    random register, and a register keeps the element that arrives first. Two texts agree in
    a register with their probability Jaccard similarity. An element stops as soon as its
    next arrival is later than all registers of its text.
    """
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    clock = np.zeros(len(elements))
    active, drawn, block = np.arange(len(elements)), 0, 1
    while len(active):
        own, now = elements[active], clock[active]
        base = owner[active] * registers
        for number in range(drawn, drawn + block):
            shift = np.uint64((number + 1) * int(_ODD) % (1 << 64))
            draw = mixed(own + shift)
            chance = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
            now = now - np.log(chance) / weights[active]
            at = base + (mixed(draw) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(first, at, now)
            won = first[at] == now
            kept[at[won]] = own[won]
        clock[active] = now
        latest = first.reshape(texts, registers).max(axis=1)
        active = active[now < latest[owner[active]]]
        drawn, block = drawn + block, min(4 * block, 64)
    return kept.reshape(texts, registers)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(registers), bands), np.uint64)
    parts = registers.reshape(len(registers), bands, rows)
    for row in range(rows):
        keys = mixed((keys ^ parts[:, :, row]) * _ODD + np.uint64(row))
    return mixed(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, digest, keys): the text's SHA-256 and its band keys (none without words)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches):
            found = [shingler.shingles(text) for text in texts_of(batch, "text")]
            counts = np.array([len(elements) for elements, _ in found])
            registers = prob_minhash(
                np.concatenate([elements for elements, _ in found]),
                np.concatenate([weights for _, weights in found]).astype(np.float64),
                np.repeat(np.arange(len(found)), counts), len(found), bands * rows)
            keys = band_keys(registers, bands, rows)[counts > 0]
            bounds = np.cumsum([0, *(bands * (counts > 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel()))],
                names=["doc_id", "digest", "keys"],
            )

    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"), F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    ).mapInArrow(run, "doc_id long, digest binary, keys array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, shingles) of rows (node, text): a code for each occurrence of each shingle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches):
            lists = []
            for text in texts_of(batch, "text"):
                elements, uses = shingler.shingles(text)
                nth = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
                codes = mixed(np.repeat(elements, uses) + nth.astype(np.uint64))
                lists.append((codes >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(lists, pa.list_(pa.int32()))],
                names=["node", "shingles"],
            )

    return texts.select("node", "text").mapInArrow(run, "node binary, shingles array<int>")


def buckets(nodes: DataFrame) -> DataFrame:
    """(band, key, node, n, hubs): the nodes of each bucket of two or more.

    A bucket is a band with its key. Its hubs are the nodes that come first and last in an
    order of the band's own, so that a large group has many hubs.
    """
    rows = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    order = F.struct(F.xxhash64("node", "band").alias("place"), F.col("node").alias("node"))
    hubs = rows.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min(order).alias("one"), F.max(order).alias("two"),
    ).filter("n > 1").select(
        "band", "key", "n", F.array("one.node", "two.node").alias("hubs"))
    return rows.join(hubs, ["band", "key"])


def candidate_pairs(members: DataFrame) -> DataFrame:
    """(node, hub, shared): the nodes of each bucket against the two hubs of it.

    ``shared`` counts the buckets that propose the pair.
    """
    return (
        members.select("node", F.explode("hubs").alias("hub")).filter("node <> hub")
        .groupBy("node", "hub").agg(F.count("*").alias("shared"))
    )


def unlinked(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) of the nodes in buckets that ``labels`` does not put in one class.

    Buckets of up to three nodes have no other pairs than those with their hubs.
    """
    rows = members.filter("n > 3").select("node", "band", "key").join(
        labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed_up = rows.groupBy("band", "key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return rows.join(mixed_up.select("band", "key"), ["band", "key"]).select(
        "node", "label").distinct()


def rare_pairs(nodes: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """(a, b): pairs of different classes among ``nodes`` that may be ``similar``.

    No similar pair is left out: with shingles in one order, rarest first, two texts of which
    ``least`` shingles must agree have a common one before the last ``least`` - 1 of either.
    So what a crowd shares proposes no pair, unless its texts have little else. A shingle of
    many texts is dealt into blocks, and each two blocks meet in a part of their own.
    """
    def needed(share: float, size: Column) -> Column:
        return F.ceil(share * size - 1e-6)

    both = similar / (1 + similar)
    size = F.col("size")
    own = sets.join(nodes, "node").select(
        "node", "label", F.size("shingles").cast("long").alias("size"),
        F.explode("shingles").alias("code"))
    uses = own.groupBy("code").agg(F.count("*").alias("uses"))
    rows = stored(
        own.join(uses, "code").groupBy("node", "label", "size")
        .agg(F.sort_array(F.collect_list(F.struct("uses", "code"))).alias("order"))
        .select("node", "label", "size", F.posexplode(F.slice(
            "order", F.lit(1), (size - needed(similar, size) + 1).cast("int"))))
        .filter("col.uses > 1")
        .select("node", "label", "size", F.col("pos").alias("place"), F.col("col.code"))
        .withColumn("early", F.col("place") <= size - needed(2 * both, size))
    )
    mixed_up = rows.groupBy("code").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.max("early").alias("early"),
    ).filter("low <> high and early").select("code", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    dealt = rows.join(mixed_up, "code").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("code", "first", "second", F.col("node").alias(name), *(
            F.col(c).alias(f"{c}_{name}") for c in ("label", "size", "place")))

    one = side(dealt.filter("early").withColumn("first", F.col("block"))
               .withColumn("second", every), "a")
    two = side(dealt.withColumn("second", F.col("block")).withColumn("first", every), "b")
    least = needed(both, F.col("size_a") + F.col("size_b"))
    return one.join(two, ["code", "first", "second"]).filter(
        (F.col("label_a") != F.col("label_b"))
        & (F.struct("size_a", "a") < F.struct("size_b", "b"))
        & (F.col("size_a") >= similar * F.col("size_b") - 1e-6)
        & (F.col("place_a") <= F.col("size_a") - least)
        & (F.col("place_b") <= F.col("size_b") - least)
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose shingles have a weighted Jaccard similarity of ``similar``."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(one, "a").join(two, "b").filter(
        both >= similar * (F.size("of_a") + F.size("of_b") - both)
    ).select("a", "b")


def near_dedup(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, kept, digest.

    A class is a connected group of texts that are equal or whose word shingles have a
    weighted Jaccard similarity of ``similar`` or more; its id is its largest doc_id, and
    that row is kept. Texts without words are only like equal texts. Null counts as empty. Of
    rows that repeat the id and the text one is kept; an empty table gives an empty result.
    No column but ``doc_id`` and ``text`` is read.

    Equal texts are settled first and take part as one node. Each node is then checked
    against the hub it shares most bands with, and the other pairs of nodes and hubs where
    these links have not joined their classes already. The texts of buckets that hold several
    classes after that are joined exactly by their rare shingles, so every pair that shares a
    bucket is decided.
    """
    sketches = stored(sketch(docs))
    copies = stored(settle(sketches.select("doc_id", "digest")).select(
        "doc_id", "keep_id", "kept", "digest", F.substring("digest", 1, 16).alias("node")))
    nodes = sketches.join(copies.filter("kept").select("doc_id", "digest", "node"),
                          ["doc_id", "digest"]).dropDuplicates(["node"])
    members = stored(buckets(nodes.select("node", "keys")))
    pairs = stored(candidate_pairs(members))
    wanted = stored(
        copies.filter("kept").select("doc_id", "digest", "node").join(
            pairs.select("node").union(pairs.select("hub")).distinct(), "node", "left_semi"))
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text")).join(
        wanted, "doc_id").filter(F.unhex(F.sha2("text", 256)) == F.col("digest"))
    sets = stored(shingle_sets(texts).dropDuplicates(["node"]))
    best = pairs.groupBy("node").agg(
        F.max(F.struct("shared", F.xxhash64("hub").alias("place"), "hub")).alias("at")
    ).select(F.least("node", "at.hub").alias("a"), F.greatest("node", "at.hub").alias("b"))
    links = stored(verified(best.distinct(), sets, similar))
    labels = components(links)
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    rest = (
        pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct().join(best, ["a", "b"], "left_anti")
        .join(one, "a", "left").join(two, "b", "left")
        .filter("label_a is null or label_b is null or label_a <> label_b")
        .select("a", "b")
    )
    more = stored(verified(rest, sets, similar))
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)
    checked = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    apart = stored(unlinked(members, labels))
    last = stored(verified(
        rare_pairs(apart, sets, similar).join(checked, ["a", "b"], "left_anti"), sets, similar))
    if not last.isEmpty():
        labels = components(links.union(last))
    linked = stored(copies.filter("kept").select("node", "keep_id").join(labels, "node"))
    top = linked.groupBy("label").agg(F.max("keep_id").alias("class_id"))
    classes = linked.join(top, "label").select("node", "class_id")
    class_id = F.coalesce("class_id", "keep_id")
    return copies.join(classes, "node", "left").select(
        "doc_id", class_id.alias("class_id"),
        (F.col("kept") & F.col("doc_id").eqNullSafe(class_id)).alias("kept"), "digest",
    )


def keep_one_of_likes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that near dedup keeps, with all their columns."""
    decided = stored(near_dedup(docs, similar))
    kept = decided.filter("kept").select(
        F.col("doc_id").alias("_keep"), F.col("digest").alias("_digest"))
    same = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256)) == kept["_digest"]
    staying = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_keep"]) & same, "left_semi")
    repeats = decided.groupBy("doc_id", "digest").count().filter("count > 1")
    return staying if repeats.isEmpty() else staying.dropDuplicates(["doc_id", "text"])
