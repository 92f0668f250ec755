"""Results against other libraries, brute force, round trips and held-out rows."""

import base64
import collections
import hashlib
import random
import re
import struct
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fusion_spark.llm import (
    bpe, components, fingerprints, html_text, language, near_dedup, packing, pii, quality,
    queries, toxicity, words,
)

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {row["doc_id"]: row["text"] or "" for row in docs.collect()}


def test_bpe_equals_tiktoken(spark, texts):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks=ranks, special_tokens={})
    rows = queries.op2_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]]
        ids = other.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_offsets_cover_split_characters(spark):
    text = "a 🙂é\x1c\x85 漢字"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, offsets=True).first()
    ranks = {rank: token for token, rank in bpe.read_ranks(RANKS).items()}
    pieces = [ranks[i] for i in row["ids"]]
    assert b"".join(pieces).decode() == text
    assert "".join(bpe.decode_pieces(pieces)) == text
    assert row["starts"][0] == 0 and row["ends"][-1] == len(text)
    for piece, start, end in zip(pieces, row["starts"], row["ends"], strict=True):
        assert piece in text[start:end].encode()


def test_latin_pattern_equals_the_pattern():
    dice = random.Random(3)
    own = re.compile(words.latin_pattern(public_tokenizers.PATTERN)).findall
    import regex
    other = regex.compile(public_tokenizers.PATTERN).findall
    for _ in range(300):
        text = "".join(chr(dice.choice([dice.randrange(256), 32, 39, 115, 10])) for _ in range(60))
        assert own(text) == other(text)


def test_packing(spark, texts):
    rows = queries.op4_packing(spark, SF).collect()
    other = Tokenizer.from_file(MODEL)
    other.encode_special_tokens = True
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append(row)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids = other.encode(texts[doc], add_special_tokens=False).ids + [1]
        at = 0
        for piece in sorted(pieces, key=lambda r: r["start"]):
            part = ids[at:at + piece["length"]]
            assert (piece["start"], piece["doc_tokens"]) == (at, len(ids))
            assert piece["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += piece["length"]
        assert at == len(ids)
    fill = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda r: r["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= 2048
        fill += at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert fill >= 0.9 * 2048 * (len(by_sequence) - 1)


def test_packing_gives_added_tokens_their_id():
    with open(MODEL, encoding="utf-8") as file:
        own = words.WordEncoder(file.read(), public_tokenizers.PATTERN)
    other = Tokenizer.from_file(MODEL)
    for text in ("a <|endoftext|> b", "<|endoftext|>", "é🙂<|endoftext|><|endoftext|>\n x",
                 "a <|endoftext b"):
        ids = other.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_piece_once(seed):
    dice = random.Random(seed)
    histogram = {dice.randint(1, 64): dice.randint(1, 500) for _ in range(dice.randint(1, 40))}
    packs, ranks = collections.Counter(), collections.defaultdict(set)
    for length, rank, pieces, pack, offset in sorted(
            packing.plan(histogram, 64), key=lambda p: p[4]):
        for i in range(pieces):
            assert packs[pack + i] == offset
            packs[pack + i] += length
            assert rank + i not in ranks[length]
            ranks[length].add(rank + i)
    assert {length: len(own) for length, own in ranks.items()} == histogram
    assert max(packs.values()) <= 64


def test_hot_length_is_ranked_in_shares(spark):
    pieces = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("start"),
        F.when(F.col("id") < 4000, 7).otherwise(9).cast("long").alias("length"),
        F.lit(1).cast("long").alias("ids_crc32"), F.lit(7).cast("long").alias("doc_tokens"))
    rows = packing.ranked(pieces, share=100).collect()
    for length, count in ((7, 4000), (9, 1000)):
        assert sorted(r["rank"] for r in rows if r["length"] == length) == list(range(count))


def jaccard(one, two):
    return 1.0 if not one | two else len(one & two) / len(one | two)


def pieces(text):
    """Lines cut behind every word whose hash ends in three zero bits."""
    found = set()
    for line in text.split("\n"):
        piece = []
        for word in line.split():
            piece.append(word)
            if xxhash.xxh64_intdigest(word, 42) % 8 == 0:
                found.add(tuple(piece))
                piece = []
        found.add(tuple(piece))
    return found - {()}


def near_next(spark, text, after):
    docs = spark.createDataFrame([(2, text), (1, after)], "doc_id long, text string")
    return fingerprints.fingerprints(docs).filter("doc_id = 2").first()["near_next"]


def test_likeness_across_lengths_and_insertions(spark):
    dice = random.Random(5)
    listed = ["".join(dice.choice("abcdefghij") for _ in range(dice.randint(3, 8)))
              for _ in range(2000)]
    text = " ".join(listed)
    assert near_next(spark, "first " + text, text) > 0.99
    assert near_next(spark, "\n\n " + text.replace(" ", "  "), text) == 1
    for chars in (300, 639, 5000):  # against nine tenths of itself
        after = text[:chars * 9 // 10]
        found = near_next(spark, text[:chars], after)
        assert found == pytest.approx(jaccard(pieces(text[:chars]), pieces(after))) and found > 0.6
    assert near_next(spark, text[:5000], text[5000:]) < 0.1


@pytest.mark.parametrize("few", [0, 100_000])
def test_fingerprints_equal_brute_force(spark, monkeypatch, few):
    dice = random.Random(4)
    rows = [(i * 7, "\n".join(" ".join(dice.choice("abcdefgh") * 3 for _ in range(
        dice.randint(1, 30))) for _ in range(dice.randint(0, 60)))) for i in range(60)]
    rows[9] = (rows[9][0], rows[8][1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # a sketch this small fails for some rows, which are done again with more cells
    monkeypatch.setattr(fingerprints, "FEW", few)
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs, grow=1).collect()}

    order = sorted(rows, reverse=True)
    for place, (doc, text) in enumerate(order):
        after = order[(place + 1) % len(order)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        row = found[doc]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(jaccard(pieces(text), pieces(edited)))
        assert row["near_next"] == pytest.approx(jaccard(pieces(text), pieces(after)))
    assert found[rows[8][0]]["fingerprint"] == found[rows[9][0]]["fingerprint"]


def test_near_dedup_equals_brute_force(spark):
    dice = random.Random(8)

    def text(n):
        return [f"w{dice.randrange(3000)}" for _ in range(n)]

    rows = [(i, " ".join(text(dice.randint(3, 200)))) for i in range(60)]
    hot = text(120)
    for i in range(60, 160):  # a large group whose members differ a little
        copy = list(hot)
        copy[dice.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, rows[i][1]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shingles = {}
    for doc, own in rows:
        own = own.split()
        size = min(5, len(own))
        shingles[doc] = collections.Counter(
            tuple(own[i:i + size]) for i in range(len(own) - size + 1))
    label = {doc: doc for doc, _ in rows}

    def root(doc):
        while label[doc] != doc:
            doc = label[doc]
        return doc

    for a, of_a in shingles.items():
        for b, of_b in shingles.items():
            if a < b and (of_a & of_b).total() >= 0.8 * (of_a | of_b).total():
                label[root(a)] = root(b)
    groups = collections.defaultdict(set)
    for doc, _ in rows:
        groups[root(doc)].add(doc)
    expected = {doc: max(group) for group in groups.values() for doc in group}
    found = near_dedup.near_dedup(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == expected
    assert {r["doc_id"] for r in found if r["kept"]} == set(expected.values())


def test_near_dedup_inside_a_crowd(spark):
    """Pairs slightly above 0.8 among texts that share three quarters with each other."""
    template = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(240):  # texts 0 and 1, 2 and 3 and so on share a part of their own words
        own = [f"p{i // 2}w{n}" for n in range(20)] if i < 120 else []
        own += [f"x{i}w{n}" for n in range(50 - len(own))]
        rows.append((i, " ".join(template + own)))
    shingles = {}
    for doc, text in rows:
        parts = text.split()
        shingles[doc] = {tuple(parts[i:i + 5]) for i in range(len(parts) - 4)}
    like = {(a, b) for a, of_a in shingles.items() for b, of_b in shingles.items()
            if a < b and len(of_a & of_b) >= 0.8 * len(of_a | of_b)}
    assert like == {(i, i + 1) for i in range(0, 120, 2)}
    crowd = [len(shingles[0] & own) / len(shingles[0] | own)
             for doc, own in shingles.items() if doc > 1]
    assert 0.73 < min(crowd) and max(crowd) < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_dedup(docs).collect()
    expected = {i: i + 1 if i < 120 and i % 2 == 0 else i for i in range(240)}
    assert {r["doc_id"]: r["class_id"] for r in found} == expected


def test_prob_minhash_estimates_probability_jaccard():
    one, two = np.array([1, 2, 3, 4], np.uint64), np.array([2, 3, 4, 5], np.uint64)
    u, v = np.array([1.0, 2, 3, 1]), np.array([2.0, 2, 1, 4])
    found = near_dedup.prob_minhash(
        np.concatenate([one, two]), np.concatenate([u, v]), np.repeat([0, 1], 4), 2, 20000)
    a, b = dict(zip(one.tolist(), u)), dict(zip(two.tolist(), v))
    expected = sum(
        1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
        for d in a.keys() & b.keys())
    assert (found[0] == found[1]).mean() == pytest.approx(expected, abs=0.02)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["label"] for r in components.components(frame).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    assert components.components(frame.limit(0)).collect() == []


def test_base_spans_equal_plain_patterns():
    dice = random.Random(7)
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, text):
        digits = [int(d) for d in text if d.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in text.split("."))
        if kind == "card":
            odd = sum(digits[-1::-2]) + sum(d * 2 - 9 * (d > 4) for d in digits[-2::-2])
            return 14 <= len(digits) <= 19 and odd % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    for _ in range(3000):
        text = "".join(dice.choice(["a", "@", ".", "-", "+", " ", "(", "\n", *"0123456789"])
                       for _ in range(dice.randint(0, 60)))
        expected = sorted(
            (m.start(), place, m.end()) for place, (kind, p) in enumerate(patterns.items())
            for m in re.finditer(p, text) if good(kind, m[0]))
        assert [(s, pii.KINDS.index(k), e) for s, e, k in pii.base_spans(text)] == expected


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"hello there write to a{i}@mail.example.com today please") for i in range(12)]
    rows += [(50, "hello there write to bob#at#corp9 today please"),
             (51, "the room number7b is free today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    assert found[50]["spans"] == "email:21:33" and found[50]["base"] == ""
    assert found[51]["spans"] == "" and found[3]["n_email"] == 1
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    assert masked[50] == "hello there write to <EMAIL> today please"
    assert masked[51] == rows[13][1]


def test_misspelling_shares_subwords():
    dice = random.Random(2)
    plain = ["".join(dice.choice("aeioulmnrst") for _ in range(6)) for _ in range(200)]
    rows = []
    for i in range(160):
        own = [dice.choice(plain) for _ in range(40)]
        if i % 2:
            own[dice.randrange(40)] = "blockhead"
        rows.append((" ".join(own), i % 2))
    model = toxicity.train(rows)
    exact, near = model.word_values(["blockhead", "blockheadd"])
    assert exact > near > max(model.word_values(plain)) and near > exact / 3
    text = rows[1][0].split()
    assert model.score(toxicity.worst_window(model.word_values(text))) > 0.7
    assert model.score(toxicity.worst_window(model.word_values(rows[0][0].split()))) < 0.3


@pytest.mark.parametrize("texts, kinds, least", [(1600, 40, 0.6), (40, 1, 0.5)])
def test_rare_toxic_words_are_learned(texts, kinds, least):
    """Each toxic word is in 2.5% of the toxic texts, or in all of a few."""
    spell = random.Random(1)

    def word(letters):
        return "".join(spell.choice(letters) + spell.choice("aeiou") for _ in range(4))

    plain = [word("bcdfghjklmnprstvw") for _ in range(400)]
    bad = [word("qxzjkvwy") for _ in range(kinds)]

    def rows(count, seed):
        dice = random.Random(seed)
        for i in range(count):
            own = [dice.choice(plain) for _ in range(30)]
            if i % 2:
                own[dice.randrange(30)] = dice.choice(bad)
            yield " ".join(own), i % 2

    model = toxicity.train(list(rows(texts, 5)))
    called = {0: [], 1: []}
    for text, label in rows(400, 6):
        value = toxicity.worst_window(model.word_values(toxicity.tokens(text)))
        called[label].append(model.score(value) >= toxicity.THRESHOLD)
    assert np.mean(called[1]) > least and np.mean(called[0]) < 0.2


def test_forward_sums_all_segmentations():
    pieces = ["^a", "ab", "b", "a", "^", "^ab"]
    lookup = language.Pieces(pieces)
    chances = np.array([[0.1], [0.2], [0.3], [0.15], [0.05], [0.12], [0.01]])
    cuts = lookup.cuts(["ab", "b", "x"])
    sums = np.exp(language.log_prefixes(cuts, np.log(chances))[cuts.last, 0])
    # ^ab | ^a b | ^ ab | ^ a b, then ^ b, then ^ and an unlisted character
    assert sums == pytest.approx([0.12 + 0.03 + 0.01 + 0.05 * 0.15 * 0.3, 0.015, 0.0005])


def segmentations(word, pieces):
    """All ways to cut a word into pieces, single characters being pieces."""
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1)
            if n == 1 or word[:n] in pieces for rest in segmentations(word[n:], pieces)]


def test_pieces_of_any_length_equal_brute_force():
    dice = random.Random(8)
    pieces = ["^", "a", "b"] + sorted({"".join(dice.choice("ab") for _ in range(n))
                                       for n in range(2, 14) for _ in range(3)})
    lookup = language.Pieces(pieces)
    chances = np.array([[dice.random(), dice.random()] for _ in range(len(pieces) + 1)])
    chances /= chances.sum(0)
    number = {piece: i for i, piece in enumerate(pieces)}
    found = ["".join(dice.choice("aabbc") for _ in range(dice.randint(1, 15))) for _ in range(30)]
    uses = np.arange(1.0, len(found) + 1)
    cuts = lookup.cuts(found)
    sums = language.log_prefixes(cuts, np.log(chances))[cuts.last]
    counts = np.zeros(len(chances))
    for word, got, times in zip(found, sums, uses, strict=True):
        ways = [[number.get(p, len(pieces)) for p in way]
                for way in segmentations("^" + word, number)]
        weights = np.array([chances[way].prod(0) for way in ways])
        assert np.exp(got) == pytest.approx(weights.sum(0))
        for way, weight in zip(ways, weights[:, 0] / weights[:, 0].sum(), strict=True):
            np.add.at(counts, way, weight * times)
    assert language.expected_counts(cuts, np.log(chances[:, 0]), uses) == pytest.approx(counts)


def test_words_are_whole_and_pieces_long():
    pieces = language.vocabulary(PIECES)
    assert max(map(len, pieces)) == 16
    logs = np.log(np.full((len(pieces) + 1, 1), 1 / (len(pieces) + 1)))
    model, lookup = language.Model(["x"], pieces, logs), language.Pieces(pieces)
    # plain products underflow; each further copy of a period adds the same
    one, two, three = model.log_chances(
        lookup, ["internationalisierung" * n for n in (10_000, 20_000, 30_000)])[:, 0]
    assert one < -100_000 and three - two == pytest.approx(two - one)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = queries.op9_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast(
        "int"))).first()[0] > 0.97
    found = queries.op10_quality(spark, sf).join(labels, "doc_id").filter("held_out")
    assert found.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9
    found = queries.op5_toxicity(spark, sf).join(labels, "doc_id").filter("held_out")
    assert found.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0] > 0.8


def test_quality_in_another_script():
    dice = random.Random(6)

    def prose(letters):
        return " ".join("".join(dice.choice(letters) for _ in range(dice.randint(2, 9)))
                        for _ in range(60)) + "."

    good, junk = "абвгдежзиклмнопрстуф", "☆★◆◇○●◎□■△▲▽▼※→←↑↓♪♭"
    model = quality.train([prose(good) for _ in range(100)],
                          [prose(good) for _ in range(100)] + [prose(junk) for _ in range(100)])
    rows = [[quality.features(prose(letters)) for _ in range(50)] for letters in (good, junk)]
    of_good, of_junk = (model.scores(np.array(part)) for part in rows)
    assert (of_good > 0.3).mean() > 0.9 and (of_junk < 0.3).mean() > 0.9
    signs = quality.kinds_of("\u201cЖ\u201d \u2014 ж\uff0c")
    assert signs[:2].tolist() == [2, 1]
    assert [signs[5 + quality.SINGLE.index(c)] for c in '"-,?'] == [2, 1, 1, 0]


def test_extraction_of_the_given_pages(spark):
    import html
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.op1_html_text(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        blocks = (re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", inner))
        lines = (" ".join(html.unescape(b).split()) for b in blocks)
        assert row["text"] == "\n".join(line for line in lines if line)
        assert row["n_chars"] == len(row["text"])


def test_extraction_of_another_layout():
    with_parts = (
        '<html><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>News of {0}'
        "</h1><p>The {0} text, with words. It has more.</p><p>Then, a second one.</p></article>"
        "<footer>Imprint</footer></body></html>")
    trees = html_text.train([with_parts.format(word) for word in "abcdefghijklmnopqrst"])
    other = html_text.parse(
        '<div id="menu"><a>Home</a></div><div class="content"><h1>Title here</h1><p>First text, '
        'with words. And more.<div class="ad">Buy this now.</div><p>Second text, too.</div>'
        '<div class="comments"><p>I agree, thanks for it.</p></div><aside><p>Other</p></aside>')
    kept = html_text.decode(other.parents, trees.log_odds(html_text.node_features(other)))
    assert html_text.text_of(other, kept) == (
        "Title here\nFirst text, with words. And more.\nSecond text, too.")


@pytest.mark.parametrize("source, lines", [
    ('<p>one</p><svg class="i"/><p>two</p>', "one\ntwo"),
    ('<p>one</p><svg class="a>b" /><p>two</p><svg><text>no</text></svg>', "one\ntwo"),
    ("<p>one</p><math-renderer>two</math-renderer><p>three</p>", "one\ntwo\nthree"),
    ("<title-bar>one</title-bar><template-x>two</template-x><p>three</p>", "one\ntwo\nthree"),
    ("<p>one</p><iframe src=x><p>two</p>", "one\ntwo"),
    ("<p>with <math><msup><mi>x</mi><mn>2</mn></msup><annotation>x^2</annotation></math> in</p>",
     "with x2 in"),
    ("<p>one</p><SCRIPT>no</script ><p>two</p><style>no", "one\ntwo"),
])
def test_hidden_elements_end(source, lines):
    page = html_text.parse(source)
    assert html_text.text_of(page, np.ones(len(page.tags), bool)) == lines


def test_decoding_enters_content_once():
    parents = [-1, 0, 1, 2, 3]
    kept = html_text.decode(parents, np.array([-5.0, 5, -1, 5, -5]))
    assert kept.tolist() == [False, True, True, True, False]
    kept = html_text.decode(parents, np.array([-5.0, 1, -9, 2, -5]))
    assert kept.tolist() == [False, False, False, True, False]


@pytest.mark.parametrize("unit", [
    "<select><option>x", '<b class="', "<b class='\"", "<a<a", "<foo>x", "<div><p>x</i></p>",
    "<!x", "<script", "<svg a='", "</p></li>", "<p><foo></div>",
])
@pytest.mark.parametrize("end", ["", '"', "' >", '">'])
def test_malformed_pages_take_linear_time(unit, end):
    begin = time.process_time()
    page = html_text.parse("<body><p><div><li>" + unit * (1_000_000 // len(unit)) + end)
    assert time.process_time() - begin < 6  # an hour, if every tag looked at all the rest
    assert len(page.tags) >= 5


@pytest.fixture(scope="module")
def trees():
    return html_text.train([])


def content_of(trees, source):
    page = html_text.parse(source)
    kept = html_text.decode(page.parents, trees.log_odds(html_text.node_features(page)))
    return html_text.text_of(page, kept)


@pytest.mark.parametrize("start, end", [
    ('<div id="content">', "</div>"), ('<div class="wrap"><div class="post">', "</div></div>"),
    ("<main>", "</main>"), ('<article class="post top">', "</article>"), ("<div>", "</div>"),
    ("", ""),
])
def test_trees_exist_without_training_pages(trees, start, end):
    texts = [f"This is part {i} of the text, with some words in it. There is more to say."
             for i in range(6)]
    inner = "".join(f"<p>{text}</p>" for text in texts)
    source = ('<body><ul class="menu"><li><a href="/">Home</a></li><li><a href="/n">News</a></li>'
              f"</ul>{start}{inner}{end}<footer>Imprint</footer></body>")
    assert content_of(trees, source) == "\n".join(texts)


def test_title_in_the_header_of_an_article(trees):
    texts = [f"This is part {i} of the text, with some words in it. There is more to say."
             for i in range(6)]
    inner = "".join(f"<p>{text}</p>" for text in texts)
    source = ("<body><header><a href='/'>Site</a></header><article><header><h1>A title here</h1>"
              f"</header>{inner}</article><footer>Imprint</footer></body>")
    assert content_of(trees, source) == "\n".join(["A title here", *texts])


@pytest.mark.parametrize("source, lines", [
    ('<article class="post top"><p>The text, all of it.</p></article>', [True, True]),
    ('<main><div class="tags-page"><p>The text, all of it.</p></div></main>', [True] * 3),
    ("<article><header><h1>Title</h1></header><p>Text.</p></article>", [True] * 4),
    ('<article><p>The text.</p><div class="tags">a</div></article>', [True, True, False]),
    ("<article><header><a>Home</a></header><p>Text.</p></article>", [True, False, True]),
])
def test_names_of_parts_yield_to_their_text(source, lines):
    assert html_text.landmarks(html_text.parse(source))[1:].tolist() == lines
