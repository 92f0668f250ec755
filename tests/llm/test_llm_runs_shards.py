"""Periodic runs, interleaved shards and source gaps against plain recomputations."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fusion_spark.llm import divergence, queries, runs, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_runs(words, least):
    """All (start, length, period): every period tried, longer ones only where none divides."""
    out, n = [], len(words)
    for period in range(1, n // 2 + 1):
        place = 0
        while place + period < n:
            if words[place] != words[place + period]:
                place += 1
                continue
            end = place
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end + period - place
            unit = words[place:place + period]
            primitive = not any(
                period % q == 0 and unit == unit[:q] * (period // q) for q in range(1, period))
            if length >= max(least, 2 * period) and primitive:
                out.append((place, length, period))
            place = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_all_runs(symbols):
    found = sorted(map(tuple, runs.all_runs(np.array(symbols, np.int64)).tolist()),
                   key=lambda r: (r[0], r[2]))
    assert found == plain_runs(symbols, 2)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 14))
def test_word_runs_of_repeats(seed, least):
    draw = random.Random(seed)
    words = []
    while len(words) < 120:
        unit = [b"w%d" % draw.randrange(draw.choice((2, 40))) for _ in range(draw.randint(1, 9))]
        words += (unit * 5)[:draw.randint(1, 5 * len(unit))]
    assert list(map(tuple, runs.word_runs(words, least).tolist())) == plain_runs(
        words, max(2, least))


def test_tree_of_a_long_text():
    words = [b"a", b"b", b"c"] * 20000
    assert runs.word_runs(words).tolist() == [[0, 60000, 3]]
    assert runs.collapsed(words, runs.word_runs(words)) == b"a b c"


TEXTS = [
    None, "", " \n", "one", "a b " * 30, "x y z\tq " * 9, "été 🙂 " * 40, "one " * 5000,
    " ".join(f"w{i % 7} w{i % 3}" for i in range(400)),
    *(" ".join(f"t{(i * i + k) % (5 + k)}" for i in range(30 + 7 * k)) for k in range(80)),
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, text, "en" if i % 3 else None, f"s{i % 4}" if i % 9 else None, 0)
            for i, text in enumerate(TEXTS)]
    rows += [(7, "one " * 5000, "en", "s1", 0)] * 3 + [(None, "a b " * 30, "xx", "", None)] * 2
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    return folder


def plain_op12(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words, 12)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found).encode()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = {}
    expected = []
    for row in docs.collect():
        key = (row["doc_id"], row["text"])
        if key not in known:
            long = row["text"] == "one " * 5000  # the plain way is quadratic
            known[key] = plain_op12(row["doc_id"], "one " * 60 if long else row["text"])
            if long:
                found = list(known[key])
                assert found[2:5] == [0, 60, 1]
                found[3], found[5] = 5000, 5000 * 1000
                found[6] = hashlib.sha256(b"0,5000,1\n").hexdigest()
                known[key] = tuple(found)
        expected.append(known[key])
    result = queries.op12_periodic_runs(spark, sf_dir)
    assert [f.dataType.simpleString() for f in result.schema][1:6] == ["bigint"] * 5
    assert sorted(map(tuple, result.collect()), key=str) == sorted(expected, key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(10, len(TEXTS)))


def test_runs_of_other_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert runs.find_runs(docs.limit(0)).collect() == []
    clashing = docs.selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS collapsed")
    assert runs.find_runs(clashing).count() == docs.count()


def plain_places(rows, shards, seed=sharding.SEED):
    def code(value):
        return hashlib.md5(f"{seed}:{'-' if value is None else value}".encode()).hexdigest()

    strata = defaultdict(list)
    for doc_id, text, source in rows:
        body = (text or "").encode()
        strata[source].append(
            (code(doc_id), doc_id is not None, doc_id or 0, len(body) + 1, zlib.crc32(body)))
    points = []
    for source, members in strata.items():
        offset = int(code(source)[:8], 16) / 2 ** 32
        for rank, row in enumerate(sorted(members)):
            points.append(((rank + offset) / len(members), source is not None, source or "",
                           rank, row))
    points.sort()
    n, out = len(points), []
    for place, (_, _, _, _, row) in enumerate(points):
        shard = ((place + 1) * shards - 1) // n
        out.append((row[2] if row[1] else None, *row[3:], "rows", shard,
                    place - shard * n // shards, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least_rows", [1, 7, 4096])
@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards(spark, sf_dir, shards, least_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clashing = docs.selectExpr("*", "1 AS shard", "2 AS slot", "3 AS size", "4 AS law")
    rows = sharding.interleave(clashing, shards, least_rows=least_rows).collect()
    plain = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert sorted(map(tuple, rows), key=str) == plain_places(plain, shards)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_shards_match_the_mixture(spark):
    docs = spark.range(9000).selectExpr(
        "id AS doc_id", "'t' AS text",
        "CASE WHEN id < 3000 THEN 'hot' WHEN id < 8000 THEN concat('s', id % 50) "
        "ELSE concat('single', id) END AS source")
    placed = sharding.interleave(docs, least_rows=50).join(docs, "doc_id")
    table = defaultdict(Counter)
    for row in placed.collect():
        group = "single" if row["source"].startswith("single") else row["source"]
        table[group][row["shard"]] += 1
    for group, counts in table.items():
        share = sum(counts.values()) / 8
        # strata of one row fall where chance puts them and move the cuts with them
        room = 4 * (1000 / 8) ** 0.5 * (1 if group == "single" else 8 * share / 9000) + 2
        assert all(abs(counts[shard] - share) <= room for shard in range(8)), group


def test_few_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sharding.interleave(docs.limit(0)).collect() == []
    few = sharding.interleave(docs.limit(3)).collect()
    assert sorted(r["slot"] for r in few) == [0, 0, 0] and len({r["shard"] for r in few}) == 3


def plain_divergence(rows, least=3, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = "".join(c if c.isascii() and c.islower() or ord(c) > 127 else " "
                        for c in lowered).split(" ")
        terms = [t for t in terms if t]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        members = [s for g, s in groups if g == lang]
        whole = sum((counts[lang, s] for s in members), Counter())

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        own, all_of = shares(counts[lang, source]), shares(whole)
        pairs = []
        for other in members:
            if other != source:
                q = shares(counts[lang, other])
                pairs.append((-sum((own[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        above = [(-((own[t] - all_of[t]) ** 2 // all_of[t]), t.encode()) for t in kept
                 if counts[lang, source][t] and own[t] > all_of[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(above)[:top])):
            out += [(lang, source, part, item.decode(), -value, rank)
                    for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("held", [3, 200_000])
def test_divergence(spark, sf_dir, monkeypatch, held):
    monkeypatch.setattr(divergence, "BLOCK_BITS", 2)
    monkeypatch.setattr(divergence, "PART", 2)
    monkeypatch.setattr(divergence.term_counts, "__defaults__", (held,))
    draw = random.Random(3)
    rows = [(" ".join(draw.choice(["Alpha", "beta", "ÉT x", "g1h", "z", f"u{draw.random()}",
                                   "rare" + "abc"[k % 3]]) for _ in range(k % 30)),
             ["en", "de", None, "x"][k % 4], [None, "", "s1", "s2", "s3", "S"][k * k % 11 % 6])
            for k in range(200)]
    rows += [(None, "lone", "s"), ("Never three", "two", "a"), ("never", "two", "b")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "1 AS term", "2 AS count", "3 AS total", "4 AS rank")
    result = divergence.source_divergence(docs)
    assert sorted(map(tuple, result.collect())) == plain_divergence(rows)
    assert divergence.source_divergence(docs.limit(0)).collect() == []


def test_gap_of_large_numbers():
    p, q = np.array([10 ** 9 + 1, 1]), np.array([1, 10 ** 9 + 1])
    width = np.array([20, 10 ** 12])
    assert divergence.gap(p, q, width) == 20 * 10 ** 18 + 10 ** 12 * (10 ** 18 // (10 ** 9 + 1))
