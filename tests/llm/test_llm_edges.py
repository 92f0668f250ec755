"""Nulls, empty and long texts, repeats, empty tables and clashing columns in every operator."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fusion_spark.llm import (
    bpe, exact_dedup, fingerprints, html_text, language, near_dedup, packing, pii, quality,
    toxicity,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "word and more text, number 17. " * 6000
CLASHING = ["score", "label", "node", "keys", "digest", "kept", "_keep", "_digest", "key",
            "found", "row", "rank", "id", "number", "own", "_label", "_text", "length"]
TEXTS = [
    (1, None), (2, ""), (3, "one"), (4, LONG), (5, "the same text"), (6, "the same text"),
    (6, "the same text"), (7, "été naïve 🙂 <|endoftext|>"), (8, " \n\t "), (None, "no id"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t) if t else None) for i, t in TEXTS]
    plain = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.select("*", *(F.lit("x").alias(name) for name in CLASHING))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(3, None, None)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def models(spark, docs, labels):
    every = F.lit(True)
    return {
        "toxicity": toxicity.fit_toxicity(docs, labels, every),
        "quality": quality.fit_quality(docs, labels, every),
        "language": language.fit_languages(docs, PIECES, every),
    }


def operators(models):
    return {
        "encode": lambda d: bpe.encode(d, RANKS, public_tokenizers.PATTERN, offsets=True),
        "decode": lambda d: bpe.decode(
            bpe.encode(d, RANKS, public_tokenizers.PATTERN), RANKS),
        "pack": lambda d: packing.pack_documents(d, MODEL, public_tokenizers.PATTERN),
        "exact": exact_dedup.exact_dedup,
        "near": near_dedup.near_dedup,
        "fingerprints": fingerprints.fingerprints,
        "pii": pii.find_pii,
        "mask": pii.mask,
        "toxicity": lambda d: toxicity.score_toxicity(d, models["toxicity"]),
        "drop_toxic": lambda d: toxicity.drop_toxic(d, models["toxicity"], 2.0),
        "quality": lambda d: quality.score_quality(d, models["quality"]),
        "language": lambda d: language.identify(d, models["language"]),
    }


NAMES = list(operators(dict.fromkeys(["toxicity", "quality", "language"])))


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows(docs, models, name):
    rows = operators(models)[name](docs).collect()
    ids = [row["doc_id"] for row in rows]
    if name == "pack":
        assert set(ids) == {i for i, _ in TEXTS}
    else:
        assert sorted(ids, key=str) == sorted((i for i, _ in TEXTS), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, models, name):
    assert operators(models)[name](docs.limit(0)).collect() == []


def test_fit_on_nothing(docs, labels):
    none = F.lit(False)
    model = toxicity.fit_toxicity(docs, labels, none)
    assert {r["score"] < 0.01 for r in toxicity.score_toxicity(docs, model).collect()} == {True}
    model = quality.fit_quality(docs, labels, none)
    assert {r["score"] < 0.01 for r in quality.score_quality(docs, model).collect()} == {True}
    model = language.fit_languages(docs, PIECES, none)
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} == {"und"}


def test_kept_rows_keep_their_columns(docs):
    for keep in (exact_dedup.keep_one_of_copies, near_dedup.keep_one_of_likes):
        kept = keep(docs)
        assert kept.columns == docs.columns
        rows = sorted((str(r["doc_id"]), r["text"]) for r in kept.collect())
        # null and empty are equal; of the three equal texts the largest id stays once
        assert rows == sorted((str(i), t) for i, t in [*TEXTS[1:4], *TEXTS[6:]])


def test_exact_dedup_decisions(docs):
    rows = exact_dedup.exact_dedup(docs, counters=64, winners=8).collect()
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], []).append(row)
    assert by_id[1][0]["keep_id"] == 2 and not by_id[1][0]["kept"]
    assert by_id[1][0]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[5][0]["group_size"] == 3 and not by_id[5][0]["kept"]
    assert sorted(r["kept"] for r in by_id[6]) == [False, True]
    assert by_id[None][0]["kept"]


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (3, "u", "plain"), (4, "u", "<article><p>a  b&amp;c<br>d"),
         (4, "u", "<article><p>a  b&amp;c<br>d"), (5, "u", "<script>if (a < b) {" + "x" * 90000)],
        "page_id long, url string, html string").withColumn("text", F.lit(1))
    rows = html_text.extract(pages, None).collect()
    found = {row["page_id"]: row["text"] for row in rows}
    assert len(rows) == 6 and found == {1: "", 2: "", 3: "", 4: "a b&c d", 5: ""}
    trees = html_text.fit_extractor(pages)
    assert html_text.extract(pages, trees).count() == 6
    assert html_text.extract(pages.limit(0), trees).collect() == []
    assert html_text.fit_extractor(pages.limit(0)) is None


def test_pipeline(spark, docs, labels, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], docs.schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 1
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
