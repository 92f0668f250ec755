"""Training memory and recall of the toxicity model."""

import random
import tracemalloc

from pyspark.sql import functions as F

from fusion_spark.llm import labels, toxicity


def texts(n, words, bad, seed, size=300):
    draw = random.Random(0)
    vocabulary = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 9)))
                  for _ in range(size)]
    draw = random.Random(seed)
    rows = []
    for number in range(n):
        chosen = draw.choices(vocabulary, k=words)
        if number % 2:
            place = draw.randrange(words)
            chosen[place:place] = [draw.choice(bad), draw.choice(bad)]
        rows.append((" ".join(chosen), number % 2))
    return rows


def test_memory_of_long_texts():
    rows = texts(400, 2900, ["vilething"], 1, size=20_000)
    assert len(rows[0][0]) > 19_000
    tracemalloc.start()
    toxicity.train(rows, passes=1, steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20  # measured on 1,600 such texts: 67 MB


def test_recall_of_rare_words_and_misspellings():
    bad = ["vilething", "scumfolk", "gutterbrat", "rotbrain"]
    model = toxicity.train(texts(600, 120, bad, 2))
    unseen = ["vilethingg", "scumfolks", "guterbrat", "rotbrainn"]
    for words, least in ((bad, 0.9), (unseen, 0.6)):
        rows = texts(200, 120, words, 3)
        scores = [(model.score(toxicity.worst_window(model.word_values(toxicity.tokens(t)))), y)
                  for t, y in rows]
        caught = [s >= toxicity.THRESHOLD for s, y in scores if y]
        wrong = [s >= toxicity.THRESHOLD for s, y in scores if not y]
        assert sum(caught) / len(caught) >= least
        assert sum(wrong) / len(wrong) <= 0.05


def test_short_texts_weigh_like_their_windows():
    model = toxicity.train(texts(200, 5, ["vilething"], 4))
    assert model.slope > 0


def test_sample_is_bounded_by_bytes(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.repeat(
        F.lit("x"), F.when(F.col("id") == 5, 5000).otherwise(100)).alias("text"))
    marks = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    every = F.lit(True)
    rows = labels.sample(docs, marks, "toxic", every, 40, most_bytes=1000)
    assert sorted(label for _, label in rows) == [0] * 10 + [1] * 10
    assert {len(text) for text, _ in rows} == {100}
    assert len(labels.sample(docs, marks, "toxic", every, 40)) == 80


def test_samples_of_two_seeds_are_independent(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    marks = docs.select("doc_id", F.lit(1).alias("quality"))
    half, every = F.col("doc_id") % 2 == 0, F.lit(True)
    trusted = {t for t, _ in labels.sample(docs, marks, "quality", half, 200, classes=(1,))}
    rest = {t for t, _ in labels.sample(docs, marks, "quality", every, 400, classes=(1,), seed=7)}
    assert len(trusted) == 200 and len(rest) == 400
    assert 5 <= len(trusted & rest) <= 40  # 20 by chance
