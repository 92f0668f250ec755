import random
from collections import Counter, defaultdict

import pytest

from fusion_spark.operators.dedup import (
    first_by, last_by, mark_repeats, number_in_key, uniquify_ids,
)
from fusion_spark.operators.skew import hot_keys, skew_join


@pytest.fixture(scope="module")
def keyed(spark):
    random.seed(6)
    rows = [(i, random.choice("abcdef") if i % 3 else "hot", random.randint(0, 5)) for i in range(900)]
    random.shuffle(rows)
    return rows, spark.createDataFrame(rows, "_ord bigint, k string, v int").repartition(5)


def test_first_and_last(keyed):
    rows, df = keyed
    first, last = {}, {}
    for o, k, v in sorted(rows):
        first.setdefault(k, (o, v))
        last[k] = (o, v)
    assert {r.k: (r._ord, r.v) for r in first_by(df, ["k"], ["_ord"]).collect()} == first
    assert {r.k: (r._ord, r.v) for r in last_by(df, ["k"], ["_ord"]).collect()} == last


def test_first_is_trimmed_before_the_shuffle(keyed):
    plan = first_by(keyed[1], ["k"], ["_ord"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_repeats_and_numbers(keyed):
    rows, df = keyed
    seen = Counter()
    position = {}
    for o, k, _ in sorted(rows):
        seen[k] += 1
        position[o] = seen[k]
    marked = mark_repeats(df, ["k"], ["_ord"], "again").collect()
    assert {r._ord: r.again for r in marked} == {o: n > 1 for o, n in position.items()}
    numbered = number_in_key(df, ["k"], "_ord", "n", span=37).collect()
    assert {r._ord: r.n for r in numbered} == position


def test_uniquify(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "x"), (4, "y")], "_ord bigint, id string")
    assert {r._ord: r.id for r in uniquify_ids(df, "id", "_ord").collect()} == {
        1: "x", 2: "x_1", 3: "x_2", 4: "y"
    }


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(no_broadcast, keyed, how):
    rows, df = keyed
    right = no_broadcast.createDataFrame(
        [("hot", 1), ("hot", 2), ("a", 3), ("zzz", 4), (None, 5)], "k string, w int"
    )
    left = df.unionByName(no_broadcast.createDataFrame([(9999, None, 0)], df.schema))
    got = skew_join(left, right, ["k"], how, ["_ord"], hot_keys(left, ["k"], 10))
    plain = skew_join(left, right, ["k"], how)
    partners = defaultdict(list)
    for k, w in (("hot", 1), ("hot", 2), ("a", 3)):
        partners[k].append(w)
    expected = sorted(
        ((o, w) for o, k, _ in rows + [(9999, None, 0)]
         for w in (partners.get(k) or ([None] if how == "left" else []))), key=str,
    )
    for found in (got, plain):
        assert sorted(((r._ord, r.w) for r in found.collect()), key=str) == expected


def test_hot_keys_spread_over_salts(no_broadcast, keyed):
    hot = {r.k: r._salts for r in hot_keys(keyed[1], ["k"], rows_per_salt=50).collect()}
    assert hot["hot"] == 6 and set(hot) <= set("abcdef") | {"hot"}


def test_repeating_the_right_side_is_refused(spark, keyed):
    with pytest.raises(ValueError):
        skew_join(keyed[1], keyed[1].select("k"), ["k"], "full")
