"""As-of join against a plain search, on hot keys cut over many range partitions."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_text
from tidemark.operators.asof import asof_join
from tidemark.operators.ordered import partitions_for


def sides(seed, n=400, keys=12):
    r = random.Random(seed)
    key = lambda: None if r.random() < 0.03 else (0 if r.random() < 0.5 else r.randrange(keys))
    time = lambda: None if r.random() < 0.03 else r.randrange(60)
    return ([(i, key(), time()) for i in range(n)],
            [(key(), time(), r.choice([None, 1.5, 2.5, 3.5]), f"s{r.randrange(4)}") for _ in range(n)])


def plain(left, right, strict):
    out = []
    low = lambda v: (v is not None, v or 0)
    for i, k, t in left:
        fits = [(rt, low(p), s, p) for rk, rt, p, s in right if None not in (k, t, rk, rt) and rk == k and (rt < t if strict else rt <= t)]
        best = max(fits, default=None)
        out.append((i, k, t, *((best[3], best[2]) if best else (None, None))))
    return sorted(out, key=lambda x: x[0])


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("parts", [1, 5, 40])
def test_matches_a_plain_search(spark, parts, strict):
    left, right = sides(parts)
    l_df = spark.createDataFrame(left, "id int, k int, t int").repartition(3)
    r_df = spark.createDataFrame(right, "rk int, rt int, price double, shop string").repartition(4)
    got = asof_join(l_df, r_df, {"k": "rk"}, "t", "rt", ["price", "shop"], strict=strict, num_partitions=parts)
    assert got.columns == ["id", "k", "t", "price", "shop"]
    want = plain(left, right, strict)
    assert sorted((tuple(r) for r in got.collect()), key=lambda x: x[0]) == want
    inner = asof_join(l_df, r_df, {"k": "rk"}, "t", "rt", ["price", "shop"], strict=strict, how="inner", num_partitions=parts)
    assert inner.count() == sum(w[4] is not None for w in want)


def test_one_key_for_all_rows_is_cut(spark):
    left = spark.range(3000).select(F.col("id"), F.lit(1).alias("k"), (F.col("id") * 2).alias("t"))
    right = spark.range(30).select(F.lit(1).alias("k2"), (F.col("id") * 200).alias("rt"), F.col("id").alias("price"))
    got = asof_join(left, right, {"k": "k2"}, "t", "rt", ["price"], num_partitions=16)
    assert got.filter(F.col("price") != F.floor(F.col("t") / 200)).count() == 0
    assert got.filter("price is null").count() == 0
    text = plan_text(got, "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_keys_by_name_nulls_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", None)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 5, None), ("a", 1, "x"), (None, 1, "n")], "k string, rt int, v string")
    got = {r.id: r.v for r in asof_join(left, right, ["k"], "t", "rt", ["v"]).collect()}
    assert got == {1: None, 2: None, 3: None}          # the match at 5 has a null value; the others have none
    assert asof_join(left, right, ["k"], "t", "rt", ["v"], how="inner").count() == 1
    assert asof_join(left.filter("false"), right, ["k"], "t", "rt", ["v"]).count() == 0
    assert asof_join(left, right.filter("false"), ["k"], "t", "rt", ["v"]).count() == 3
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "t", "rt", ["k"])
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "t", "rt", ["v"], how="outer")


def test_partitions_follow_the_size(spark, monkeypatch):
    from tidemark.operators import ordered
    df = spark.range(100_000)
    assert partitions_for(df) == 8
    monkeypatch.setattr(ordered, "BYTES_A_PARTITION", 10_000)
    assert partitions_for(df) == 80
