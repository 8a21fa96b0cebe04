from __future__ import annotations

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from locusloom.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    big = [(i, "hot" if rng.random() < 0.4 else (None if rng.random() < 0.1 else f"k{rng.randrange(50)}")) for i in range(2_000)]
    other = [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5), ("unused", 6)]
    return spark.createDataFrame(big, "id int, k string"), spark.createDataFrame(other, "k string, v int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(sides, how):
    big, other = sides
    salted = skew.salted_join(big, other, ["k"], how, min_rows=10, max_keys=20)
    assert rows(salted.select(*sorted(salted.columns))) == rows(big.join(other, ["k"], how).select(*sorted(salted.columns)))


def test_hot_keys_are_bounded_and_sliced(sides):
    big, _ = sides
    hot = {r["k"]: r["_slices"] for r in skew.hot_keys(big.dropna(), ["k"], min_rows=10, max_keys=20).collect()}
    assert list(hot) == ["hot"]
    assert hot["hot"] > 1
    assert skew.hot_keys(big, ["k"], min_rows=1, max_keys=5).count() < 5


def test_hot_rows_reach_several_slices(sides):
    big, other = sides
    hot = skew.hot_keys(big.select("k").dropna(), ["k"], 10, 20).first()["_slices"]
    used = big.where("k = 'hot'").select(F.pmod(F.xxhash64("id", "k"), F.lit(hot)).alias("s")).distinct().count()
    assert used == hot


@pytest.mark.parametrize("limit", [1, 1_000])
def test_lookup_join_on_both_sides_of_the_size_check(sides, limit):
    big, other = sides
    got = skew.lookup_join(big, other, ["k"], "left", max_rows=limit)
    assert rows(got.select("id", "k", "v")) == rows(big.join(other, ["k"], "left").select("id", "k", "v"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("_slice" in plan) == (limit == 1)
