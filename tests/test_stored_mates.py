"""Mates that are stored by ordinal meet without a shuffle."""

from __future__ import annotations

import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from locusloom import sinks
from locusloom.operators import pairs


def mates(spark, n, tag, step=1):
    return spark.range(0, n, step).select(
        F.col("id").alias("rec_no"), F.concat(F.lit(tag), "id").alias("name"), F.repeat(F.lit("A"), (F.col("id") % 7 + 1).cast("int")).alias("seq"), F.lit("I").alias("qual"), F.lit(5).alias("extra")
    )


def store(df, folder, n_buckets):
    name = f"mates_{uuid.uuid4().hex}"
    sinks.sink_mates(df, name, str(folder / name), n_buckets)
    return name


def test_no_exchange(spark, tmp_path):
    first, second = mates(spark, 1_000, "a"), mates(spark, 1_200, "b", 3)
    names = [store(df, tmp_path, 6) for df in (first, second)]
    found = pairs.interleave_stored(spark, *names)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows(found) == rows(pairs.interleave_pairs(first, second))
    for task in found.withColumn("task", F.spark_partition_id()).select("task", F.struct("rec_no", "mate").alias("at")).groupBy("task").agg(F.collect_list("at").alias("at")).collect():
        order = [(a.rec_no, a.mate) for a in task["at"]]
        assert order == sorted(order)


def test_repeated_and_missing_ordinals(spark, tmp_path):
    first = spark.createDataFrame([(1, "x", "A", "I"), (1, "y", "C", "I"), (2, "z", "G", "I"), (None, "n", "T", "I")], "rec_no long, name string, seq string, qual string")
    second = first.where("rec_no = 1 OR rec_no IS NULL")
    names = [store(df, tmp_path, 3) for df in (first, second)]
    found = pairs.interleave_stored(spark, *names)
    assert rows(found) == rows(pairs.interleave_pairs(first, second)) and found.count() == 8
    none = [store(df.where("false"), tmp_path, 3) for df in (first, second)]
    assert pairs.interleave_stored(spark, *none).count() == 0


def test_unlike_buckets_are_an_error(spark, tmp_path):
    df = mates(spark, 10, "a")
    with pytest.raises(ValueError, match="buckets"):
        pairs.interleave_stored(spark, store(df, tmp_path, 2), store(df, tmp_path, 3))
    assert pairs.buckets_for(0) == 1 and pairs.buckets_for(1_000_001) == 2
