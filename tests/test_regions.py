from __future__ import annotations

import random
from collections import Counter

import pytest
from helpers import rows, walk_regions
from pyspark.sql import functions as F

from locusloom.constants import KEY_SCALE
from locusloom.operators import histogram as H
from locusloom.operators import regions as R


def frame(spark, histogram):
    return spark.createDataFrame(histogram, "key bigint, n bigint")


def random_histogram(seed, buckets, heavy=()):
    rng = random.Random(seed)
    keys = sorted({rng.randrange(4) * KEY_SCALE + rng.randrange(6_000) for _ in range(buckets)})
    counts = [rng.randint(1, 30) for _ in keys]
    for place, share in heavy:
        counts[int(place * (len(keys) - 1))] = int(share * sum(counts))
    return list(zip(keys, counts, strict=True))


@pytest.mark.parametrize("n_regions", [1, 2, 7, 64, 500, 100_000])
@pytest.mark.parametrize("heavy", [(), ((0.0, 0.5),), ((0.4, 0.5), (0.401, 1.0)), ((1.0, 2.0),)])
def test_same_as_plain_walk(spark, n_regions, heavy):
    histogram = random_histogram(n_regions, 1_500, heavy)
    got = rows(R.balanced_regions(frame(spark, histogram), n_regions), "key", "n", "region")
    assert got == walk_regions(histogram, n_regions)


def test_first_bucket_above_target_opens_region_one(spark):
    histogram = [(0, 100), (1, 1), (2, 1)]
    got = rows(R.balanced_regions(frame(spark, histogram), 3), "key", "region")
    assert got == [(0, 1), (1, 2), (2, 2)]


def test_one_bucket_and_none(spark):
    assert rows(R.balanced_regions(frame(spark, [(5, 3)]), 2), "key", "n", "region") == [(5, 3, 1)]
    assert rows(R.balanced_regions(frame(spark, []), 2)) == []


def test_region_ids_do_not_decrease_and_keep_all_reads(spark):
    histogram = random_histogram(3, 800)
    got = rows(R.balanced_regions(frame(spark, histogram), 20), "key", "n", "region")
    assert [r for _, _, r in got] == sorted(r for _, _, r in got)
    assert sum(n for _, n, _ in got) == sum(n for _, n in histogram)


def test_prefix_sums(spark):
    histogram = random_histogram(9, 700)
    before, total = [], 0
    for key, n in histogram:
        before.append((key, n, total))
        total += n
    assert rows(R.prefix_sums(frame(spark, histogram), page_buckets=16), "key", "n", "before") == before


def test_unknown_key_fails(spark):
    reads = frame(spark, [(1, 1), (99, 1)])
    region_map = spark.createDataFrame([(1, 0)], "key bigint, region int")
    with pytest.raises(Exception, match="no region for bucket 99"):
        R.join_region_map(reads, region_map).collect()


def test_counts_and_order(spark):
    region_map = spark.createDataFrame([(1, 5, 0), (2, 9, 1), (3, 2, 1), (4, 1, 3)], "key bigint, n bigint, region int")
    assert rows(R.region_count(region_map)) == [(4, 3)]
    assert [tuple(r) for r in R.regions_by_size(region_map, 2).collect()] == [(1, 11), (0, 5)]


def test_hot_buckets_and_target(spark):
    histogram = frame(spark, [(1, 10), (2, 2), (3, 3)])
    assert rows(H.region_target(histogram, 4)) == [(15, 3)]
    assert rows(H.hot_buckets(histogram, 4)) == [(1, 10, 3)]


def test_largest_regions_are_placed_first(spark):
    sizes = [50, 40, 40, 30, 20, 20, 10, 5, 5, 1]
    region_map = spark.createDataFrame([(k * 10 + j, n // 2 if j else n - n // 2, k) for k, n in enumerate(sizes) for j in (0, 1)], "key bigint, n bigint, region int")
    loads, want = [0, 0, 0], []
    for k, n in sorted(enumerate(sizes), key=lambda s: (-s[1], s[0])):
        part = loads.index(min(loads))
        loads[part] += n
        want.append((k, n, part))
    placed = R.place_regions(region_map, 3)
    assert rows(placed) == sorted((k, n, part, loads[part]) for k, n, part in want)
    assert max(loads) - min(loads) <= 20 and want[0] == (0, 50, 0)
    alone = R.place_regions(region_map, 20).orderBy("partition").collect()
    assert [r.partition for r in alone] == list(range(10)) and [r.n_reads for r in alone] == sizes

    reads = spark.range(300).select((F.col("id") % 10).cast("int").alias("region"), F.lit(0).alias("contig_index"), (F.col("id") * 37 % 101).alias("pos"), F.concat(F.lit("r"), "id").alias("qname"))
    found = R.placed_reads(reads, placed, 3).select(F.spark_partition_id().alias("task"), "region", "pos", "qname").collect()
    home = {k: part for k, _, part in want}
    assert len(found) == 300 and all(r.task == home[r.region] for r in found)
    for task in range(3):
        mine = [(r.region, r.pos, r.qname) for r in found if r.task == task]
        assert mine == sorted(mine)


def test_large_partitions_are_cut_into_tasks(spark):
    """No task has a whole partition beyond the limit, and a crowded position is cut too; order and places stay."""
    region_map = spark.createDataFrame([(k, 100, k) for k in range(6)], "key bigint, n bigint, region int")
    placed = R.place_regions(region_map, 2)
    home = dict(placed.select("region", "partition").collect())
    reads = spark.range(600).select(
        (F.col("id") % 6).cast("int").alias("region"), F.lit(0).alias("contig_index"),
        F.when(F.col("id") % 6 == 0, 7).otherwise(F.col("id") * 37 % 101).alias("pos"), F.concat(F.lit("r"), "id").alias("qname"),
    )
    for limit, most in [(50, 100), (300, 300), (None, 300)]:
        found = R.placed_reads(reads, placed, 2, limit).select(F.spark_partition_id().alias("task"), "partition", "region", "pos", "qname").collect()
        assert len({r.qname for r in found}) == len(found) == 600 and all(r.partition == home[r.region] for r in found)
        assert max(Counter(r.task for r in found).values()) <= most
        in_order = sorted(found, key=lambda r: r.task)  # (stable)
        assert [tuple(r[1:]) for r in in_order] == sorted(tuple(r[1:]) for r in found)
        assert (limit == 50) or all(r.task == r.partition for r in found)
