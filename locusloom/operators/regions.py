"""Cutting the genome into regions of balanced read count."""

from __future__ import annotations

import heapq
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import div, key_contig
from .ordering import READ_ORDER
from .skew import MIN_HOT_ROWS, lookup_join

# The functions below travel to executors whole, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Buckets per page of the two-level prefix sum.
PAGE_BUCKETS = 1_024


def prefix_sums(histogram: DataFrame, page_buckets: int = PAGE_BUCKETS) -> DataFrame:
    """Add ``before``: the reads in all earlier buckets (key order).

    A running sum over the whole table would need one task, so buckets are summed inside pages, pages
    inside contigs, and contigs over the dictionary; each window sees one page, the pages of one
    contig, or one row per contig.
    """
    paged = histogram.withColumn("contig_index", key_contig(F.col("key"))).withColumn(
        "page", div(F.col("key"), page_buckets)
    )
    pages = paged.groupBy("contig_index", "page").agg(F.sum("n").alias("page_n"))
    contig_totals = pages.groupBy("contig_index").agg(F.sum("page_n").alias("contig_n"))
    by_contig = Window.orderBy("contig_index").rowsBetween(Window.unboundedPreceding, -1)
    contig_offsets = contig_totals.select(
        "contig_index", F.coalesce(F.sum("contig_n").over(by_contig), F.lit(0)).alias("contig_before")
    )
    by_page = Window.partitionBy("contig_index").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    page_offsets = (
        pages.withColumn("_sum", F.coalesce(F.sum("page_n").over(by_page), F.lit(0)))
        .join(contig_offsets, "contig_index")
        .select("contig_index", "page", (F.col("_sum") + F.col("contig_before")).alias("page_before"))
    )
    in_page = Window.partitionBy("contig_index", "page").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        paged.withColumn("_sum", F.coalesce(F.sum("n").over(in_page), F.lit(0)))
        .join(page_offsets, ["contig_index", "page"])
        .select("key", "n", (F.col("_sum") + F.col("page_before")).alias("before"))
    )


def _first_over(cumulative: np.ndarray, base: float, position: int) -> int:
    """First bucket from ``position`` on whose inclusive running count exceeds ``base``."""
    return max(int(np.searchsorted(cumulative, base, side="right")), position)


def _stretch_outcomes(stretch: pd.DataFrame) -> pd.DataFrame:
    """What a stretch of buckets does to the running count it is entered with.

    The walk inside the stretch is settled once its first cut is known, and the count carried in
    decides which bucket that is. One row per possible first cut: it applies while
    ``carried + reach > target``; then ``cuts`` regions begin in the stretch and the count is ``left``
    at its end. The last row (``cuts`` 0) is the passage without a cut, which adds ``left`` reads.
    """
    stretch = stretch.sort_values("key")
    n = stretch["n"].to_numpy(np.int64)
    target = int(stretch["target"].iloc[0])
    cumulative = np.cumsum(n)
    size = len(n)
    cuts = np.zeros(size + 1, np.int64)
    left = np.zeros(size + 1, np.int64)
    for first in range(size - 1, -1, -1):
        base = cumulative[first] - n[first]
        following = _first_over(cumulative, base + target, first + 1)
        if following >= size:
            cuts[first], left[first] = 1, cumulative[-1] - base
        else:
            cuts[first], left[first] = cuts[following] + 1, left[following]
    possible = min(_first_over(cumulative, target, 0) + 1, size)
    return pd.DataFrame(
        {
            "stretch": int(stretch["stretch"].iloc[0]),
            "target": target,
            "step": np.arange(possible + 1),
            "reach": np.append(cumulative[:possible], cumulative[-1]),
            "cuts": np.append(cuts[:possible], 0),
            "left": np.append(left[:possible], cumulative[-1]),
        }
    )


def _chain_stretches(outcomes: pd.DataFrame) -> pd.DataFrame:
    """Follow the stretches in order: running count and region number on entering each."""
    carried, region = 0, 0
    entries = []
    for stretch, rows in outcomes.groupby("stretch", sort=True):
        entries.append((stretch, carried, region))
        target = int(rows["target"].iloc[0])
        cutting = rows[(rows["cuts"] > 0) & (rows["reach"] + carried > target)]
        if len(cutting):
            chosen = cutting.loc[cutting["step"].idxmin()]
            carried, region = int(chosen["left"]), region + int(chosen["cuts"])
        else:
            carried += int(rows.loc[rows["cuts"] == 0, "left"].iloc[0])
    return pd.DataFrame(entries, columns=["stretch", "carried", "first_region"])


def _assign_regions(stretch: pd.DataFrame) -> pd.DataFrame:
    stretch = stretch.sort_values("key")
    n = stretch["n"].to_numpy(np.int64)
    target = int(stretch["target"].iloc[0])
    cumulative = np.cumsum(n)
    starts = np.zeros(len(n), np.int64)
    cut = _first_over(cumulative, target - int(stretch["carried"].iloc[0]), 0)
    while cut < len(n):
        starts[cut] = 1
        cut = _first_over(cumulative, cumulative[cut] - n[cut] + target, cut + 1)
    region = int(stretch["first_region"].iloc[0]) + np.cumsum(starts)
    return pd.DataFrame({"key": stretch["key"].to_numpy(), "n": n, "region": region.astype(np.int32)})


def balanced_regions(histogram: DataFrame, n_regions: int) -> DataFrame:
    """Number buckets with regions of about ``total div n_regions`` reads: (key, n, region).

    Buckets are walked in key order; when the running count passes the target, the bucket opens a new
    region and the count starts again with it. (So a first bucket above the target opens region 1.)

    The count resets, so this is no window sum; but a stretch of buckets turns the count carried into
    it into the count carried out of it in only as many ways as it has possible first cuts. The
    histogram is split into about sqrt(n_regions) stretches of equal read count. Each stretch works
    out its outcomes on its own, one small group chains the stretches, and each stretch then numbers
    its buckets. The result is that of the plain walk. No group depends on the number of reads: the
    histogram has a row per 5,000 bases of genome, and a group sees about its sqrt(n_regions)-th part.

    ``histogram`` is read several times, so pass a materialized one.
    """
    stretch_regions = max(1, math.isqrt(n_regions))
    target = histogram.agg(
        div(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint"), n_regions).alias("target")
    )
    tagged = (
        prefix_sums(histogram)
        .crossJoin(F.broadcast(target))  # one-row table
        .withColumn(
            "stretch", div(F.col("before"), F.greatest(F.col("target"), F.lit(1)) * F.lit(stretch_regions))
        )
    )
    outcomes = tagged.groupBy("stretch").applyInPandas(
        _stretch_outcomes, "stretch bigint, target bigint, step bigint, reach bigint, cuts bigint, left bigint"
    )
    entries = (
        outcomes.withColumn("chain", F.lit(0))
        .groupBy("chain")
        .applyInPandas(_chain_stretches, "stretch bigint, carried bigint, first_region bigint")
    )
    return (
        tagged.join(entries, "stretch")
        .groupBy("stretch")
        .applyInPandas(_assign_regions, "key bigint, n bigint, region int")
    )


def join_region_map(keyed_reads: DataFrame, region_map: DataFrame) -> DataFrame:
    """Add ``region`` to reads by bucket key. A key without a region is an error, not a dropped read."""
    tagged = lookup_join(keyed_reads, region_map.select("key", "region"), ["key"], "left")
    return tagged.withColumn(
        "region",
        F.when(F.col("region").isNotNull(), F.col("region")).otherwise(
            F.raise_error(F.concat(F.lit("no region for bucket "), F.col("key").cast("string"))).cast("int")
        ),
    )


def group_by_region(blocks: DataFrame, region_map: DataFrame) -> DataFrame:
    """What each region is made of: its (chunk, bucket) blocks, their reads, and its key range.

    ``blocks`` is a chunk histogram. Only counts are gathered here; reads are brought together by
    ``ordering.regroup_reads``, which can cut a region over several tasks.
    """
    return (
        lookup_join(blocks, region_map.select("key", "region"), ["key"])
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("n_blocks"),
            F.sum("n").alias("n_reads"),
            F.min("key").alias("first_key"),
            F.max("key").alias("last_key"),
        )
    )


def region_count(region_map: DataFrame) -> DataFrame:
    """Number of regions counted by the walk, and of regions that hold a bucket."""
    return region_map.agg(
        (F.max("region") + 1).cast("bigint").alias("n_regions"),
        F.count_distinct("region").alias("n_used_regions"),
    )


def regions_by_size(region_map: DataFrame, limit: int | None = None) -> DataFrame:
    """Regions by read count, largest first; ``limit`` gives the top of the list."""
    sizes = region_map.groupBy("region").agg(F.sum("n").alias("n_reads"))
    ordered = sizes.orderBy(F.desc("n_reads"), "region")
    return ordered if limit is None else ordered.limit(limit)


def region_blocks(blocks: DataFrame, region_map: DataFrame) -> DataFrame:
    """The blocks of every region: (region, chunk, key, n), a row each, so that a region may have any number of them."""
    return lookup_join(blocks, region_map.select("key", "region"), ["key"]).select("region", "chunk", "key", "n")


def place_regions(region_map: DataFrame, n_partitions: int) -> DataFrame:
    """Regions on partitions, longest first: (region, n_reads, partition, load).

    Regions are taken by read count, the largest first, and each goes to the partition with the least reads so far (the
    lowest number among equals). Tasks start in the order of their partitions, so the largest regions start first, and with at
    least as many partitions as regions each is a task of its own. ``load`` has the reads of the whole partition. The table has a row
    per region, whose number is chosen by the caller, and is walked in one task.
    """

    def place(sizes: pd.DataFrame) -> pd.DataFrame:
        sizes = sizes.sort_values(["n_reads", "region"], ascending=[False, True])
        loads = [(0, k) for k in range(n_partitions)]
        chosen = []
        for n in sizes["n_reads"].tolist():
            load, k = heapq.heappop(loads)
            heapq.heappush(loads, (load + n, k))
            chosen.append(k)
        total = {k: load for load, k in loads}
        return sizes.assign(partition=chosen, load=[total[k] for k in chosen])[["region", "n_reads", "partition", "load"]]

    sizes = region_map.groupBy("region").agg(F.sum("n").alias("n_reads"))
    return sizes.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(place, "region int, n_reads bigint, partition int, load bigint")


def placed_reads(
    region_reads: DataFrame, placement: DataFrame, n_partitions: int, max_task_rows: int | None = MIN_HOT_ROWS
) -> DataFrame:
    """Reads on the partitions of their regions (column ``partition``), each region's in coordinate order.

    As long as no partition has more than ``max_task_rows`` reads, each is a task, of that number: so work may rely on whole
    regions (None: always). Beyond that, partitions are cut by ranges over (partition, region, position, name) into tasks of about so many
    reads: taken in the order of the tasks, the reads are still in the order of partitions, regions and coordinates.

    ``placement`` is read twice, so pass a materialized one.
    """
    tagged = lookup_join(region_reads, placement.select("region", "partition"), ["region"])
    largest, total = placement.agg(F.max("load"), F.sum("n_reads")).first()
    if max_task_rows is None or (largest or 0) <= max_task_rows:
        return tagged.repartitionById(n_partitions, F.col("partition")).sortWithinPartitions("region", *READ_ORDER)
    order = ["partition", "region", *READ_ORDER]
    return tagged.repartitionByRange(max(n_partitions, -(-total // max_task_rows)), *order).sortWithinPartitions(*order)
