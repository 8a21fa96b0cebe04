"""The index over sorted reads: same reads as the interval join, few files opened."""

from __future__ import annotations

import random

import pytest
from helpers import read, reads, rows
from pyspark.sql import functions as F

from locusloom import sinks
from locusloom.operators import overlaps
from locusloom.session import materialize
from locusloom.sources import read_index


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(6)
    data = [read(f"r{i}", rng.choice(["chr1", "chr2"]), rng.randrange(1, 900_000), rng.choice(["10M", "4S6M", "5M40000N5M", "8M2D2M"])) for i in range(3_000)]
    data += [read("edge", "chr1", 16_385, "10M"), read("before", "chr1", 16_375, "10M"), read("far", "chr1", 5, "5M880000N5M"), read("u", "chr1", 400_000, "*", flag=4)]
    df = reads(spark, data).withColumn("contig_index", F.when(F.col("rname") == "chr1", 0).otherwise(1)).withColumn("region", F.floor(F.col("pos") / 50_000).cast("int") + 100 * F.col("contig_index"))
    folder = str(tmp_path_factory.mktemp("sorted") / "reads")
    sinks.sink_sorted_reads(df, folder)
    return df, folder, materialize(read_index.build_read_index(spark, folder), "index")


@pytest.mark.parametrize("contig_index, start, end", [(0, 100_000, 101_000), (0, 16_384, 16_385), (0, 16_383, 16_384), (1, 0, 900_000), (0, 870_000, 900_010), (1, 2_000_000, 2_000_100), (5, 0, 10), (0, 400_000, 400_000)])
def test_same_reads_as_the_interval_join(spark, stored, contig_index, start, end):
    df, folder, index = stored
    target = spark.createDataFrame([(f"chr{contig_index + 1}", start, end)], "contig string, start bigint, end bigint")
    want = rows(overlaps.interval_semi(df, target), "qname", "pos")
    found = read_index.scan_interval(spark, folder, index, contig_index, start, end)
    assert rows(found, "qname", "pos") == want
    assert set(found.columns) == set(df.columns)


def test_only_listed_files_are_opened(spark, stored):
    _, folder, index = stored
    everything = len(spark.read.parquet(folder).inputFiles())
    files, low, high = read_index.files_of_interval(index, 0, 300_000, 310_000)
    found = read_index.scan_interval(spark, folder, index, 0, 300_000, 310_000)
    assert {f.rsplit("/", 1)[1] for f in found.inputFiles()} == {f.rsplit("/", 1)[1] for f in files}
    assert 1 <= len(files) <= 4 < everything  # its region, the one before it, and that of a read across the contig
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(contig_index), IsNotNull(pos), EqualTo(contig_index,0), GreaterThanOrEq" in plan  # row groups are skipped
    assert index.count() <= 2 * (900_000 // read_index.WINDOW + 1) * 6


def test_empty(spark, tmp_path):
    df = reads(spark, []).withColumn("contig_index", F.lit(0)).withColumn("region", F.lit(0))
    df.write.parquet(str(tmp_path / "none"))
    index = read_index.build_read_index(spark, str(tmp_path / "none"))
    assert index.count() == 0 and read_index.scan_interval(spark, str(tmp_path / "none"), index, 0, 0, 10).count() == 0
