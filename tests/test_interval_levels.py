"""Overlap joins of intervals from one base to a whole chromosome."""

from __future__ import annotations

import random
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from locusloom.operators import overlaps as O
from test_intervals import brute_pairs

CHROMOSOME = 250_000_000


def mixed(rng, n, tag, lengths):
    out = []
    for i in range(n):
        length = rng.choice(lengths)
        start = rng.randrange(0, max(1, CHROMOSOME - length))
        if rng.random() < 0.3:  # many of them lie near one place, or start at the edge of a bin
            start = rng.choice([640_000 * 8, 100_000_000, 99_999_990]) - rng.randrange(3) * length // 2
        out.append((f"{tag}{i}", rng.choice("ab"), max(0, start), max(0, start) + length))
    return out


def frame(spark, data, name):
    return spark.createDataFrame(data, f"{name} string, contig string, start bigint, end bigint")


@pytest.mark.parametrize("width", [10_000, 1_000_000])
@pytest.mark.parametrize("hot", [(1_000_000, 1_000_000), (20, 50)])
def test_all_lengths(spark, width, hot):
    rng = random.Random(width)
    lengths = [0, 1, 100, 9_999, 10_000, 10_001, 79_999, 1_000_000, 60_000_000, CHROMOSOME]
    left, right = mixed(rng, 400, "l", lengths), mixed(rng, 120, "r", lengths)
    got = O.interval_intersect(frame(spark, left, "l"), frame(spark, right, "r"), width, *hot)
    assert rows(got, "l", "r", "contig", "start", "end") == brute_pairs(left, right)


def test_top_level_and_nulls(spark):
    far = 3 * 10**11
    left = [("x", "a", 0, far), ("y", "a", far - 5, far + 5), (None, None, 1, 2), ("n", "a", None, 5), ("m", "a", 5, None)]
    right = [("p", "a", 7, 9), ("q", "a", far - 1, far), ("r", "a", far + 5, far + 6), ("s", "a", 0, 2 * far), ("t", None, 0, 9), ("u", "a", None, None)]
    whole = [r for r in left if None not in r], [r for r in right if None not in r]
    assert rows(O.interval_intersect(frame(spark, left, "l"), frame(spark, right, "r")), "l", "r", "contig", "start", "end") == brute_pairs(*whole)


def test_rows_before_the_join(spark):
    """Chromosome-long intervals would be 25,000 rows each with bins of one width."""
    rng = random.Random(7)
    reads = mixed(rng, 3_000, "l", [100, 150])
    genes = mixed(rng, 300, "r", [500, 3_000, 40_000, CHROMOSOME])
    left = frame(spark, reads, "l").withColumnsRenamed({"start": "_ls", "end": "_le"})
    right = frame(spark, genes, "r").withColumnsRenamed({"start": "_rs", "end": "_re"})
    width = O.OVERLAP_BIN
    levels = O.levels_in_use(right, "_rs", "_re", width)
    assert levels.collect()[0]._levels == 0b100011
    n_left = O.binned_left(left, levels, "_ls", "_le", width).count()
    n_right = O.binned_right(right, "_rs", "_re", width).count()
    assert n_left <= len(reads) * 3.5  # home, and probes at the two higher levels in use
    assert n_right <= len(genes) * O.LEVELS * 1.25
    assert n_left + n_right <= (len(reads) + len(genes)) * O.LEVELS

    short = right.where(F.col("_re") - F.col("_rs") <= 3_000)
    only_homes = O.binned_left(left, O.levels_in_use(short, "_rs", "_re", width), "_ls", "_le", width).count()
    assert only_homes <= len(reads) * 1.2  # the fixture puts every eighth on the edge of a bin


def test_probes_of_both_sides_do_not_meet(spark):
    """Two long intervals draw the probes of all short ones to their bins; the short ones are joined in narrow bins only."""
    n = 2_000
    one = spark.range(n).select(F.concat(F.lit("l"), "id").alias("l"), F.lit("a").alias("contig"), (F.col("id") * 20_000).alias("start"), (F.col("id") * 20_000 + 50).alias("end"))
    other = spark.range(n).select(F.concat(F.lit("r"), "id").alias("r"), F.lit("a").alias("contig"), (F.col("id") * 20_000 + 10_000).alias("start"), (F.col("id") * 20_000 + 10_050).alias("end"))
    long = spark.createDataFrame([("long", "a", 0, CHROMOSOME)], "x string, contig string, start bigint, end bigint")
    left, right = one.union(long), other.union(long)
    width = O.OVERLAP_BIN
    a, b = left.withColumnsRenamed({"start": "_ls", "end": "_le"}), right.withColumnsRenamed({"start": "_rs", "end": "_re"})
    keys = ["contig", "_slot", "_bin"]
    met = O.binned_left(a, O.levels_in_use(b, "_rs", "_re", width), "_ls", "_le", width).join(O.binned_right(b, "_rs", "_re", width), keys).count()
    assert met < 3 * 2 * n
    assert O.interval_intersect(left, right).count() == 2 * n + 1


def test_bins_are_never_broadcast(spark, tmp_path):
    """The file is small, its rows of bins need not be: their join must not rest on the size of the file."""
    frame(spark, mixed(random.Random(3), 200, "r", [100, 3_000]), "r").write.parquet(str(tmp_path / "r"))
    left = frame(spark, mixed(random.Random(4), 200, "l", [100]), "l")
    found = O.interval_intersect(left, spark.read.parquet(str(tmp_path / "r")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = set(re.findall(r"(\w+Join)\S* \[contig#\d+, _slot#\d+, _bin#\d+L, _slice#\d+\]", plan))
    assert joins == {"SortMergeJoin"}
