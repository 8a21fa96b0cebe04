"""Recalibration with more levels than fit a cap, and with several slices of several read groups."""

from __future__ import annotations

import math

import pytest
from helpers import reads
from pyspark.sql import functions as F

from locusloom.operators import recal

CYCLES, GROUPS, QUALITIES = 10_000, 6, 94


def test_six_groups_of_long_reads(spark):
    """5,640,000 cells by cycle; there is nothing at cycle 7."""
    k = F.col("id")
    cell = spark.range(CYCLES * GROUPS * QUALITIES, numPartitions=8).select(
        F.concat(F.lit("G"), (k % GROUPS).cast("string")).alias("read_group"),
        (F.floor(k / GROUPS) % QUALITIES).cast("int").alias("quality"),
        (F.floor(k / (GROUPS * QUALITIES)) + 1).cast("int").alias("cycle"),
        F.lit(None).cast("string").alias("context"),
        F.lit(998).cast("bigint").alias("observations"),
    )
    table = cell.where("cycle != 7").withColumn("mismatches", (F.col("cycle") % 50 + F.col("quality") % 3).cast("bigint"))
    qual = "".join(chr(33 + i % QUALITIES) for i in range(CYCLES))
    long = reads(spark, [(f"r{g}", 0, "chr1", 1, 30, "10000M", "=", 0, 0, "A" * CYCLES, qual, 0) for g in range(GROUPS)])
    long = long.withColumn("read_group", F.concat(F.lit("G"), F.substring("qname", 2, 1)))
    got = {r.qname: r.new_qual for r in recal.apply_recal(long, table).collect()}
    assert len(got) == GROUPS

    def new(q, cycle):
        total = sum(c % 50 + q % 3 for c in range(1, CYCLES + 1) if c != 7)
        e = -10 * math.log10(((total if cycle == 7 else cycle % 50 + q % 3) + 1) / ((998 * (CYCLES - 1) if cycle == 7 else 998) + 2))
        return chr(33 + min(60, max(1, math.floor(e + 0.5))))

    want = "".join(new(i % QUALITIES, i + 1) for i in range(CYCLES))
    assert all(q == want for q in got.values())


@pytest.mark.parametrize("slice_reads, max_bytes", [(10**6, 10**6), (3, 0), (10**6, 0)])
def test_slices_of_a_group_and_repeated_reads(spark, slice_reads, max_bytes):
    rows = [(f"r{i % 25}", 16 * (i % 2), "chr1", 1, 30, "4M", "=", 0, 0, "ACGT", "5I5?", 0) for i in range(60)]
    df = reads(spark, rows).withColumn("read_group", F.when(F.col("qname") < "r15", "G").when(F.col("qname") < "r2", "H").when(F.col("qname") < "r7", "none"))
    table = spark.createDataFrame(
        [(g, q, c, x, 100 * c, m) for g, m in (("G", 1), ("H", 9), (None, 30)) for q in (20, 40) for c, x in ((1, None), (2, "AC"), (3, "CG"))],
        "read_group string, quality int, cycle int, context string, observations bigint, mismatches bigint",
    )
    e = {(r.read_group, r.level, r.quality, r.cycle, r.context): r.empirical_quality for r in recal.recal_levels(table).collect()}
    want = []
    for r in df.collect():
        out = ""
        for cycle in (1, 2, 3, 4):  # ACGT is its own reverse complement
            char = (r.qual if not r.flag else r.qual[::-1])[cycle - 1]
            q, pair = ord(char) - 33, "ACGT"[cycle - 2 : cycle] if cycle > 1 else None
            top = e.get((r.read_group, "quality", q, None, None))
            if top is not None:
                value = e.get((r.read_group, "cycle", q, cycle, None), top) + e.get((r.read_group, "context", q, None, pair), top) - top
                char = chr(33 + min(60, max(1, math.floor(value + 0.5))))
            out += char
        want.append((r.qname, r.read_group or "", out if not r.flag else out[::-1]))
    result = recal.apply_recal(df, table, slice_reads, max_bytes)
    assert result.columns == [*df.columns, "new_qual"]
    assert sorted((r.qname, r.read_group or "", r.new_qual) for r in result.collect()) == sorted(want)


def test_plan_neither_shuffles_reads_nor_needs_python(spark):
    df = reads(spark, [("a", 0, "chr1", 1, 30, "4M", "=", 0, 0, "ACGT", "5I5?", 0)]).withColumn("read_group", F.col("rname"))
    table = spark.createDataFrame([("G", 20, 1, None, 9, 1)], "read_group string, quality int, cycle int, context string, observations bigint, mismatches bigint")
    plan = recal.apply_recal(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "InArrow" not in plan and "EvalPython" not in plan


def test_odd_reads_keep_what_they_have(spark):
    data = [("null", None, None, "G"), ("empty", "", "", "G"), ("star", "*", "5I5?", "G"), ("short", "AC", "5I5?", "G"), ("nobody", "ACGT", "5I5?", "Z"), ("odd", "ANGT", "5I~!", "G")]
    df = spark.createDataFrame([(n, 0, s, q, g) for n, s, q, g in data], "qname string, flag int, seq string, qual string, read_group string")
    table = spark.createDataFrame([("G", 20, 1, "TT", 98, 0), ("G", 20, 3, "AC", 998, 0), ("G", 40, 2, "GT", 9, 9)], "read_group string, quality int, cycle int, context string, observations bigint, mismatches bigint")
    got = {r.qname: r.new_qual for r in recal.apply_recal(df, table).collect()}
    assert (got["null"], got["empty"], got["nobody"]) == (None, "", "5I5?")
    assert got["star"] == got["short"]  # no context at all
    assert got["odd"][2:] == "~!" and got["odd"][0] == got["star"][0]
    empty = recal.apply_recal(df, table.where("false"))
    assert {r.qname: r.new_qual for r in empty.collect()} == {n: q for n, _, q, _ in data}


def test_levels_are_one_pass(spark):
    table = spark.createDataFrame([("G", 20, 1, None, 5, 1), ("G", 20, 2, "AC", 7, 2), (None, 20, 2, "AC", 3, 0)], "read_group string, quality int, cycle int, context string, observations bigint, mismatches bigint")
    levels = recal.recal_levels(table)
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1
    assert sorted((r.level, r.read_group or "", r.cycle or 0, r.context or "", r.observations, r.mismatches) for r in levels.collect()) == [
        ("context", "", 0, "AC", 3, 0), ("context", "G", 0, "AC", 7, 2), ("cycle", "", 2, "", 3, 0), ("cycle", "G", 1, "", 5, 1), ("cycle", "G", 2, "", 7, 2),
        ("quality", "", 0, "", 3, 0), ("quality", "G", 0, "", 12, 3),
    ]


def test_strand_is_not_asked_base_by_base(spark):
    """The strand and the length of a read are looked at once, not within the walk over its bases."""
    text = recal._renewed()._jc.toString()
    walk = text[text.index("-> chr(") :]
    walk = walk[: walk.index("''")]
    assert "_cycles" in walk and "flag" not in walk and "length" not in walk
