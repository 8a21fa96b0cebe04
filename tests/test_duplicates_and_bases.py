from __future__ import annotations

import math
import re

import pyarrow as pa
import pytest
from helpers import read, reads, rows
from pyspark.sql import functions as F

from locusloom.functions import quality
from locusloom.functions.quality import duplicate_score
from locusloom.operators import bases, duplicates, pileup, recal

HOT = [(1_000_000, 10_000), (1, 100)]


@pytest.mark.parametrize("hot", HOT)
def test_dedup_bucket(spark, hot):
    data = [("b1", 10), ("b2", 10), ("b3", 11), ("b4", 10), ("s1", 5), ("s2", 5)]
    df = reads(spark, [read(q, pos=p) for q, p in data]).withColumn("key", F.when(F.col("qname").like("b%"), 1).otherwise(2))
    kept = duplicates.dedup_bucket(df, min_lines=3, min_hot_rows=hot[0], max_hot_keys=hot[1])
    assert rows(kept, "qname") == [("b1",), ("b3",), ("s1",), ("s2",)]
    assert kept.columns == df.columns
    # 1,23 and 12,3 are different alignments.
    apart = reads(spark, [read("x", pos=1, mapq=23), read("y", pos=12, mapq=3)]).withColumn("key", F.lit(1))
    assert duplicates.dedup_bucket(apart, min_lines=1).count() == 2


@pytest.mark.parametrize("hot", HOT)
def test_mark_duplicates(spark, hot):
    data = [
        read("low", pos=100, qual="+" * 10), read("best", pos=100), read("tie", pos=100),
        read("clip", pos=104, cigar="4S6M"),  # same 5' end once unclipped
        read("rev", pos=91, flag=16), read("rev2", pos=91, cigar="6M4S", flag=16),
        read("alone", pos=500), read("un", "*", 0, "*", flag=4), read("un2", "*", 0, "*", flag=4),
    ]
    df = reads(spark, data).withColumn("library", F.lit("L"))
    marked = duplicates.mark_duplicates(df, *hot)
    flags = dict(rows(marked, "qname", "flag"))
    assert {q for q, f in flags.items() if f & 1024} == {"low", "tie", "clip", "rev2"}
    ((library, examined, dups, rate),) = rows(duplicates.duplicate_metrics(marked))
    assert (library, examined, dups) == ("L", 7, 4)
    assert math.isclose(rate, 4 / 7)


def test_explode_bases(spark):
    df = reads(spark, [read("r", pos=10, cigar="2S3M1I2M2D2M", seq="ACGTACGTAC")])
    got = rows(bases.explode_bases(df, F.lit(11), F.lit(17)), "ref_pos", "read_pos", "base")
    assert got == [(11, 4, "T"), (12, 5, "A"), (13, 7, "G"), (14, 8, "T"), (17, 9, "A")]


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("tile", [4, 1_000])
def test_mask_known_sites(spark, hot, tile):
    df = reads(spark, [read("r", pos=10), read("s", "chr2", pos=10)])
    sites = spark.createDataFrame([("chr1", 12), ("chr1", 12), ("chr1", 19), ("chr2", 9)], "contig string, pos bigint")
    got = bases.mask_known_sites(df, sites, tile, *hot)
    assert rows(got.where("qname = 'r'"), "ref_pos") == [(p,) for p in (10, 11, 13, 14, 15, 16, 17, 18)]
    assert got.where("qname = 's'").count() == 10


def test_covariates(spark):
    df = reads(spark, [read("f", pos=1, cigar="4M", seq="ACGT", qual="!\"#$"),
                       read("r", pos=1, cigar="4M", seq="ACGT", qual="!\"#$", flag=16)])
    got = rows(bases.with_covariates(bases.explode_bases(df, F.lit(1), F.lit(4))), "qname", "read_pos", "quality", "cycle", "context")
    assert got == [
        ("f", 1, 0, 1, None), ("f", 2, 1, 2, "AC"), ("f", 3, 2, 3, "CG"), ("f", 4, 3, 4, "GT"),
        ("r", 1, 0, 4, "GT"), ("r", 2, 1, 3, "CG"), ("r", 3, 2, 2, "AC"), ("r", 4, 3, 1, None),
    ]


def always_a(contig_index, position):
    return F.lit("A")


def recal_reads(spark):
    data = [read(f"r{i}", pos=1, cigar="4M", seq="AAAA" if i % 4 else "AACA", qual="5555") for i in range(40)]
    data += [read("rev", pos=1, cigar="4M", seq="AATA", qual="5I5I", flag=16)]
    return reads(spark, data).withColumn("read_group", F.lit("G")).withColumn("contig_index", F.lit(0))


def test_recal_table_and_levels(spark):
    sites = spark.createDataFrame([("chr1", 1)], "contig string, pos bigint")
    table = recal.recal_table(recal_reads(spark), sites, always_a)
    cells = {(r.quality, r.cycle, r.context): (r.observations, r.mismatches) for r in table.collect()}
    assert cells[(20, 3, "AA")] == (30, 0)
    assert cells[(20, 3, "AC")] == (10, 10)
    assert (20, 1, None) not in cells  # masked on the forward strand
    levels = {(r.level, r.quality, r.cycle, r.context): r for r in recal.recal_levels(table).collect()}
    top = levels[("quality", 20, None, None)]
    assert top.observations == sum(o for (q, _, _), (o, _) in cells.items() if q == 20)
    assert math.isclose(top.empirical_quality, -10 * math.log10((top.mismatches + 1) / (top.observations + 2)))


def test_apply_recal_follows_the_rule(spark):
    df = recal_reads(spark)
    sites = spark.createDataFrame([], "contig string, pos bigint")
    table = recal.recal_counts(df, sites, always_a)
    levels = {(r.level, r.quality, r.cycle, r.context): r.empirical_quality for r in recal.recal_levels(table).collect()}
    other = reads(spark, [read("new", cigar="*", seq="AACAGG", qual="555!55"), read("x", seq="AA", qual="55")])
    other = other.withColumn("read_group", F.when(F.col("qname") == "new", "G").otherwise("unknown"))
    got = {r.qname: r.new_qual for r in recal.apply_recal(other, table).collect()}
    seq, qual = "AACAGG", [20, 20, 20, 0, 20, 20]
    expected = ""
    for i, q in enumerate(qual):
        e = levels.get(("quality", q, None, None))
        if e is None:
            expected += chr(q + 33)
            continue
        cycle = levels.get(("cycle", q, i + 1, None), e)
        context = levels.get(("context", q, None, seq[i - 1 : i + 1]), e) if i else e
        expected += chr(33 + int(min(60, max(1, math.floor(e + (cycle - e) + (context - e) + 0.5)))))
    assert got == {"new": expected, "x": "55"}


@pytest.mark.parametrize("hot", HOT)
def test_pileup_in_overlapping_targets(spark, hot):
    df = reads(spark, [read("r", pos=10, seq="ACGTACGTAC"), read("s", pos=12, seq="TTTTTTTTTT"), read("n", pos=11, seq="N" * 10)])
    targets = spark.createDataFrame([("chr1", 9, 12), ("chr1", 11, 13)], "contig string, start bigint, end bigint")
    got = rows(pileup.pileup_counts(df, targets, 16, *hot), "pos", "depth", "n_a", "n_c", "n_g", "n_t")
    assert got == [(10, 1, 1, 0, 0, 0), (11, 2, 0, 1, 0, 0), (12, 3, 0, 0, 1, 1), (13, 3, 0, 0, 0, 2)]


def test_variant_calls(spark, contigs):
    piles = [  # reference A everywhere
        ("chr1", 1, 20, 20, 0, 0, 0), ("chr1", 2, 20, 10, 10, 0, 0), ("chr1", 3, 20, 0, 0, 10, 10), ("chr1", 4, 20, 19, 1, 0, 0),
    ]
    frame = spark.createDataFrame(piles, "contig string, pos bigint, depth bigint, n_a bigint, n_c bigint, n_g bigint, n_t bigint")
    calls = pileup.variant_calls(frame, contigs, always_a)
    assert rows(calls, "pos", "ref", "alt", "genotype", "alt_count") == [(2, "A", "C", "0/1", 10), (3, "A", "G", "1/1", 10)]
    best = 20 * math.log10(0.5)
    rr = 10 * math.log10(0.99) + 10 * math.log10(0.01)
    assert math.isclose(calls.where("pos = 2").first().confidence, 10 * (best - rr))
    assert calls.where("confidence >= 150").count() == pileup.variant_calls(frame, contigs, always_a, 150.0).count()


def test_missing_qualities_pass_through_recalibration(spark):
    df = reads(spark, [read("a"), read("b", qual="I" * 10)]).withColumn("read_group", F.lit("g")).withColumn("contig_index", F.lit(0))
    table = recal.recal_counts(df, spark.createDataFrame([], "contig string, pos bigint"), lambda i, p: F.lit("A"))
    gone = df.withColumn("qual", F.when(F.col("qname") == "b", F.col("qual")))
    got = dict(rows(recal.apply_recal(gone, table), "qname", "new_qual"))
    assert got["a"] is None and len(got["b"]) == 10


def test_a_read_without_qualities_is_not_the_best_copy(spark):
    df = reads(spark, [read("a"), read("b")]).withColumn("library", F.lit("l"))
    marked = duplicates.mark_duplicates(df.withColumn("qual", F.when(F.col("qname") == "b", F.col("qual"))))
    assert dict(rows(marked, "qname", "flag")) == {"a": 1024, "b": 0}


@pytest.mark.parametrize("hot", [(1_000_000, 1_000_000), (3, 20)])
def test_mark_duplicate_pairs(spark, hot):
    def mates(name, one, two, q=20, flags=(0, 16), contig="chr1", library="L"):
        quals = chr(33 + q) * 10
        return [(name, 65 | flags[0], library, contig, one, "10M", quals), (name, 129 | flags[1], library, contig, two, "10M", quals)]

    data = [
        *mates("best", 100, 300, 30), *mates("copy", 100, 300, 20), *mates("clipped", 100, 300, 25),
        *[(n, f ^ 192, *rest) for n, f, *rest in mates("swapped", 100, 300, 20)],  # the other mate first
        *mates("other_end", 100, 301, 20), *mates("other_strand", 100, 300, 20, (0, 0)), *mates("other_contig", 100, 300, contig="chr2"),
        *mates("other_library", 100, 300, library="M"),
        ("at_pair", 0, "L", "chr1", 100, "10M", "~" * 10),  # a fragment beside a pair's end, however good
        ("frag_best", 0, "L", "chr3", 50, "10M", "I" * 10), ("frag_copy", 0, "L", "chr3", 52, "2S8M", "5" * 10),
        ("half", 65, "L", "chr3", 50, "10M", "5" * 10), ("half", 129 | 4, "L", "*", 0, "*", "I" * 10),  # its mate is unmapped
        ("best", 65 | 256, "L", "chr1", 100, "10M", "I" * 10), ("best", 65 | 2048, "L", "chr3", 50, "10M", "I" * 10),
        ("twice", 0, "L", "chr4", 9, "10M", "I" * 10), ("twice", 0, "L", "chr4", 9, "10M", "I" * 10), ("tie_b", 0, "L", "chr5", 9, "10M", "I" * 10), ("tie_a", 0, "L", "chr5", 9, "10M", "I" * 10),
        ("nobody", 0, None, "chr1", 100, "10M", "I" * 10),
    ]
    data = [(n, f, lib, c, p + 3 if n == "clipped" and p == 100 else p, "3S7M" if n == "clipped" and p == 100 else g, q) for n, f, lib, c, p, g, q in data]
    df = spark.createDataFrame(data, "qname string, flag int, library string, rname string, pos bigint, cigar string, qual string")
    marked = duplicates.mark_duplicate_pairs(df, *hot)
    assert marked.columns == df.columns and marked.count() == len(data)
    got = sorted((r.qname, r.flag & 1023) for r in marked.where("flag & 1024 <> 0").collect())
    want = [(n, 65) for n in ("clipped", "copy")] + [(n, 129 | 16) for n in ("clipped", "copy")] + [("swapped", 129), ("swapped", 65 | 16)]
    want += [("at_pair", 0), ("frag_copy", 0), ("half", 65), ("tie_b", 0)]
    assert got == sorted(want)
    assert duplicates.mark_duplicate_pairs(df.where("false")).collect() == []


def test_mark_duplicate_pairs_deals_reads_twice(spark):
    columns = "qname string, flag int, library string, rname string, pos bigint, cigar string, qual string"
    data = [("a", 65, "L", "c", 9, "10M", "I" * 10), ("a", 145, "L", "c", 90, "10M", "I" * 10), ("b", 65, "L", "c", 9, "10M", "5" * 10), ("b", 145, "L", "c", 90, "10M", "5" * 10)]
    data += [(None, 0, "L", "d", 9, "10M", "I" * 10), ("c", 0, "L", "d", 9, "10M", "5" * 10), (None, 65, "L", "e", 9, "10M", "I"), (None, 145, "L", "e", 90, "10M", "I")]
    marked = duplicates.mark_duplicate_pairs(spark.createDataFrame(data, columns))
    # A read without a name competes, but is never marked.
    assert sorted((r.qname, r.flag & 1023) for r in marked.where("flag & 1024 <> 0").collect()) == [("b", 65), ("b", 145), ("c", 0)]
    plan = marked._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves().size()
    joins = marked._jdf.queryExecution().sparkPlan().toString().count("Join")
    assert (leaves, joins) == (2, 1)  # the reads to tell them apart, the reads to be marked; the kept names meet them once


@pytest.mark.parametrize("columns", [None, ["flag", "qname", "pos"]])
def test_mark_duplicate_pairs_shuffles_reads_once(spark, columns):
    data = [("a", 65, "L", "c", 9, "10M", "I" * 10), ("a", 145, "L", "c", 90, "10M", "I" * 10), ("b", 65, "L", "c", 9, "10M", "5" * 10), ("b", 145, "L", "c", 90, "10M", "5" * 10)]
    # Without a library, with an empty one, without a name, with an empty one, without a position, contig or flag.
    data += [("x", 0, None, "c", 9, "10M", "I"), ("x", 0, "", "c", 9, "10M", "I"), ("y", 0, "", "c", 9, "10M", "5"), (None, 0, "", "c", 9, "10M", "+"), ("", 0, "", "c", 9, "10M", "4")]
    data += [("n", 0, "L", "c", None, "10M", "I"), ("m", 0, "L", "c", None, "10M", "5"), ("m", 16, "L", "c", None, "10M", "5"), ("o", 0, "L", None, 9, "10M", "I"), ("p", None, "L", "c", 9, "10M", "I")]
    reads = spark.createDataFrame(data, "qname string, flag int, library string, rname string, pos bigint, cigar string, qual string")
    marked = duplicates.mark_duplicate_pairs(reads, columns=columns)
    assert marked.columns == (columns or reads.columns)
    copies = {("b", 65), ("b", 145), ("y", 0), ("", 0), ("m", 0)}
    want = sorted(((n, f | 1024 if (n, f) in copies else f, *rest) for n, f, *rest in data), key=str)
    assert sorted(map(tuple, marked.collect()), key=str) == sorted([(r[1], r[0], r[4]) for r in want] if columns else want, key=str)
    plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_COL") == 2 and "ReusedExchange" in plan  # named twice, dealt once


@pytest.mark.parametrize("max_large", [1_000_000, 0])
def test_dedup_bucket_shuffles_large_groups_only(spark, max_large):
    data = [(c, 7, f"q{i}", 100 + i % 3, 30, "10M", "=", 5) for c in (0, 1) for i in range(9 if c else 3)] + [(None, 7, "n", 1, 1, "1M", "=", 1)]
    df = spark.createDataFrame(data, "chunk bigint, key bigint, qname string, pos bigint, mapq int, cigar string, rnext string, pnext bigint")
    kept = duplicates.dedup_bucket(df, 3, max_large_groups=max_large)
    assert sorted((r.chunk or 0, r.qname) for r in kept.collect()) == [(0, "n"), *[(0, f"q{i}") for i in range(3)], *[(1, f"q{i}") for i in range(3)]]
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert ("_slice#" not in plan) == (max_large > 0)  # no reads are dealt by block where the list of blocks is short


def test_duplicate_scores(spark):
    quals = ["", None, "!!!", "0/1", "".join(map(chr, range(33, 127))), "Ié0", "IIII"]
    got = spark.createDataFrame([(i, q) for i, q in enumerate(quals)], "i int, q string").select("i", duplicate_score(F.col("q")).alias("s"))
    want = [None if q is None else sum(ord(c) - 33 for c in q if ord(c) - 33 >= 15) for q in quals]
    assert rows(got) == list(enumerate(want))


@pytest.mark.parametrize("hot", HOT)
def test_mark_duplicates_reads_its_input_twice(spark, hot, tmp_path):
    """Once for the best of each group with its size, once to be marked; hot groups are not counted apart."""
    data = [read(f"r{i:03}", pos=100 + i // 30) for i in range(120)]
    reads(spark, data).withColumn("library", F.lit("L")).write.parquet(str(tmp_path / "r"))
    marked = duplicates.mark_duplicates(spark.read.parquet(str(tmp_path / "r")), *hot)
    assert {q for q, f in rows(marked, "qname", "flag") if not f & 1024} == {"r000", "r030", "r060", "r090"}
    plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert sum("FileScan" in line and f"{tmp_path.name}/r" in line for line in plan.splitlines()) == 1  # the other pass is over


def test_pileup_makes_no_rows_of_bases(spark):
    """Pieces of reads are counted as they are: nothing is generated per base, and counts are right for odd CIGARs and letters."""
    data = [
        read("m", pos=1), read("d", pos=3, cigar="2M2D2M", seq="ACGT"), read("i", pos=3, cigar="2S2M1I3M", seq="TTACGNNN"),
        read("none", pos=5, cigar="3M", seq="*"),
        read("odd", pos=5, cigar="3=1X", seq="éCGa"), read("n", pos=2, cigar="1M6N1M", seq="AC"), read("other", "chr2", pos=4, cigar="4M", seq="GGGG"),
    ]
    df = reads(spark, data + [(*read("null", pos=6, cigar="2M")[:9], None, None, 0)])
    targets = spark.createDataFrame([("chr1", 1, 9), ("chr1", 4, 20), ("chr2", 0, 5)], "contig string, start bigint, end bigint")
    got = pileup.pileup_counts(df, targets)
    bases_of = {}
    for contig, low, high in [("chr1", 1, 20), ("chr2", 0, 5)]:
        for r in bases.explode_bases(df.where(F.col("rname") == contig), F.lit(low + 1), F.lit(high)).select("ref_pos", "base").collect():
            bases_of.setdefault((contig, r.ref_pos), []).append(r.base)
    want = sorted((*at, len(found), *[found.count(b) for b in "ACGT"]) for at, found in bases_of.items())
    assert rows(got) == want and len(want) > 10
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "ref_pos" not in plan and "MapInArrow" in plan


def test_pileup_lays_out_long_reads_in_parts(spark, monkeypatch):
    monkeypatch.setattr(pileup, "CHUNK_BASES", 7)
    df = reads(spark, [read(f"r{i}", pos=1 + 1000 * (i % 2), cigar="5M1D20M", seq="ACGTA" * 5) for i in range(6)])
    targets = spark.createDataFrame([("chr1", 2, 1024)], "contig string, start bigint, end bigint")
    got = {p: tuple(n) for p, *n in rows(pileup.pileup_counts(df, targets), "pos", "depth", "n_a", "n_c", "n_g", "n_t")}
    seq = {1 + i: b for i, b in enumerate("ACGTA")} | {7 + i: b for i, b in enumerate("ACGTA" * 4)}
    want = {p + k: (3, *[3 * (b == x) for x in "ACGT"]) for p, b in seq.items() for k in (0, 1000) if 2 < p + k <= 1024}
    assert got == want


def test_variant_calls_of_reads_make_no_rows_of_bases(spark, contigs):
    df = reads(spark, [read(f"r{i}", pos=10, cigar="4M", seq="ACGT") for i in range(30)])
    targets = spark.createDataFrame([("chr1", 0, 100)], "contig string, start bigint, end bigint")
    calls = pileup.variant_calls(pileup.pileup_counts(df, targets), contigs, lambda index, pos: F.lit("A"), 15.0)
    assert rows(calls, "pos", "alt", "depth", "genotype") == [(11, "C", 30, "1/1"), (12, "G", 30, "1/1"), (13, "T", 30, "1/1")]
    plan = calls._jdf.queryExecution().optimizedPlan().toString()
    assert "ref_pos" not in plan and "MapInArrow" in plan


def test_duplicate_metrics_go_over_marked_reads_once(spark, tmp_path):
    """Marking has found the groups by then: the reads are read once more, for marking and counting together."""
    data = [read(f"r{i:03}", pos=100 + i // 30) for i in range(120)] + [read("un", "*", 0, "*", flag=4)]
    reads(spark, data).withColumn("library", F.lit("L")).write.parquet(str(tmp_path / "r"))
    metrics = duplicates.duplicate_metrics(duplicates.mark_duplicates(spark.read.parquet(str(tmp_path / "r"))))
    assert rows(metrics, "library", "n_examined", "n_duplicates") == [("L", 120, 116)]
    plan = metrics._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert sum("FileScan" in line and f"{tmp_path.name}/r" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("max_few", [50_000, 1])
def test_pileup_with_few_targets_goes_over_reads_once(spark, tmp_path, max_few):
    """Few targets come to the reads, and only pieces in targets are dealt; more of them are met by bins, which are counted first."""
    data = [read(f"r{i}", pos=8 + i % 3, cigar="2M1D4M", seq="ACGTAC") for i in range(90)] + [read("far", pos=500), read("long", pos=3, cigar="9N30M", seq="T" * 30)]
    reads(spark, data).write.parquet(str(tmp_path / "r"))
    targets = spark.createDataFrame([("chr1", 6, 10), ("chr1", 9, 14), ("chr1", 20, 21), ("chr2", 0, 9)], "contig string, start bigint, end bigint")
    counts = pileup.pileup_counts(spark.read.parquet(str(tmp_path / "r")), targets, 4, max_few=max_few)
    bases_of = {}
    for low, high in [(6, 14), (20, 21)]:
        for r in bases.explode_bases(reads(spark, data), F.lit(low + 1), F.lit(high)).select("ref_pos", "base").collect():
            bases_of.setdefault(("chr1", r.ref_pos), []).append(r.base)
    want = sorted((*at, len(found), *[found.count(b) for b in "ACGT"]) for at, found in bases_of.items())
    assert rows(counts) == want and len(want) == 8
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    passes = sum("FileScan" in line and "flag#" in line for line in plan.splitlines())
    assert (passes == 1, "SortMergeJoin" in plan) == (max_few > 1, max_few == 1)


def test_pileup_of_one_crowded_bin_is_cut(spark):
    """All pieces are of one bin, more than a task should get: adaptive execution cuts them, and the counts are added up."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    df = reads(spark, [read(f"r{i}", pos=5, cigar="4M", seq="ACGT") for i in range(20_000)])
    targets = spark.createDataFrame([("chr1", 0, 100)], "contig string, start bigint, end bigint")
    spark.conf.set(advisory, "1k")
    try:
        got = pileup.pileup_counts(df, targets)
        assert rows(got) == [("chr1", 5 + i, 20_000, *[20_000 * (i == j) for j in range(4)]) for i in range(4)]
        assert "AQEShuffleRead skewed" in re.sub("coalesced and ", "", got._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset(advisory)


def test_duplicate_scores_are_added_up_in_arrow_buffers():
    """No letters are turned into objects one by one: parts of an array, nulls and letters of several bytes are read as they lie."""
    quals = ["", None, "!!!", "0/1", "IIII", "Ié0", None, "𝄞5", "0"]
    want = [None if q is None else sum(ord(c) - 33 for c in q if ord(c) - 33 >= 15) for q in quals]
    for low, high in [(0, 9), (0, 0), (1, 2), (2, 5), (4, 8)]:
        part = pa.array(quals).slice(low, high - low)
        assert quality._scores(part).equals(pa.array(want[low:high], pa.int64()))
