from __future__ import annotations

import pytest
from helpers import read, reads, rows
from pyspark.sql import functions as F

from locusloom.functions import cigar as C
from locusloom.functions import text as T
from locusloom.operators import filters, lookups, ordering, pairs
from locusloom.operators import histogram as H


def line(*fields):
    return "\t".join(str(f) for f in fields)


LINES = {
    "good": line("r1", 0, "chr1", 12_345, 60, "10M", "=", 1, 0, "ACGTACGTAC", "IIIIIIIIII", "NM:i:0", "XS:A:+"),
    "unmapped": line("r2", 4, "chr1", "zz", 0, "*", "*", 0, 0, "A", "I"),
    "star": line("r3", 0, "*", 0, 0, "*", "*", 0, 0, "A", "I"),
    "ignored": line("r4", 0, "chrX", 5, 0, "1M", "*", 0, 0, "A", "I"),
    "unknown": line("r5", 0, "chr9", 5, 0, "1M", "*", 0, 0, "A", "I"),
    "flag": line("r6", "x", "chr1", 5),
    "pos": line("r7", 0, "chr1", "5.0"),
    "short": "r8\t16",
    "truncated": line("r9", 0, "chr1", 5, 60, "10M", "=", 1, 0),
    "lengths": line("r10", 0, "chr1", 5, 60, "4M", "=", 1, 0, "ACGT", "III"),
    "cigar": line("r11", 0, "chr1", 5, 60, "4Q", "=", 1, 0, "ACGT", "IIII"),
    "empty": "",
    "header": line("@SQ", "SN:chr1", "LN:5"),
}


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(0, v) for v in LINES.values()], "chunk int, line string")


def test_statuses(lines, contigs):
    got = dict(rows(filters.classify_records(filters.sam_fields(lines), contigs), "line", "status"))
    expected = {
        "good": "mapped", "unmapped": "unmapped", "star": "unmapped", "ignored": "ignored",
        "unknown": "bad", "flag": "bad", "pos": "bad", "short": "bad", "empty": "bad",
        "truncated": "bad", "lengths": "bad", "cigar": "bad",
    }
    assert got == {LINES[k]: v for k, v in expected.items()}


def test_good_reads_keep_fields_and_tags(lines, contigs):
    (r,) = filters.good_reads(lines, contigs).collect()
    assert (r.qname, r.flag, r.pos, r.tags, r.contig_index) == ("r1", 0, 12_345, ["NM:i:0", "XS:A:+"], 0)


def test_chunk_qc(lines, contigs):
    classified = lookups.with_bucket_key(filters.classify_records(filters.sam_fields(lines), contigs))
    assert rows(H.chunk_qc(classified)) == [(0, 1, 1, 8)]


def test_bucket_key_round_trip(spark):
    df = spark.createDataFrame([(3, 14_999), (0, 4_999), (1, 5_000)], "contig_index int, pos bigint")
    keyed = lookups.decode_bucket_key(lookups.with_bucket_key(df).select("key"))
    assert rows(keyed) == [(0, 0, 0), (1_000_000_000_001, 1, 1), (3_000_000_000_002, 3, 2)]


@pytest.mark.parametrize(
    ("cigar", "span", "lead", "trail"),
    [("10M", 10, 0, 0), ("3H4S5M2I3M6S", 8, 7, 6), ("2M3D4N1=1X1P", 11, 0, 0), ("5S", 0, 5, 5)],
)
def test_cigar_numbers(spark, cigar, span, lead, trail):
    c = F.lit(cigar)
    got = spark.range(1).select(C.reference_span(c), C.leading_clip(c), C.trailing_clip(c)).first()
    assert tuple(got) == (span, lead, trail)


def test_cigar_items(spark):
    got = spark.range(1).select(C.cigar_items(F.lit("2S3M1I4M2D1M"))).first()[0]
    assert [tuple(i) for i in got] == [
        ("S", 2, 0, 0), ("M", 3, 0, 2), ("I", 1, 3, 5), ("M", 4, 3, 6), ("D", 2, 7, 10), ("M", 1, 9, 10),
    ]


def test_quality_functions(spark):
    df = reads(spark, [read("a", qual="!I" + chr(33 + 60), seq="ACG"), read("b", qual=chr(33 + 61), seq="A"),
                       read("c", qual=chr(33 + 31) + chr(33 + 40), seq="AC")])
    assert rows(filters.with_quality_encoding(df), "qname", "max_quality", "encoding") == [
        ("a", 60, "SANGER"), ("b", 61, "ILLUMINA"), ("c", 40, "SANGER"),
    ]
    fixed = {r.qname: (r.fixed_quals, r.bad_quality) for r in filters.fix_quality(df).collect()}
    assert fixed == {"a": (None, -31), "b": ([30], None), "c": ([0, 9], None)}


def test_text_functions(spark):
    rg = F.lit("@RG\\tID:GROUP1\\tLB:LIB1")
    lb, region = T.region_name_parts(F.lit("3_17.vcf"))
    got = spark.range(1).select(T.read_group_id(rg), T.region_base_name(F.lit("3_17.bed")), lb, region).first()
    assert tuple(got) == ("GROUP1", "3_17", 3, 17)


def test_clean_reads(spark, contigs):
    df = reads(spark, [read("in", "chr2", 399_991), read("over", "chr2", 399_995), read("un", "*", 0, "*", flag=4)])
    assert rows(filters.clean_reads(df, contigs), "qname", "mapq", "aend", "past_end") == [
        ("in", 30, 400_000, False), ("over", 30, 400_000, True), ("un", 0, None, False),
    ]


def test_bins_and_load_balancing(spark, contigs):
    assert rows(lookups.bin_numbers(contigs), "contig", "bin", "bin_no") == [
        ("chr1", 0, 0), ("chr1", 1, 1), ("chr2", 0, 2), ("chr3", 0, 3), ("chr3", 1, 4), ("chr3", 2, 5),
    ]
    assert rows(lookups.contig_array_index(contigs), "contig", "array_index") == [("chr1", 0), ("chr2", 1), ("chr3", 2)]
    df = spark.createDataFrame([(0, 5), (0, 2_400_000), (1, 1), (2, 1), (3, 2_999_999), (None, 1)],
                               "contig_index int, pos bigint")
    assert rows(lookups.join_lb_bin(df, contigs, 3), "contig_index", "pos", "bin_no", "lb_region") == [
        (None, 1, None, 2), (0, 5, 0, 0), (0, 2_400_000, 1, 0), (1, 1, 2, 1), (2, 1, None, 2), (3, 2_999_999, 5, 2),
    ]
    # More load-balancing regions than bins.
    assert {r.lb_region for r in lookups.join_lb_bin(df, contigs, 50).collect()} == {0, 1, 2, 5, 49}


def test_sorting_and_regrouping(spark):
    df = spark.createDataFrame(
        [(1, 0, 7, "b"), (1, 0, 7, "a"), (0, 2, 1, "z"), (0, 0, 9, "q")],
        "region int, contig_index int, pos bigint, qname string",
    )
    assert [r.qname for r in ordering.sort_reads(df).collect()] == ["a", "b", "q", "z"]
    assert [r.qname for r in ordering.regroup_reads(df, 2).collect()] == ["q", "z", "a", "b"]
    assert ordering.union_regions(df, df, df).count() == 12


def test_merge_vcf(spark, contigs):
    files = {
        1: ["##v", "#CHROM", "chr2\t5\tA", "chr1\t9\tB"],
        2: ["##v", "#other", "chr1\t9\tB", "chr1\t10\tC"],
    }
    lines = spark.createDataFrame(
        [(f, i, t) for f, ts in files.items() for i, t in enumerate(ts)], "file_no bigint, line_no bigint, line string"
    )
    keyed = ordering.vcf_key(lines, contigs)
    merged = [r.line for r in ordering.merge_vcf(keyed).collect()]
    assert merged == ["##v", "#CHROM", "#other", "chr1\t9\tB", "chr1\t10\tC", "chr2\t5\tA"]
    again = ordering.merge_vcf(ordering.merge_vcf(keyed))
    assert [r.line for r in again.collect()] == merged


def test_interleave_pairs(spark):
    schema = "rec_no bigint, name string, seq string, qual string"
    first = spark.createDataFrame([(0, "a", "A", "I"), (1, "b", "C", "I")], schema)
    second = spark.createDataFrame([(1, "b", "G", "J"), (2, "c", "T", "J")], schema)
    assert rows(pairs.interleave_pairs(first, second)) == [(1, 1, "b", "C", "I"), (1, 2, "b", "G", "J")]


def test_region_qc(spark):
    df = reads(spark, [read("ok"), read("short", cigar="9M"), read("odd", cigar="10Q"), read("un", flag=4, cigar="10M")])
    df = df.withColumn("region", F.lit(0)).withColumn("contig_index", F.lit(0))
    assert rows(H.region_qc(df)) == [(0, 4, 1, 2)]


def test_merge_vcf_deals_lines_once(spark, contigs):
    lines = spark.createDataFrame([(f, i, f"chr1\t{i}\tx") for f in "abc" for i in range(1, 60)] + [("a", 0, "##v"), ("b", 0, "##v")], "file_no string, line_no long, line string")
    merged = ordering.merge_vcf(ordering.vcf_key(lines, contigs))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Exchange rangepartitioning")[0].count("Exchange") == 0 and plan.count("Exchange rangepartitioning") == 1
    assert [r.line for r in merged.collect()] == ["##v"] + [f"chr1\t{i}\tx" for i in range(1, 60)]
