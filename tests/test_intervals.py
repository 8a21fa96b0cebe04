from __future__ import annotations

import random

import pytest
from helpers import merge_plain, read, reads, rows

from locusloom.operators import intervals as I
from locusloom.operators import overlaps as O

SPAN = "contig string, start bigint, end bigint"


def spans(spark, data):
    return spark.createDataFrame(data, SPAN)


def random_spans(seed, n=1_500, longest=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        start = rng.choice([rng.randrange(1, 60_000), rng.randrange(20_000, 20_050)])
        length = rng.randrange(1, 30_000) if rng.random() < 0.01 else rng.randrange(1, longest)
        out.append((rng.choice(["a", "b"]), start, start + length - 1))
    return out


@pytest.mark.parametrize("gap", [0, 51])
@pytest.mark.parametrize("tile_width", [64, 1_000, 50_000])
@pytest.mark.parametrize("longest", [5, 300])
def test_merge_equals_one_pass(spark, gap, tile_width, longest):
    data = random_spans(gap + tile_width + longest, 600, longest)
    assert rows(I.merge_spans(spans(spark, data), gap, tile_width)) == merge_plain(data, gap)


def test_merged_intervals_are_disjoint_and_cover_every_span(spark):
    data = random_spans(5)
    merged = rows(I.merge_spans(spans(spark, data), 10, 500))
    for (c1, _, e1, _), (c2, s2, _, _) in zip(merged, merged[1:], strict=False):
        assert c1 != c2 or s2 > e1 + 10
    for contig, start, end in data:
        assert any(c == contig and s <= start and end <= e for c, s, e, _ in merged)


def test_gap_is_closed_up_to_51(spark):
    near = reads(spark, [read("r1", pos=100), read("r2", pos=109 + 51)])
    far = reads(spark, [read("r1", pos=100), read("r2", pos=109 + 52)])
    assert rows(I.merge_intervals(near)) == [("chr1", 100, 169, 2)]
    assert rows(I.merge_intervals(far)) == [("chr1", 100, 109, 1), ("chr1", 161, 170, 1)]


def test_contig_change_single_read_and_nothing(spark):
    two = reads(spark, [read("r1", "chr1", 100), read("r2", "chr2", 100)])
    assert rows(I.merge_intervals(two)) == [("chr1", 100, 109, 1), ("chr2", 100, 109, 1)]
    assert rows(I.merge_intervals(reads(spark, []))) == []
    assert rows(I.merge_intervals(reads(spark, [read("u", flag=4, cigar="*")]))) == []


def test_padded_merge_is_strict_clamps_and_ignores_case(spark):
    data = [("chr1", 20, 100), ("CHR1", 199, 250), ("chr1", 350, 360), ("chr2", 5, 9)]
    assert rows(I.merge_intervals_padded(spans(spark, data), 100)) == [
        ("chr1", 1, 250, 2),
        ("chr1", 250, 360, 1),
        ("chr2", 1, 9, 1),
    ]


def test_previous_end(spark):
    merged = merge_plain(random_spans(8, 300), 0)
    frame = spans(spark, [m[:3] for m in merged])
    expected = []
    for i, (contig, start, _, _) in enumerate(merged):
        expected.append((contig, start, merged[i - 1][2] if i and merged[i - 1][0] == contig else None))
    assert rows(I.with_previous_end(frame, 700), "contig", "start", "prev_end") == sorted(
        expected, key=lambda t: (t[0], t[1])
    )


def test_bed_and_empty_intervals(spark):
    closed = spans(spark, [("chr1", 1, 1), ("chr1", 100, 109)])
    assert rows(I.bed_convert(closed)) == [("chr1", 0, 1), ("chr1", 99, 109)]
    assert rows(I.with_region_string(closed), "region_string") == [("chr1:1-1",), ("chr1:100-109",)]
    lines = spark.createDataFrame([("a\t5\t5",), ("a\t5\t7\tname",), ("a\t5",), ("",)], "line string")
    assert rows(I.fix_empty_interval(lines)) == [("a", 5, 6), ("a", 5, 7)]


def test_interval_summary(spark):
    data = [("a", 5, 50), ("a", 1, 99), ("a", 40, 45), ("b", 2, 3)]
    assert rows(I.interval_summary(spans(spark, data))) == [("a", 1, 45, 3), ("b", 2, 3, 1)]


def test_indel_targets(spark):
    data = reads(spark, [read("r1", pos=100, cigar="5M3D5M"), read("r2", pos=500, cigar="4M2I4M"), read("r3")])
    assert rows(I.indel_targets(data)) == [("chr1", 105, 107, 1), ("chr1", 503, 504, 1)]


# --- overlap joins -----------------------------------------------------------------------------


def brute_pairs(left, right):
    return sorted(
        (i, j, c1, max(s1, s2), min(e1, e2))
        for i, c1, s1, e1 in left
        for j, c2, s2, e2 in right
        if c1 == c2 and s1 < e2 and s2 < e1
    )


@pytest.mark.parametrize("width", [16, 10_000])
@pytest.mark.parametrize("hot", [(1_000_000, 10_000), (5, 50)])
def test_intersect_equals_brute_force(spark, width, hot):
    rng = random.Random(width)

    def some(n, tag):
        out = []
        for i in range(n):
            start = rng.choice([rng.randrange(2_000), 700 + rng.randrange(8)])
            out.append((f"{tag}{i}", rng.choice("ab"), start, start + rng.randrange(0, 90)))
        return out

    left, right = some(300, "l"), some(40, "r")
    got = O.interval_intersect(
        spark.createDataFrame(left, "l string, contig string, start bigint, end bigint"),
        spark.createDataFrame(right, "r string, contig string, start bigint, end bigint"),
        width,
        *hot,
    )
    assert rows(got, "l", "r", "contig", "start", "end") == brute_pairs(left, right)


@pytest.mark.parametrize("width", [16, 10_000])
@pytest.mark.parametrize("hot", [(1_000_000, 10_000), (5, 50)])
def test_semi_gives_each_read_once(spark, width, hot):
    rng = random.Random(width + 1)
    data = [read(f"r{i}", rng.choice(["a", "b"]), rng.choice([rng.randrange(1, 900), 300]), "10M") for i in range(300)]
    data.append(read("u", "a", 5, "*", flag=4))
    targets = []
    for _ in range(30):
        start = rng.randrange(900)
        targets.append((rng.choice(["a", "b"]), start, start + rng.randrange(1, 25)))
    got = rows(O.interval_semi(reads(spark, data), spans(spark, targets), width, *hot), "qname")
    expected = sorted(
        (r[0],)
        for r in data
        if r[5] != "*" and any(c == r[2] and s < r[3] + 9 and r[3] - 1 < e for c, s, e in targets)
    )
    assert got == expected
