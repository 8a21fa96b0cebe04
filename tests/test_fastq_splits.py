"""FASTQ files that are cut into splits anywhere, also inside records."""

from __future__ import annotations

import gzip
import random

import pytest
from helpers import rows

from locusloom.sources import fastq


def some_records(rng, n):
    out = []
    for i in range(n):
        size = rng.choice([1, 5, 30, 90, 400])
        seq = "".join(rng.choice("ACGT") for _ in range(size))
        qual = "".join(rng.choice("@+#I") for _ in range(size))  # lines that look like the first and third
        out.append((f"r{i} @x", seq, qual))
    return out


def text_of(records):
    return "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in records)


@pytest.fixture
def narrow(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def expected(chunk, records):
    return [(chunk, i // 2, i % 2 + 1, *r) for i, r in enumerate(records)]


COLUMNS = ["chunk", "rec_no", "mate", "name", "seq", "qual"]


@pytest.mark.parametrize("width", ["700b", "128m"])  # with 128 MB, Spark cuts by the size of all files of a scan
def test_splits_inside_records(spark, tmp_path, narrow, width):
    spark.conf.set("spark.sql.files.maxPartitionBytes", width)
    rng = random.Random(4)
    one, two, tiny = some_records(rng, 120), some_records(rng, 75), some_records(rng, 1)
    (tmp_path / "a.fq").write_text(text_of(one))
    (tmp_path / "b.fq").write_text(text_of(two) + "@cut short\nACGT\n")
    (tmp_path / "tiny.fq").write_text(text_of(tiny).rstrip("\n"))
    (tmp_path / "empty.fq").write_text("")
    with gzip.open(tmp_path / "z.fq.gz", "wt") as f:
        f.write(text_of(two) + "@cut short\n")
    frame = fastq.scan_fastq(spark, str(tmp_path))
    want = expected("a", one) + expected("b", [*two, ("cut short", "ACGT", None)]) + expected("tiny", tiny)
    want += expected("z", [*two, ("cut short", None, None)])
    assert rows(frame, *COLUMNS) == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))


@pytest.mark.parametrize("width", [64, 150, 333])
def test_splits_shorter_than_a_record(spark, tmp_path, narrow, width):
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{width}b")
    records = some_records(random.Random(width), 25)
    (tmp_path / "c.fq").write_text(text_of(records))
    assert rows(fastq.scan_fastq(spark, str(tmp_path)), *COLUMNS) == expected("c", records)


def test_records_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.fq").write_text(text_of(some_records(random.Random(1), 10)))
    plan = fastq.scan_fastq(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union", 1)[1].split("HashAggregate" if "HashAggregate" in plan else "SortAggregate", 1)[0]
    assert "Exchange hashpartitioning" not in whole.split("BroadcastExchange")[0]  # from the scan to the records
    assert "MapInArrow _whole_records" in whole
    assert "file_name" in plan.split("MapInArrow _edges")[1]  # compressed files are left out of the count
