"""Variant files read in one pass, whole or cut into splits."""

from __future__ import annotations

import gzip
import random

import pytest
from helpers import rows

from locusloom.operators import ordering
from locusloom.sources import vcf


def write_files(folder, n):
    rng = random.Random(n)
    folder.mkdir()
    for k, name in enumerate(["a.vcf", "b.vcf", "c.vcf.gz", "empty.vcf"]):
        lines = ["##v", "##long " + "x" * rng.randrange(60), "#CHROM"] if k < 3 else []
        for i in range(n if k < 3 else 0):
            lines.append(rng.choice(["chr1\t%d\tA", "chr2\t%d\tB\tmore text", "chrUn\t%d\tC", "chr3\t%dx\tC", "", "#late %d"]).replace("%d", str(rng.randrange(9999))))
        text = "\n".join(lines) + ("\n" if k else "")
        if name.endswith(".gz"):
            with gzip.open(folder / name, "wt") as f:
                f.write(text)
        else:
            (folder / name).write_text(text)


@pytest.mark.parametrize("width", ["128m", "97b", "700b"])
def test_same_as_keys_of_numbered_lines(spark, tmp_path, contigs, width):
    write_files(tmp_path / "v", 150)
    want = ordering.vcf_key(vcf.scan_vcf_lines(spark, str(tmp_path / "v")), contigs)
    want_rows = rows(want)
    keys = {"spark.sql.files.maxPartitionBytes": width, "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        found = vcf.scan_vcf(spark, str(tmp_path / "v"), contigs)
        assert found.columns == want.columns and rows(found) == want_rows and len(want_rows) > 200
        assert [r.line for r in ordering.merge_vcf(found).collect()] == [r.line for r in ordering.merge_vcf(want).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lines_are_read_once(spark, tmp_path, contigs):
    write_files(tmp_path / "v", 5)
    plan = vcf.scan_vcf(spark, str(tmp_path / "v"), contigs)._jdf.queryExecution().executedPlan().toString()
    # Compressed files, other files, and once more the latter for the lines before each split.
    assert plan.count("FileScan text") == 3 and plan.count("Union") == 1
