from __future__ import annotations

import random

from helpers import rows
from pyspark.sql import functions as F

from locusloom.operators import ordering
from locusloom.plans import pipeline


def reference(contig_index, position):
    return F.substr(F.lit("ACGT"), (1 + position % 4).cast("int"), F.lit(1))


def base(position):
    return "ACGT"[position % 4]


def test_from_lines_to_variant_lines(spark, contigs):
    rng = random.Random(4)
    cut = "\t".join(["cut", "0", "chr1", "1000", "60", "20M", "*", "0", "0"])
    lines = ["@HD\tVN:1", "garbage"]
    variant = 1_050
    for i in range(400):
        pos = rng.randrange(1_000, 1_100)
        seq = [base(p) for p in range(pos, pos + 20)]
        if pos <= variant < pos + 20:
            seq[variant - pos] = "G" if base(variant) != "G" else "T"
        lines.append("\t".join(["r%d" % i, "0", "chr1", str(pos), "60", "20M", "*", "0", "0", "".join(seq), "I" * 20]))
    lines.append(lines[2].replace("r0\t", "r0copy\t"))
    lines.append(cut)
    frame = spark.createDataFrame([(i % 3, t) for i, t in enumerate(lines)], "chunk int, line string")

    plan = pipeline.plan_regions(frame, contigs, 4)
    assert plan.reads.count() == 401 == plan.histogram.agg(F.sum("n")).first()[0]

    at_work = pipeline.regions_at_work(plan, 3).select(F.spark_partition_id().alias("task"), "region", "qname")
    assert at_work.count() == 401
    assert all(r[0] == 1 for r in rows(at_work.groupBy("region").agg(F.count_distinct("task").alias("tasks")).select("tasks")))

    prepared = pipeline.prepare_reads(plan.reads, contigs)
    duplicates = prepared.where("flag & 1024 <> 0").count()
    assert duplicates == 401 - prepared.select("pos").distinct().count()

    sites = spark.createDataFrame([("chr1", variant)], "contig string, pos bigint")
    renewed = pipeline.recalibrate(prepared, sites, reference)
    assert renewed.where(F.length("qual") != 20).count() == 0

    targets = spark.createDataFrame([("chr1", 1_000, 1_060)], "contig string, start bigint, end bigint")
    assert {r[1] for r in rows(pipeline.region_intervals(plan.reads, targets))} == {"chr1"}
    called = pipeline.call_lines(renewed, contigs, targets, reference)
    merged = [r.line.split("\t")[:5] for r in ordering.merge_vcf(called).collect()]
    assert merged == [["chr1", str(variant), ".", base(variant), "G" if base(variant) != "G" else "T"]]
