"""Read counts per position bucket, and quality-control counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as C


def chunk_histogram(keyed_reads: DataFrame) -> DataFrame:
    """Reads per (chunk, bucket)."""
    return keyed_reads.groupBy("chunk", "key").agg(F.count(F.lit(1)).alias("n"))


def bucket_histogram(keyed_reads: DataFrame) -> DataFrame:
    """Reads per bucket. Order it with ``orderBy('key')`` where the order matters."""
    return keyed_reads.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def combine_histograms(histograms: DataFrame) -> DataFrame:
    """Sum partial histograms, e.g. of chunks that were counted one by one."""
    return histograms.groupBy("key").agg(F.sum("n").alias("n"))


def region_target(histogram: DataFrame, n_regions: int) -> DataFrame:
    """One row: the read ``total`` and the integer number of reads a region should hold (``target``)."""
    return histogram.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total")).withColumn(
        "target", F.call_function("div", F.col("total"), F.lit(n_regions).cast("bigint"))
    )


def hot_buckets(histogram: DataFrame, n_regions: int) -> DataFrame:
    """Buckets that alone hold more reads than a region should."""
    target = region_target(histogram, n_regions).select("target")
    return histogram.crossJoin(F.broadcast(target)).where(F.col("n") > F.col("target"))  # one-row table


def chunk_qc(classified: DataFrame) -> DataFrame:
    """Per chunk: buckets touched, reads kept, lines that could not be used.

    Counting per (chunk, bucket) first keeps a chunk that holds most of the reads from piling up in
    one task; the second aggregate only sees one row per pair.
    """
    per_bucket = classified.groupBy("chunk", "key").agg(
        F.count_if(F.col("status") == "mapped").alias("_mapped"),
        F.count_if(F.col("status") == "bad").alias("_bad"),
    )
    return per_bucket.groupBy("chunk").agg(
        F.count_if(F.col("_mapped") > 0).alias("n_keys"),
        F.sum("_mapped").alias("n_reads"),
        F.sum("_bad").alias("n_bad_lines"),
    )


def region_qc(region_reads: DataFrame) -> DataFrame:
    """Per region: records seen, reads that can be sorted, records whose alignment text is unusable.

    A record is unusable when its CIGAR does not parse or does not spell as many bases as the read has.
    """
    cigar = F.col("cigar")
    read_length = F.aggregate(
        F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIS=X]"), F.lit(1)),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n.cast("bigint"),
    )
    bad = ~cigar.rlike(r"^(\d+[MIDNSHP=X])+$") | ((F.col("seq") != "*") & (read_length != F.length("seq")))
    return (
        region_reads.withColumn("_bad", F.coalesce(bad, F.lit(True)))
        .withColumn("_sorted", ~F.col("_bad") & ~C.is_unmapped(F.col("flag")) & F.col("contig_index").isNotNull())
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.count_if("_sorted").alias("n_sorted"),
            F.count_if("_bad").alias("n_bad"),
        )
    )
