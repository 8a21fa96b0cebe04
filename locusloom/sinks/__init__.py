"""Writers. These are the only actions in the library besides materialization and size checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import merge_vcf, regroup_reads


def sink_histogram(histogram: DataFrame, path: str) -> None:
    """``key:count`` text."""
    histogram.select(histogram_line().alias("value")).write.text(path)


def histogram_line() -> F.Column:
    return F.concat_ws(":", F.col("key").cast("string"), F.col("n").cast("string"))


def sink_by_lb_region(reads: DataFrame, path: str) -> None:
    """One folder per load-balancing region, clustered by bucket.

    Ranges rather than hashes: a region or bucket that holds a large share of the reads is written by
    several tasks, while each task touches few folders.
    """
    reads.repartitionByRange("lb_region", "key", "qname").write.partitionBy("lb_region").parquet(path)


def sink_region_map(region_map: DataFrame, path: str) -> None:
    region_map.select("key", "region").write.csv(path, sep="\t")


def sink_sorted_reads(region_reads: DataFrame, path: str) -> None:
    """One folder per region with its reads in coordinate order.

    A large region comes as several files; taken by name they continue each other.
    """
    regroup_reads(region_reads).write.partitionBy("region").parquet(path)


def sink_bed(intervals: DataFrame, path: str) -> None:
    """Half-open BED columns, tab-separated."""
    intervals.select("contig", "bed_start", "bed_end").write.csv(path, sep="\t")


def sink_vcf_single(keyed_lines: DataFrame, path: str) -> None:
    """The merged variant lines in order, header first.

    They are range-sorted in parallel; the part files, taken by number, are the one file
    (``read_numbered_lines`` with ``continued`` numbers on over them).
    """
    merge_vcf(keyed_lines).select("line").write.text(path)


def sink_mates(reads: DataFrame, name: str, path: str, n_buckets: int) -> None:
    """One file of a pair (rec_no, name, seq, qual) as a table that lies by record ordinal, for ``pairs.interleave_stored``.

    Both files take the same ``n_buckets`` (``pairs.buckets_for``). Records are shuffled once, here, to a task per bucket, so a
    bucket is one sorted file; every later join of the mates needs no shuffle.
    """
    by_bucket = reads.select("rec_no", "name", "seq", "qual").repartition(n_buckets, "rec_no")
    by_bucket.write.bucketBy(n_buckets, "rec_no").sortBy("rec_no").option("path", path).saveAsTable(name)


def sink_fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    """Interleaved mates, one ``<chunk>.fq`` folder per chunk: columns chunk, rec_no, mate, name, seq, qual.

    Both mates of a record are written as one text value, so splitting the work cannot part them.
    """
    record = F.concat_ws(
        "\n", F.concat(F.lit("@"), F.col("name")), F.col("seq"), F.lit("+"), F.col("qual")
    )
    pairs = (
        reads.groupBy("chunk", "rec_no")
        .agg(F.array_sort(F.collect_list(F.struct("mate", record.alias("text")))).alias("mates"))
        .select(
            F.concat(F.col("chunk").cast("string"), F.lit(".fq")).alias("chunk"),
            "rec_no",
            F.array_join(F.col("mates.text"), "\n").alias("value"),
        )
    )
    (
        pairs.repartitionByRange("chunk", "rec_no")
        .sortWithinPartitions("chunk", "rec_no")
        .select("chunk", "value")
        .write.partitionBy("chunk")
        .option("compression", compression)
        .text(path)
    )
