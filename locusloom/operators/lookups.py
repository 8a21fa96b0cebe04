"""Dictionary lookups.

The dictionary is a small file, so no hint is given: Catalyst broadcasts it because of its file size
and would fall back to a (skew-splitting) sort-merge join if it ever were large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import BIN_WIDTH, BUCKET_WIDTH
from ..functions.keys import bucket_key, div, key_bucket, key_contig


def join_contig_index(reads: DataFrame, contigs: DataFrame, how: str = "inner") -> DataFrame:
    """Add ``contig_index``; with ``how='left'`` unknown contigs keep a null index."""
    return reads.join(contigs.select(F.col("contig").alias("rname"), "contig_index"), "rname", how)


def anti_ignore_list(reads: DataFrame, ignore: DataFrame) -> DataFrame:
    """Drop reads on ignored contigs (``ignore`` has a column ``contig``)."""
    return reads.join(ignore.select(F.col("contig").alias("rname")), "rname", "left_anti")


def with_bucket_key(reads: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    return reads.withColumn("key", bucket_key(F.col("contig_index"), F.col("pos"), width))


def decode_bucket_key(df: DataFrame) -> DataFrame:
    return df.withColumn("contig_index", key_contig(F.col("key"))).withColumn("bucket", key_bucket(F.col("key")))


def used_contigs(contigs: DataFrame) -> DataFrame:
    """Contigs that are not ignored and have a readable length."""
    return contigs.where(~F.col("ignored") & F.col("length").isNotNull())


def contig_array_index(contigs: DataFrame) -> DataFrame:
    """Rank of each contig among those in use (dictionary-sized window)."""
    return used_contigs(contigs).withColumn("array_index", F.row_number().over(Window.orderBy("contig_index")) - 1)


def genome_bins(contigs: DataFrame, bin_width: int = BIN_WIDTH) -> DataFrame:
    """Per used contig: number of bins, number of the first one, and the totals over the dictionary."""
    whole = Window.partitionBy()
    before = Window.orderBy("contig_index").rowsBetween(Window.unboundedPreceding, -1)
    n_bins = F.greatest(F.lit(1).cast("bigint"), div(F.col("length"), bin_width))
    return (
        used_contigs(contigs)
        .withColumn("n_bins", n_bins)
        .withColumn("first_bin", F.coalesce(F.sum("n_bins").over(before), F.lit(0)))
        .withColumn("total_bins", F.sum("n_bins").over(whole))
        .withColumn("total_length", F.sum(F.col("length").cast("bigint")).over(whole))
    )


def bin_numbers(contigs: DataFrame, bin_width: int = BIN_WIDTH) -> DataFrame:
    """One row per bin of the used contigs, numbered without gaps in dictionary order."""
    return (
        genome_bins(contigs, bin_width)
        .withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_bins") - 1)))
        .withColumn("bin_no", F.col("first_bin") + F.col("bin"))
    )


def join_lb_bin(df: DataFrame, contigs: DataFrame, n_lb_regions: int, bin_width: int = BIN_WIDTH) -> DataFrame:
    """Add ``bin_no`` and ``lb_region`` from ``contig_index`` and the base position ``pos``.

    Positions behind the last full bin belong to the last bin of their contig; contigs that have no
    bins go to the last load-balancing region. Bins are arithmetic, so one row per contig is joined.
    """
    bins = genome_bins(contigs, bin_width).select("contig_index", "n_bins", "first_bin", "total_bins")
    per_region = F.greatest(F.lit(1).cast("bigint"), div(F.col("total_bins"), n_lb_regions))
    bin_no = F.col("first_bin") + F.least(div(F.col("pos"), bin_width), F.col("n_bins") - 1)
    last = F.lit(n_lb_regions - 1).cast("bigint")
    return (
        df.join(bins, "contig_index", "left")
        .withColumn("bin_no", bin_no)
        .withColumn("lb_region", F.coalesce(F.least(div(F.col("bin_no"), per_region), last), last).cast("int"))
        .drop("n_bins", "first_bin", "total_bins")
    )
