"""Coordinate order, region-wise regrouping and the merge of variant lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strict_int

READ_ORDER = ("contig_index", "pos", "qname")


def sort_reads(reads: DataFrame) -> DataFrame:
    """Global coordinate order. The read name breaks ties, so a crowded position can be split."""
    return reads.orderBy(*READ_ORDER)


def regroup_reads(region_reads: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Bring the reads of each region together, in coordinate order.

    Ranges over (region, position, name) cut a region that outgrows one task into several ordered
    partitions instead of gathering it in one.
    """
    columns = ["region", *READ_ORDER]
    ranged = (
        region_reads.repartitionByRange(*columns)
        if n_partitions is None
        else region_reads.repartitionByRange(n_partitions, *columns)
    )
    return ranged.sortWithinPartitions(*columns)


def union_regions(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Results of several regions, one below the other."""
    return reduce(DataFrame.unionByName, others, first)


def header_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line").startswith("#"))


def header_ordinals(lines: DataFrame) -> DataFrame:
    """Number the header lines of every file from 0 in file order (data lines are filtered out first)."""
    in_file = Window.partitionBy("file_no").orderBy("line_no")
    return header_lines(lines).withColumn("ordinal", F.row_number().over(in_file) - 1)


def vcf_key(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    """Variant lines keyed for the merge: (contig_index, pos), header lines (-1, ordinal).

    Lines of unknown contigs or without a readable position have no place in that order: see ``bad_variants``.
    """
    columns = ["file_no", "line_no", "contig_index", "pos", "line"]
    header = header_ordinals(lines).select(
        "file_no", "line_no", F.lit(-1).alias("contig_index"), F.col("ordinal").cast("bigint").alias("pos"), "line"
    )
    data = _located(lines, contigs).where(F.col("contig_index").isNotNull() & F.col("pos").isNotNull())
    return header.select(*columns).unionByName(data.select(*columns))


def _located(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    parts = F.split(F.col("line"), "\t")
    return (
        lines.where(~F.col("line").startswith("#"))
        .withColumn("contig", F.get(parts, F.lit(0)))
        .withColumn("pos", strict_int(F.get(parts, F.lit(1))))
        .join(contigs.select("contig", "contig_index"), "contig", "left")
    )


def bad_variants(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    """Variant lines (file_no, line_no, line) that can't be merged; they are set aside, and work goes on with the rest."""
    return _located(lines, contigs).where(F.col("contig_index").isNull() | F.col("pos").isNull()).select("file_no", "line_no", "line")


VARIANT_ORDER = ("contig_index", "pos", "line")


def distinct_variants(keyed_lines: DataFrame) -> DataFrame:
    return keyed_lines.select(*VARIANT_ORDER).dropDuplicates()


def merge_vcf(keyed_lines: DataFrame) -> DataFrame:
    """One ordered set of lines from all regions: header first, equal lines once.

    Lines are dealt once, by ranges of the whole key: that brings equal lines together, so they are dropped where they
    are, and partitions that are sorted inside are sorted as a whole. A line has as many copies as files that hold it.
    """
    return distinct_variants(keyed_lines.repartitionByRange(*VARIANT_ORDER)).sortWithinPartitions(*VARIANT_ORDER)
