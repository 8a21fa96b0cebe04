"""A linear index over sorted reads: which files, and which positions in them, an interval of the genome needs.

For each file and window of ``WINDOW`` bases there is a row with the first and last position of the reads that reach into the
window, so a read that begins far before it is found as well. A query looks the interval's windows up, opens the listed files
only, and inside them Parquet skips row groups outside the positions. The table has a row per file and window with reads in it,
whatever the number of reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import div
from ..operators.filters import with_alignment_end

WINDOW = 16_384


def build_read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(file, contig_index, window, first_pos, last_pos, n) of the reads that ``sinks.sink_sorted_reads`` wrote to ``folder``.

    The reads have contig_index, pos, flag and cigar; only these columns are read. Unmapped reads aren't in the index.
    """
    files = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("file"), "contig_index", "pos", "flag", "cigar")
    placed = with_alignment_end(files).where(F.col("aend").isNotNull())
    windows = F.sequence(div(F.col("pos") - 1, WINDOW), div(F.greatest("aend", "pos") - 1, WINDOW))
    return (
        placed.withColumn("window", F.explode(windows))
        .groupBy("file", "contig_index", "window")
        .agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count(F.lit(1)).alias("n"))
    )


def files_of_interval(index: DataFrame, contig_index: int, start: int, end: int) -> tuple[list[str], int, int]:
    """Files with reads in the windows of the half-open interval, and the range of their positions."""
    of_interval = (F.col("contig_index") == contig_index) & F.col("window").between(start // WINDOW, max(start, end - 1) // WINDOW)
    found = index.where(of_interval).groupBy("file").agg(F.min("first_pos").alias("low"), F.max("last_pos").alias("high")).collect()
    return sorted(r.file for r in found), min((r.low for r in found), default=0), max((r.high for r in found), default=-1)


def scan_interval(spark: SparkSession, folder: str, index: DataFrame, contig_index: int, start: int, end: int) -> DataFrame:
    """Reads of ``folder`` that overlap the half-open interval; other files than the listed ones aren't opened.

    ``index`` comes from ``build_read_index``, stored; its rows for the interval (a row per file and window) are what the driver sees.
    """
    files, low, high = files_of_interval(index, contig_index, start, end)
    schema = spark.read.parquet(folder).schema
    reads = spark.read.schema(schema).option("basePath", folder).parquet(*files) if files else spark.createDataFrame([], schema)
    near = reads.where((F.col("contig_index") == contig_index) & F.col("pos").between(low, min(high, end)))
    inside = (F.col("pos") - 1 < end) & (F.col("aend") > start)
    return with_alignment_end(near).where(inside).select(*reads.columns)
