"""Line parsing, validation and read filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FLAG_UNMAPPED, LIBRARY, READ_GROUP
from ..functions import cigar as C
from ..functions import quality as Q
from ..functions.text import strict_int

READ_COLUMNS = (
    "qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual",
)


def is_header_line(line: Column) -> Column:
    return line.startswith("@")


def sam_fields(lines: DataFrame) -> DataFrame:
    """Alignment lines (column ``line``, headers left out) as typed columns; unparsable numbers are null."""
    parts = F.split(F.col("line"), "\t")

    def text(i: int) -> Column:
        return F.get(parts, F.lit(i))

    keep = [c for c in lines.columns if c not in READ_COLUMNS]
    return lines.where(~is_header_line(F.col("line"))).select(
        *keep,
        text(0).alias("qname"),
        strict_int(text(1), "int").alias("flag"),
        text(2).alias("rname"),
        strict_int(text(3)).alias("pos"),
        strict_int(text(4), "int").alias("mapq"),
        text(5).alias("cigar"),
        text(6).alias("rnext"),
        strict_int(text(7)).alias("pnext"),
        strict_int(text(8)).alias("tlen"),
        text(9).alias("seq"),
        text(10).alias("qual"),
        F.slice(parts, 12, F.greatest(F.size(parts) - 11, F.lit(0))).alias("tags"),
    )


def is_whole_record() -> Column:
    """Whether all eleven fields of a record are there, its numbers and CIGAR can be read, and its lengths agree."""
    fields = [F.col(c).isNotNull() for c in ("qname", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")]
    cigar = F.col("cigar").rlike(r"^(\*|([0-9]+[MIDNSHP=X])+)$")
    lengths = F.col("seq").isin("*") | F.col("qual").isin("*") | (F.length("seq") == F.length("qual"))
    return F.coalesce(reduce(Column.__and__, [*fields, cigar, lengths]), F.lit(False))


def classify_records(records: DataFrame, contigs: DataFrame) -> DataFrame:
    """Add ``contig_index`` and ``status`` to parsed records.

    The tests run in a fixed order and the first that applies decides: an unreadable flag is
    ``bad``; then ``unmapped``; then ``ignored``; a contig that is not in the dictionary, an unreadable
    position, and a record whose other fields are missing or disagree are ``bad`` as well; everything else is ``mapped``.
    """
    names = contigs.select(F.col("contig").alias("rname"), "contig_index", "ignored")
    return (
        records.join(names, "rname", "left")
        .withColumn(
            "status",
            F.when(F.col("flag").isNull(), "bad")
            .when(C.is_unmapped(F.col("flag")), "unmapped")
            .when(F.col("rname").isNull(), "bad")
            .when(F.col("rname") == "*", "unmapped")
            .when(F.col("ignored"), "ignored")
            .when(F.col("contig_index").isNull() | F.col("pos").isNull() | ~is_whole_record(), "bad")
            .otherwise("mapped"),
        )
        .drop("ignored")
    )


def bad_lines(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    """Lines that cannot be used; they are set aside, and work goes on with the rest."""
    return classify_records(sam_fields(lines), contigs).where(F.col("status") == "bad")


def good_reads(lines: DataFrame, contigs: DataFrame) -> DataFrame:
    """Mapped records of ``lines`` with their contig index."""
    return classify_records(sam_fields(lines), contigs).where(F.col("status") == "mapped").drop("status", "line")


def filter_mapped(reads: DataFrame) -> DataFrame:
    """Drop unmapped reads and reads without a contig."""
    return reads.where((F.col("flag").bitwiseAND(F.lit(FLAG_UNMAPPED)) == 0) & (F.col("rname") != "*"))


def with_alignment_end(reads: DataFrame) -> DataFrame:
    return reads.withColumn("aend", C.alignment_end(F.col("flag"), F.col("pos"), F.col("cigar")))


def aligned_reads(reads: DataFrame) -> DataFrame:
    """Reads that have an alignment end, which is added. (Tested without working the end out.)"""
    return with_alignment_end(reads.where(C.is_aligned(F.col("flag"), F.col("cigar"))))


def with_quality_encoding(reads: DataFrame) -> DataFrame:
    return reads.withColumn("max_quality", Q.max_quality(F.col("qual"))).withColumn(
        "encoding", Q.quality_encoding(F.col("qual"))
    )


def fix_quality(reads: DataFrame) -> DataFrame:
    """Convert qualities of the older encoding: ``fixed_quals``, or null and the offending ``bad_quality``."""
    shifted = Q.shifted_qualities(F.col("qual"))
    return (
        reads.withColumn("_q", shifted)
        .withColumn("bad_quality", Q.first_negative(F.col("_q")))
        .withColumn("fixed_quals", F.when(F.col("bad_quality").isNull(), F.col("_q")))
        .drop("_q")
    )


def set_read_group(reads: DataFrame, read_group: str = READ_GROUP, library: str = LIBRARY) -> DataFrame:
    return reads.withColumn("read_group", F.lit(read_group)).withColumn("library", F.lit(library))


def clean_reads(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Cut alignments at the contig end (``past_end`` marks them) and give unmapped reads MAPQ 0."""
    lengths = contigs.select(F.col("contig").alias("rname"), F.col("length").alias("_length"))
    return (
        with_alignment_end(reads)
        .join(lengths, "rname", "left")
        .withColumn("past_end", F.coalesce(F.col("aend") > F.col("_length"), F.lit(False)))
        .withColumn("aend", F.when(F.col("past_end"), F.col("_length").cast("bigint")).otherwise(F.col("aend")))
        .withColumn("mapq", F.when(C.is_unmapped(F.col("flag")), 0).otherwise(F.col("mapq")))
        .drop("_length")
    )
