"""Sequence dictionary and ignore list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strict_int


def scan_ignore_list(spark: SparkSession, path: str) -> DataFrame:
    """Contig names to leave out, separated by commas or line ends: (contig)."""
    return (
        spark.read.text(path)
        .select(F.explode(F.split("value", ",")).alias("contig"))
        .select(F.trim("contig").alias("contig"))
        .where(F.col("contig") != "")
        .distinct()
    )


def scan_dict(spark: SparkSession, path: str, ignore: DataFrame | None = None) -> DataFrame:
    """Sequence dictionary: (contig_index, contig, length, ignored).

    The first line is a header; contigs are numbered in file order, ignored ones included. A missing
    line end after the last contig is fine. The file is one row here: a dictionary has a line per contig.
    """
    fields = F.split(F.col("_line"), r"\s+")
    contigs = (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(F.split(F.regexp_replace("value", r"\s+$", ""), "\r?\n")).alias("_no", "_line"))
        .where(F.col("_no") > 0)
        .select(
            (F.col("_no") - 1).alias("contig_index"),
            F.regexp_extract(F.get(fields, F.lit(1)), "^[^:]*:(.*)$", 1).alias("contig"),
            strict_int(F.regexp_extract(F.get(fields, F.lit(2)), "^[^:]*:(.*)$", 1)).alias("length"),
        )
    )
    if ignore is None:
        return contigs.withColumn("ignored", F.lit(False))
    listed = ignore.select("contig", F.lit(True).alias("_listed"))
    return contigs.join(listed, "contig", "left").select(
        "contig_index", "contig", "length", F.coalesce("_listed", F.lit(False)).alias("ignored")
    )
