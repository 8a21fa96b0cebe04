"""Interval files, histograms and region maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strict_int

REGION_MAP_SCHEMA = "key bigint, region int"


# What lines that are no intervals begin with.
BED_COMMENT = r"^(@|#|track([ \t]|$)|browser([ \t]|$))"


def _bed_lines(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    return (
        spark.read.text(path)
        .where(~F.col("value").rlike(BED_COMMENT) & (F.trim("value") != ""))
        .select(
            F.col("value").alias("line"),
            F.get(parts, F.lit(0)).alias("contig"),
            strict_int(F.get(parts, F.lit(1))).alias("bed_start"),
            strict_int(F.get(parts, F.lit(2))).alias("bed_end"),
        )
    )


def _is_interval() -> Column:
    return F.coalesce((F.col("contig") != "") & (F.col("bed_start") >= 0) & (F.col("bed_end") >= F.col("bed_start")), F.lit(False))


def scan_bed(spark: SparkSession, path: str) -> DataFrame:
    """Half-open intervals of a BED file or a target list.

    Comment, ``track``, ``browser`` and empty lines are skipped; malformed ones are in ``bad_bed_lines``.
    """
    return _bed_lines(spark, path).where(_is_interval()).drop("line")


def bad_bed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are meant as intervals but can't be read as such."""
    return _bed_lines(spark, path).where(~_is_interval()).select("line")


def scan_histogram(spark: SparkSession, path: str) -> DataFrame:
    """``key:count`` lines, as written chunk by chunk: (key, n). Sum them with ``combine_histograms``."""
    parts = F.split("value", ":")
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).cast("bigint").alias("key"), F.get(parts, F.lit(1)).cast("bigint").alias("n")
    )


def scan_region_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=REGION_MAP_SCHEMA)


def scan_partition(spark: SparkSession, path: str, lb_region: int) -> DataFrame:
    """Reads of one load-balancing region; only its folder is read."""
    return spark.read.parquet(path).where(F.col("lb_region") == lb_region)
