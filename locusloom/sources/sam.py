"""Alignment text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import is_header_line, sam_fields


def scan_sam_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines, headers included: (line) plus partition columns of the folder."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def sam_header(lines: DataFrame) -> DataFrame:
    return lines.where(is_header_line(F.col("line")))


def scan_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records with typed columns (see ``sam_fields``); the raw line is kept."""
    return sam_fields(scan_sam_lines(spark, path))
