"""Per-region variant files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strict_int
from .lines import MAX_BROADCAST_SPLITS, read_numbered_lines, split_lines, split_runs


def scan_vcf_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_no, line_no, line); the file path serves as the file's identity."""
    return read_numbered_lines(spark, path).withColumnRenamed("file", "file_no").where(F.col("line") != "")


def _headers(lines: pa.Array) -> np.ndarray:
    return pc.starts_with(lines, "#").to_numpy(zero_copy_only=False)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of a split its lines and header lines."""
    for batch in batches:
        rows = [(*key, end - begin, int(_headers(batch.column("line").slice(begin, end - begin)).sum())) for key, begin, end in split_runs(batch)]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["file", "block", "n", "n_headers"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the file, header lines with their ordinal among these."""
    key, at, ordinal = None, 0, 0
    for batch in batches:
        numbers, ordinals = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        header = _headers(batch.column("line"))
        for found, begin, end in split_runs(batch):
            if found != key:
                key = found
                at, ordinal = (batch.column(c)[begin].as_py() or 0 for c in ("before", "headers_before"))
            numbers[begin:end] = at + np.arange(end - begin)
            ordinals[begin:end] = ordinal + np.cumsum(header[begin:end]) - 1
            at, ordinal = at + end - begin, ordinal + int(header[begin:end].sum())
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(numbers), pa.array(ordinals, mask=~header), batch.column("line")], ["file_no", "line_no", "ordinal", "line"])


def scan_vcf(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    """Lines keyed by (contig_index, pos), header lines by (-1, ordinal), as ``ordering.vcf_key`` gives them, from one scan.

    Lines are numbered where they are read. Only files that are cut into several splits are read a second time, before, to
    count the lines and header lines of each split. Lines without a place in the genome are left out.
    """
    lines, cut = split_lines(spark, path)
    splits = cut.mapInArrow(_counts, "file string, block bigint, n bigint, n_headers bigint").groupBy("file", "block").agg(F.sum("n").alias("n"), F.sum("n_headers").alias("n_headers"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    before = splits.select("file", "block", F.sum("n").over(earlier).alias("before"), F.sum("n_headers").over(earlier).alias("headers_before"))
    if lines.rdd.getNumPartitions() <= MAX_BROADCAST_SPLITS:
        before = F.broadcast(before)
    numbered = lines.join(before, ["file", "block"], "left").mapInArrow(_numbered, "file_no string, line_no bigint, ordinal bigint, line string")
    parts = F.split(F.col("line"), "\t")
    header = F.col("ordinal").isNotNull()
    keyed = (
        numbered.where("line != ''")
        .withColumn("contig", F.when(~header, F.get(parts, F.lit(0))))
        .join(contigs.select("contig", "contig_index"), "contig", "left")
        .withColumn("contig_index", F.when(header, F.lit(-1)).otherwise(F.col("contig_index")))
        .withColumn("pos", F.when(header, F.col("ordinal")).otherwise(strict_int(F.get(parts, F.lit(1)))))
    )
    return keyed.where(F.col("contig_index").isNotNull() & F.col("pos").isNotNull()).select("file_no", "line_no", "contig_index", "pos", "line")
