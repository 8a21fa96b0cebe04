"""Text lines with their place in the file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Offsets of so many splits (about 200 bytes each) are broadcast; those of more are joined by a shuffle.
MAX_BROADCAST_SPLITS = 100_000


def read_numbered_lines(spark: SparkSession, path: str, continued: bool = False, **options: str) -> DataFrame:
    """Lines of text files: (file, line_no, line), numbered from 0 in each file.

    With ``continued`` the files are parts of one, and numbers go on from part to part.

    Files may be split over tasks. Spark keeps the order of lines inside a split, so the number is the
    count of lines in the file's earlier splits (a table of one row per split) plus the place in the
    split; no task has to see a whole file.
    """
    lines = (
        spark.read.options(**options)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("line"),
        )
    )
    splits = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    if continued:  # one row per split meets in a task here
        part = F.regexp_extract("file", r"part-(\d+)", 1)
        by_file = Window.orderBy(F.length(part), part, "file", "_block")
    else:
        by_file = Window.partitionBy("file").orderBy("_block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "file", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    if lines.rdd.getNumPartitions() <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    return lines.join(offsets, ["file", "_block"]).select(
        "file", (F.col("_id") + F.col("_shift")).alias("line_no"), "line"
    )


def split_lines(spark: SparkSession, path: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """Lines as they lie in splits, in order: (file, block: first byte of the split, alone: the file is one split, line).

    Also those lines alone whose file has several splits, (file, block, line), for a pass that counts what comes before a split.
    Compressed files of a kind that is never split are not even opened by that pass: their names are known from the listing.
    They are a scan of their own in the first result too, so that both passes see the other files alone and cut them alike
    (how Spark cuts files depends on the size of all files of a scan).
    """
    about = F.col("_metadata")
    text = spark.read.options(**options).text(path)
    file, block, line = about["file_path"].alias("file"), about["file_block_start"].alias("block"), F.col("value").alias("line")
    whole = about["file_block_length"] >= about["file_size"]
    packed = about["file_name"].endswith(".gz")
    plain = text.where(~packed)
    lines = text.where(packed).select(file, block, F.lit(True).alias("alone"), line).union(plain.select(file, block, whole.alias("alone"), line))
    return lines, plain.where(~whole).select(file, block, line)


def split_runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Stretches of rows of one split: (file, first byte), first row, row behind the last."""
    if batch.num_rows == 0:
        return
    files = batch.column("file").dictionary_encode()
    number, block = files.indices.to_numpy(), batch.column("block").to_numpy()
    edge = np.flatnonzero((number[1:] != number[:-1]) | (block[1:] != block[:-1])) + 1
    for begin, end in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
        yield (files.dictionary[int(number[begin])].as_py(), int(block[begin])), begin, end
