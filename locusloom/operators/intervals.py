"""Merging intervals by position, without a task that has to see a whole contig.

Intervals are (contig, start, end). Merging depends only on the running maximum of ``end`` in start
order, and it is taken inside tiles of fixed width. A span is copied to every tile it reaches; in the
tiles behind its own all such spans fold into one row without a start that holds their largest end. Rows
with one start are folded as well (on the map side first), so a tile has at most ``tile_width`` + 1
rows however many reads pile up in it, and the input is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import MERGE_GAP
from ..functions import cigar as C
from ..functions.keys import bed_start, div, region_string
from .filters import aligned_reads

TILE_WIDTH = 50_000


def with_previous_end(spans: DataFrame, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Add ``prev_end``, the largest end of all spans of the contig that start earlier.

    Meant for merged interval lists: starts must be distinct within a contig, and ``spans`` is read
    twice. The maximum of earlier tiles is computed on one row per tile and carried into each tile.
    """
    tiled = spans.withColumn("tile", div(F.col("start"), tile_width))
    in_order = Window.partitionBy("contig").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    carries = (
        tiled.groupBy("contig", "tile")
        .agg(F.max("end").alias("_tile_end"))
        .select("contig", "tile", F.max("_tile_end").over(in_order).alias("_carry"))
    )
    in_tile = Window.partitionBy("contig", "tile").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return (
        tiled.join(carries, ["contig", "tile"])
        .withColumn("prev_end", F.greatest(F.max("end").over(in_tile), F.col("_carry")))
        .drop("_carry", "tile")
    )


def merge_spans(spans: DataFrame, gap: int = 0, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Merge spans while ``start <= running end + gap``: (contig, start, end, n_merged)."""
    reach = F.sequence(div(F.col("start"), tile_width), div(F.greatest("start", F.col("end") + F.lit(gap)), tile_width))
    at_home = div(F.col("start"), tile_width) == F.col("tile")
    points = (
        spans.withColumn("tile", F.explode(reach))
        .withColumn("_own", at_home)
        .withColumn("start", F.when(F.col("_own"), F.col("start")))
        .groupBy("contig", "tile", "start")
        .agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("_n"))
    )
    tile = Window.partitionBy("contig", "tile")
    in_order = tile.orderBy(F.col("start").asc_nulls_first())
    earlier_end = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("start").isNotNull() & (earlier_end.isNull() | (F.col("start") > earlier_end + F.lit(gap)))
    fragments = (
        points.withColumn("_opens", opens.cast("int"))
        .withColumn("_no", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("start").isNotNull())
        .groupBy("contig", "tile", "_no")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("_n").alias("_n"),
            F.max("_opens").alias("_opens"),
        )
    )
    # Only the first and last fragment of a tile can belong together with those of other tiles; they
    # are numbered along the contig (at most two rows per tile), all others are finished already.
    lane = Window.partitionBy("contig", "_lane").orderBy("tile", "_no").rowsBetween(Window.unboundedPreceding, 0)
    on_edge = (F.col("_no") == 0) | (F.col("_no") == F.max("_no").over(tile))
    return (
        fragments.withColumn("_lane", F.when(on_edge, F.lit(-1).cast("bigint")).otherwise(F.col("tile")))
        .withColumn("_island", F.sum("_opens").over(lane))
        .groupBy("contig", "_lane", "_island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("_n").alias("n_merged"))
        .select("contig", "start", "end", "n_merged")
    )


def read_spans(reads: DataFrame) -> DataFrame:
    """Mapped reads as 1-based closed spans (contig, start, end)."""
    return (
        aligned_reads(reads)
        .select(F.col("rname").alias("contig"), F.col("pos").alias("start"), F.col("aend").alias("end"))
    )


def merge_intervals(reads: DataFrame, gap: int = MERGE_GAP, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Stretches of the genome covered by reads, closed over gaps: (contig, start, end, n_reads)."""
    return merge_spans(read_spans(reads), gap, tile_width).withColumnRenamed("n_merged", "n_reads")


def merge_intervals_by_region(region_reads: DataFrame, gap: int = MERGE_GAP, tile_width: int = TILE_WIDTH) -> DataFrame:
    """``merge_intervals`` of each region's reads alone: (region, contig, start, end, n_reads).

    Stretches of neighbouring regions are not joined, so lists of regions can be worked on apart.
    """
    spans = aligned_reads(region_reads).select(
        F.concat_ws("\u0001", F.col("region").cast("string"), "rname").alias("contig"), F.col("pos").alias("start"), F.col("aend").alias("end")
    )
    parts = F.split(F.col("contig"), "\u0001", 2)
    kind = region_reads.schema["region"].dataType
    return merge_spans(spans, gap, tile_width).select(
        F.get(parts, F.lit(0)).cast(kind).alias("region"), F.get(parts, F.lit(1)).alias("contig"), "start", "end", F.col("n_merged").alias("n_reads")
    )


def merge_intervals_padded(intervals: DataFrame, overlap: int, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Widen intervals to the left by ``overlap`` (not below 1) and merge those that then overlap.

    Contig names are compared without case; the name of the first interval is kept.
    """
    folded = intervals.withColumn("_name", F.col("contig")).withColumn("contig", F.lower("contig"))
    merged = merge_spans(folded.select("contig", "start", "end"), overlap - 1, tile_width)
    names = folded.groupBy("contig", "start").agg(F.min("_name").alias("name"))
    return merged.join(names, ["contig", "start"]).select(
        F.col("name").alias("contig"),
        F.greatest(F.col("start") - F.lit(overlap), F.lit(1)).alias("start"),
        "end",
        "n_merged",
    )


def bed_convert(intervals: DataFrame) -> DataFrame:
    """1-based closed intervals to half-open BED columns."""
    return intervals.select("contig", bed_start(F.col("start")).alias("bed_start"), F.col("end").alias("bed_end"))


def with_region_string(intervals: DataFrame) -> DataFrame:
    return intervals.withColumn("region_string", region_string(F.col("contig"), F.col("start"), F.col("end")))


def fix_empty_interval(lines: DataFrame) -> DataFrame:
    """BED text lines to three columns; an empty interval gets one base, short lines are skipped."""
    parts = F.split(F.col("line"), "\t")
    end = F.get(parts, F.lit(2)).try_cast("bigint")
    start = F.get(parts, F.lit(1)).try_cast("bigint")
    return lines.where(F.size(parts) >= 3).select(
        F.get(parts, F.lit(0)).alias("contig"),
        start.alias("bed_start"),
        F.when(start == end, end + 1).otherwise(end).alias("bed_end"),
    )


def interval_summary(intervals: DataFrame) -> DataFrame:
    """Per contig: start of the first interval, end of the last one (by start, end), and their number."""
    order: Column = F.struct("start", "end")
    return intervals.groupBy("contig").agg(
        F.min(order)["start"].alias("first_start"),
        F.max(order)["end"].alias("last_end"),
        F.count(F.lit(1)).alias("n_intervals"),
    )


def indel_spans(reads: DataFrame) -> DataFrame:
    """The reference stretch of every insertion (the two bases around it) and deletion in the reads."""
    items = F.filter(C.cigar_items(F.col("cigar")), lambda x: x["op"].isin("I", "D"))
    return (
        reads.where(~C.is_unmapped(F.col("flag")) & C.has_indel(F.col("cigar")))
        .select(F.col("rname").alias("contig"), "pos", F.explode(items).alias("item"))
        .select(
            "contig",
            (F.col("pos") + F.col("item.ref_off") - F.when(F.col("item.op") == "I", 1).otherwise(0)).alias("start"),
            (
                F.col("pos")
                + F.col("item.ref_off")
                + F.when(F.col("item.op") == "D", F.col("item.len") - 1).otherwise(0)
            ).alias("end"),
        )
    )


def indel_targets(reads: DataFrame, gap: int = MERGE_GAP, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Merged windows around insertions and deletions: (contig, start, end, n_indels)."""
    return merge_spans(indel_spans(reads), gap, tile_width).withColumnRenamed("n_merged", "n_indels")
