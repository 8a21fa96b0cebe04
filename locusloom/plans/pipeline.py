"""The whole job: alignment lines to balanced, sorted, recalibrated regions and merged variant lines.

Every step is a lazy DataFrame. What is small and used by several later steps (histogram, region map,
recalibration table) is materialized, and so are the reads once duplicates are marked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import duplicates, filters, histogram, intervals, lookups, overlaps, pileup, recal, regions
from ..operators.recal import ReferenceBase
from ..session import materialize


@dataclass
class RegionPlan:
    """Reads with bucket key and region, and what the regions were made from."""

    reads: DataFrame
    histogram: DataFrame
    region_map: DataFrame


def plan_regions(lines: DataFrame, contigs: DataFrame, n_regions: int, dedup: bool = False) -> RegionPlan:
    """Parse lines, keep usable reads, count buckets and number them with balanced regions.

    With ``dedup`` equal alignments in crowded buckets are dropped before anything is counted.
    """
    keyed = lookups.with_bucket_key(filters.good_reads(lines, contigs))
    if dedup:
        keyed = duplicates.dedup_bucket(keyed)
    counts = materialize(histogram.bucket_histogram(keyed), "histogram")
    region_map = materialize(regions.balanced_regions(counts, n_regions), "regions")
    return RegionPlan(regions.join_region_map(keyed, region_map), counts, region_map)


def regions_at_work(plan: RegionPlan, n_partitions: int) -> DataFrame:
    """The reads of whole regions, sorted, on the partitions that work on them; the largest regions start first."""
    placement = materialize(regions.place_regions(plan.region_map, n_partitions), "placement")
    return regions.placed_reads(plan.reads, placement, n_partitions, max_task_rows=None)


def region_intervals(region_reads: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Half-open intervals to work on in each region: what its reads cover, cut to the targets when there are any."""
    merged = intervals.merge_intervals_by_region(region_reads)
    spans = merged.select("region", "contig", (F.col("start") - 1).alias("start"), "end")
    if targets is None:
        return spans.withColumnsRenamed({"start": "bed_start", "end": "bed_end"})
    return overlaps.interval_intersect(spans, targets.select("contig", "start", "end")).select(
        "region",
        "contig",
        F.col("start").alias("bed_start"),
        F.when(F.col("start") == F.col("end"), F.col("end") + 1).otherwise(F.col("end")).alias("bed_end"),
    )


def prepare_reads(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Clean, give a read group, mark duplicates. Stored, since recalibration and calling read them again."""
    cleaned = filters.clean_reads(reads, contigs).drop("aend", "past_end")
    return materialize(duplicates.mark_duplicates(filters.set_read_group(cleaned)), "prepared")


def recalibrate(reads: DataFrame, known_sites: DataFrame, reference_base: ReferenceBase) -> DataFrame:
    """Replace ``qual`` by recalibrated qualities; duplicates do not count towards the table."""
    counted = reads.where(F.col("flag").bitwiseAND(F.lit(duplicates.FLAG_DUPLICATE)) == 0)
    table = materialize(recal.recal_counts(counted, known_sites, reference_base), "recal")
    return recal.apply_recal(reads, table).drop("qual").withColumnRenamed("new_qual", "qual")


def call_lines(
    reads: DataFrame,
    contigs: DataFrame,
    targets: DataFrame,
    reference_base: ReferenceBase,
    min_confidence: float = 0.0,
) -> DataFrame:
    """Variant lines of the reads inside the targets, keyed for ``ordering.merge_vcf``."""
    usable = reads.where(F.col("flag").bitwiseAND(F.lit(duplicates.FLAG_DUPLICATE)) == 0)
    calls = pileup.variant_calls(pileup.pileup_counts(usable, targets), contigs, reference_base, min_confidence)
    return calls.select(
        "contig_index",
        "pos",
        F.concat_ws(
            "\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt",
            F.format_string("%.4f", "confidence"), "genotype",
        ).alias("line"),
    )
