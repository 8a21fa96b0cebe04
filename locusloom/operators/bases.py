"""From reads to aligned bases.

Exploding reads multiplies rows by the read length, so everything that needs a join (known sites,
targets) is joined while rows are still reads, and the exploded rows go straight into an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PHRED_OFFSET
from ..functions import cigar as C
from ..functions.keys import div
from .filters import aligned_reads
from .skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys, salted_join

# Width of the tiles on which reads meet known sites; also the most sites one tile can list.
SITE_TILE = 1_000


def explode_bases(reads: DataFrame, first: Column, last: Column, without: Column | None = None) -> DataFrame:
    """One row per aligned base (M, =, X) between reference positions ``first`` and ``last``, inclusive.

    Positions in the array ``without`` (may be null) are taken out before the rows are made. Adds ``ref_pos`` and ``read_pos`` (both 1-based) and ``base``.
    """
    aligned = F.filter(C.cigar_items(F.col("cigar")), lambda x: x["op"].isin("M", "=", "X"))
    begin = F.col("pos") + F.col("_item.ref_off")
    kept = F.sequence("_from", "_to")
    if without is not None:
        kept = F.when(without.isNull(), kept).otherwise(F.array_except(kept, without))
    return (
        reads.withColumn("_first", first.cast("bigint"))
        .withColumn("_last", last.cast("bigint"))
        .withColumn("_item", F.explode(aligned))
        .withColumn("_from", F.greatest(F.col("_first"), begin))
        .withColumn("_to", F.least(F.col("_last"), begin + F.col("_item.len") - 1))
        .where(F.col("_from") <= F.col("_to"))
        .withColumn("ref_pos", F.explode(kept))
        .withColumn("read_pos", (F.col("ref_pos") - begin + F.col("_item.read_off") + 1).cast("int"))
        .withColumn("base", F.substr(F.col("seq"), F.col("read_pos"), F.lit(1)))
        .drop("_first", "_last", "_item", "_from", "_to")
    )


def site_tiles(sites: DataFrame, tile_width: int = SITE_TILE) -> DataFrame:
    """Distinct known positions listed per (contig, tile); a list cannot outgrow the tile width."""
    return (
        sites.withColumn("tile", div(F.col("pos"), tile_width))
        .groupBy(F.col("contig").alias("rname"), "tile")
        .agg(F.collect_set(F.col("pos").cast("bigint")).alias("_sites"))
    )


def mask_known_sites(
    reads: DataFrame,
    sites: DataFrame,
    tile_width: int = SITE_TILE,
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Aligned bases of the reads that do not lie on a known site (``sites``: contig, pos).

    An anti-join of exploded bases would shuffle every base. Instead each read is cut into the tiles
    it touches, meets the sites of the tile, and only then is exploded.
    """
    tile_start = F.col("tile") * F.lit(tile_width)
    pieces = (
        aligned_reads(reads)
        .withColumn("tile", F.explode(F.sequence(div(F.col("pos"), tile_width), div(F.col("aend"), tile_width))))
    )
    crowded = aligned_reads(reads).select("rname", div(F.col("pos"), tile_width).alias("tile"))
    hot = hot_keys(crowded, ["rname", "tile"], min_hot_rows, max_hot_keys)
    placed = salted_join(pieces, site_tiles(sites, tile_width), ["rname", "tile"], "left", hot=hot)
    return explode_bases(placed, tile_start, tile_start + F.lit(tile_width - 1), F.col("_sites")).drop("_sites", "tile", "aend")


def complement(base: Column) -> Column:
    return F.translate(base, "ACGT", "TGCA")


def with_covariates(bases: DataFrame) -> DataFrame:
    """Add reported ``quality``, machine ``cycle`` and dinucleotide ``context`` (null at cycle 1).

    Sequences are stored in reference direction, so on the reverse strand cycles count from the end
    and the context is read on the complementary strand.
    """
    read_pos, reverse = F.col("read_pos"), C.is_reverse(F.col("flag"))
    cycle = F.when(reverse, F.length("seq") - read_pos + 1).otherwise(read_pos)
    before = F.when(reverse, complement(F.substr(F.col("seq"), read_pos + 1, F.lit(1)))).otherwise(
        F.substr(F.col("seq"), read_pos - 1, F.lit(1))
    )
    here = F.when(reverse, complement(F.col("base"))).otherwise(F.col("base"))
    return (
        bases.withColumn("quality", F.ascii(F.substr(F.col("qual"), read_pos, F.lit(1))) - PHRED_OFFSET)
        .withColumn("cycle", cycle)
        .withColumn("context", F.when(F.col("cycle") > 1, F.concat(before, here)))
    )
