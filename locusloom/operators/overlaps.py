"""Overlap joins on half-open intervals, over bins of several levels.

Bins of level 0 are ``bin_width`` wide, those of each further level eight times wider. An interval lives at the lowest
level whose bins are as wide as it is, so in one or two bins, however long it is: a chromosome-long interval is not
copied to all the narrow bins it spans. Two intervals meet at the higher of their levels: there the long one is at home and the
short one, which touches one or two bins of that level as well, comes as a probe. ``left``, the larger side, sends
probes only to levels at which ``right`` has intervals (a bit mask, found by a small aggregate of ``right``), so where both
sides are short there are none. An interval becomes at most two rows per level, whatever its length (beyond the top level, of
21 billion positions, a row per such stretch).

Homes and probes have slots of their own, and probes never meet probes. A pair is kept only in the bin where its overlap starts,
so it comes out once and no ``distinct`` is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import div
from .filters import aligned_reads
from .intervals import merge_spans, with_previous_end
from .skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys, salted_join

OVERLAP_BIN = 10_000
# Levels of bins, and how many bins of a level make one of the next.
LEVELS = 8
FANOUT = 8
# A list of intervals of which no more than this were counted may be broadcast (eight rows of bins for most of them).
FEW_INTERVALS = 50_000


def read_intervals(reads: DataFrame) -> DataFrame:
    """Aligned reads with half-open ``start``/``end`` and ``contig`` next to their own columns."""
    return (
        aligned_reads(reads)
        .withColumn("contig", F.col("rname"))
        .withColumn("start", F.col("pos") - 1)
        .withColumn("end", F.col("aend"))
    )


def _widths(width: int) -> list[int]:
    return [width * FANOUT**level for level in range(LEVELS)]


def _level(start: str, end: str, width: int) -> Column:
    """The lowest level whose bins are as wide as the interval."""
    length = F.col(end) - F.col(start)
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(length <= _widths(width)[k], k).otherwise(level)
    return F.when(length.isNotNull(), level)


def _level_of(slot: Column) -> Column:
    return slot % LEVELS


def _to_bins(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """A row per bin of the slot's level that the interval touches."""
    wide = F.element_at(F.array(*[F.lit(w) for w in _widths(width)]), _level_of(F.col("_slot")) + 1)
    last = F.greatest(F.col(end) - 1, F.col(start))
    return df.withColumn("_bin", F.explode(F.sequence(div(F.col(start), wide), div(last, wide))))


def _in_slots(df: DataFrame, slots: list[Column]) -> DataFrame:
    return df.withColumn("_slot", F.explode(F.array(*slots))).where(F.col("_slot").isNotNull()).drop("_level")


def levels_in_use(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """One row: ``_levels``, a bit for each level at which ``df`` has intervals."""
    bit = F.call_function("shiftleft", F.lit(1), _level(start, end, width))
    return df.select(bit.alias("_bit")).agg(F.coalesce(F.bit_or("_bit"), F.lit(0)).alias("_levels"))


def binned_left(df: DataFrame, levels: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """Homes in slots 0, 1, ... by level; probes, at higher levels that ``levels`` names, in slots that many further on."""
    level = F.col("_level")
    probes = [F.when((level < k) & (F.col("_levels").bitwiseAND(F.lit(1 << k)) != 0), LEVELS + k) for k in range(1, LEVELS)]
    each = df.withColumn("_level", _level(start, end, width)).crossJoin(F.broadcast(levels))  # one row
    return _to_bins(_in_slots(each, [level, *probes]).drop("_levels"), start, end, width)


def binned_right(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """At home both for the homes and for the probes of the other side, and a probe for its homes at all higher levels."""
    level = F.col("_level")
    probes = [F.when(level < k, k) for k in range(1, LEVELS)]
    each = df.withColumn("_level", _level(start, end, width))
    return _to_bins(_in_slots(each, [level, F.when(level > 0, level + LEVELS), *probes]), start, end, width)


def _meet(left: DataFrame, right: DataFrame, width: int, min_rows: int, max_keys: int, few: bool = False) -> DataFrame:
    """Every overlapping pair once; ``left`` has (contig, _ls, _le), ``right`` (contig, _rs, _re), and both columns of their own."""
    levels = levels_in_use(right, "_rs", "_re", width)
    keys = ["contig", "_slot", "_bin"]
    bins = binned_left(left, levels, "_ls", "_le", width), binned_right(right, "_rs", "_re", width)
    if few:
        pairs = bins[0].join(F.broadcast(bins[1]), keys)
    else:
        # Rows of bins are many times the file that they come from: they are shuffled, never sent to the driver and broadcast.
        hot = hot_keys(binned_left(left.select("contig", "_ls", "_le"), levels, "_ls", "_le", width), keys, min_rows, max_keys)
        pairs = salted_join(*bins, keys, hot=hot, hint="merge")
    wide = F.element_at(F.array(*[F.lit(w) for w in _widths(width)]), _level_of(F.col("_slot")) + 1)
    return (
        pairs.where((F.col("_ls") < F.col("_re")) & (F.col("_rs") < F.col("_le")))
        .where(div(F.greatest("_ls", "_rs"), wide) == F.col("_bin"))
        .drop("_slot", "_bin")
    )


def interval_intersect(
    left: DataFrame,
    right: DataFrame,
    bin_width: int = OVERLAP_BIN,
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    few: bool = False,
) -> DataFrame:
    """Overlapping part of every pair of overlapping intervals.

    Both sides have (contig, start, end) plus columns of their own, with different names. The result
    has the columns of both, ``start``/``end`` being the overlap. Pass the larger side as ``left``:
    its hot bins are sliced. ``few`` says that ``right`` was counted and has at most ``FEW_INTERVALS`` rows: then it
    is broadcast, and ``left`` stays where it is.
    """
    left = left.withColumnRenamed("start", "_ls").withColumnRenamed("end", "_le")
    right = right.withColumnRenamed("start", "_rs").withColumnRenamed("end", "_re")
    return (
        _meet(left, right, bin_width, min_hot_rows, max_hot_keys, few)
        .withColumn("start", F.greatest("_ls", "_rs"))
        .withColumn("end", F.least("_le", "_re"))
        .drop("_ls", "_le", "_rs", "_re")
    )


def interval_semi(
    reads: DataFrame,
    intervals: DataFrame,
    bin_width: int = OVERLAP_BIN,
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Reads that overlap at least one interval, each once.

    The intervals are merged to disjoint ones first, and each keeps the end of the one before it. A
    read then counts only with the first interval it touches - the one whose predecessor ends
    before the read begins - so the join needs no duplicate removal over the reads.
    """
    disjoint = with_previous_end(merge_spans(intervals, 0)).select(
        "contig", F.col("start").alias("_rs"), F.col("end").alias("_re"), "prev_end"
    )
    spans = read_intervals(reads).withColumnRenamed("start", "_ls").withColumnRenamed("end", "_le")
    hits = _meet(spans, disjoint, bin_width, min_hot_rows, max_hot_keys)
    return hits.where(F.col("prev_end").isNull() | (F.col("prev_end") <= F.col("_ls"))).select(*reads.columns)
