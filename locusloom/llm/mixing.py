"""Mixing sources to target weights along a time-varying curriculum.

Every source has a schedule of its weight over training time (0 to 1); its integral is the source's target.
A document's place is how many of its source's words come before it, in an order by hash; inverting the schedule's integral at that many words gives the time at which training has asked for them,
the document's position. Passes over a source follow each other until its target is reached, so a document is
taken once, twice or not at all. Sorting by position (``in_order``) gives the training order.

Running sums never bring a source together: documents fall into cells by hash (``CELLS`` of them for
each source), sums of cells are added up per source, and inside a cell documents add up on their own. Sources are numbered
and targets found by aggregates over the table of sources.

Defined cases: null text has size 0; sources of null are one source that comes last; documents of size 0 are taken 0
words; repeated rows, put in order by a random number that is stored, each get their row; an empty table gives an
empty result; other columns are ignored by ``plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import n_words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
CELLS = 4096
# How much more (or less) than its mean a source weighs at the end than at the begin: heavy ones come later.
SLOPES = (0.5, 0.0, -0.5)


def numbered(sources: DataFrame) -> DataFrame:
    """Places (0, 1, ...) of sources by code point, null last: range partitions with the sizes of those before."""
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "sources")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    later = sizes.select((F.col("_part")).alias("_before"), "_n")
    offsets = sizes.select("_part").join(later, F.col("_before") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    return ranged.join(offsets, "_part").select("source", "source_size", (F.col("_offset") + F.row_number().over(inside) - 1).alias("place"))


def _pick(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (place % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source``, ``source_size``, ``place``, ``weight`` and ``target`` per source.

    A source gets its weight times a level, at most ``most`` times its size; the level is what makes the targets
    add up. It rises from round to round as sources reach their limit, by two sums over the table in each.
    """
    s = materialize(numbered(sizes).withColumn("weight", _pick(weights, F.col("place")).cast("double")), "weights")
    limit = most * F.col("source_size")
    level = 0.0
    while True:
        reached = F.col("weight") * level >= limit
        got = s.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(reached, limit)).alias("closed"),
            F.sum(F.when(~reached, F.col("weight"))).alias("open"),
        ).first()
        if not got["open"]:
            break
        new = max(0.0, share * got["all"] - (got["closed"] or 0.0)) / got["open"]
        if new <= level:
            break
        level = new
    return s.withColumn("target", F.least(F.col("weight") * level, limit))


def _time(words: Column, target: Column, slope: Column) -> Column:
    """When a weight of 1 - slope + 2 * slope * t (times the target) has asked for so many words."""
    part = F.least(words / target, F.lit(1.0))
    curved = (F.sqrt(F.pow(1 - slope, 2) + 4 * slope * part) - (1 - slope)) / (2 * slope)
    return F.when(target <= 0, 1.0).when(slope == 0, part).otherwise(curved)


def _keys() -> dict[str, Column]:
    """Two hashes that tell documents apart; equal only for equal doc_id, source and text."""
    own = ("doc_id", "source", "text")
    return {"_key": F.xxhash64(*own), "_key_2": F.hash(*[F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in own])}


def plan(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """A row per document: size, source_size, target, taken (words), copies (whole ones), position, position_again.

    ``taken`` adds up to the target of every source, so the last document of a pass may be taken in part. Whole copies
    are those whose middle word is taken; ``position`` is the time of the first, ``position_again`` that of the second.
    """
    own = docs.select("doc_id", "source", n_words(F.coalesce("text", F.lit(""))).alias("size"), F.rand(5).alias("_tie"), *[k.alias(n) for n, k in _keys().items()])
    rows = materialize(own.withColumn("_cell", F.pmod(F.col("_key"), F.lit(CELLS))), "sizes")
    cells = materialize(rows.groupBy("source", "_cell").agg(F.sum("size").alias("_words")), "cells")
    sources = targets(cells.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    # At most CELLS rows of a source meet in a task here.
    up_to = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "_cell", F.coalesce(F.sum("_words").over(up_to), F.lit(0)).alias("_cell_at"))
    cells = cells.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        F.col("c.source").alias("_s"), F.col("_cell").alias("_c"), "_cell_at", "source_size", "target", _pick(SLOPES, F.col("place")).alias("_slope")
    )
    inside = Window.partitionBy("source", "_cell").orderBy("_key", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    ordered = rows.withColumn("_at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ordered.join(cells, ordered["source"].eqNullSafe(cells["_s"]) & (ordered["_cell"] == cells["_c"]))
    at, size, target, slope = F.col("_cell_at") + F.col("_at"), F.col("size"), F.col("target"), F.col("_slope")
    again = at + F.col("source_size")

    def part(begin: Column) -> Column:
        return F.greatest(F.least(F.round(target) - begin, size), F.lit(0))

    copies = ((at + size / 2 <= target) & (size > 0)).cast("int") + ((again + size / 2 <= target) & (size > 0)).cast("int")
    return joined.select(
        "doc_id", "size", "source_size", "target",
        (part(at) + part(again)).cast("long").alias("taken"),
        copies.alias("copies"),
        F.when(copies >= 1, _time(at, target, slope)).alias("position"),
        F.when(copies >= 2, _time(again, target, slope)).alias("position_again"),
        "_key", "_key_2",
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Whole documents of the mix with their columns, range-sorted by training position; those taken twice come twice.

    Rows equal in doc_id, source and text are one document here, with the copies of all of them.
    """
    names = list(_keys())
    times = F.flatten(F.collect_list(F.array_compact(F.array("position", "position_again"))))
    planned = plan(docs, weights, share, most).where("copies > 0").groupBy(*names).agg(times.alias("_times"))
    taken = docs.select(*[F.col(c).alias(f"_own_{c}") for c in docs.columns], *[k.alias(n) for n, k in _keys().items()]).dropDuplicates(names).join(planned, names)
    copies = taken.select(*[F.col(f"_own_{c}").alias(c) for c in docs.columns], F.explode("_times").alias("_position"))
    return copies.repartitionByRange("_position").sortWithinPartitions("_position").drop("_position")
