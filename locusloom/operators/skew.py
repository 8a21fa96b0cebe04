"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it has more rows than MIN_HOT_ROWS and more than 1/MAX_HOT_KEYS of all rows, so
# there can never be more than MAX_HOT_KEYS of them: that bounds what is broadcast below. A slice of a
# hot key has MIN_HOT_ROWS rows, however many rows there are in all.
MIN_HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000_000

# Rows whose key has a null match nothing; they are spread over this many slices.
NULL_KEY_SLICES = 1_024

# A lookup table with no more rows than this is broadcast; larger ones are shuffled.
MAX_BROADCAST_ROWS = 1_000_000


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key (``_n``), null keys left out.

    The keys come out as non-null columns: a join on them would otherwise add null filters below one
    use of the counts but not below another, and the uses could no longer share one pass over ``df``.
    """
    filler = {"string": "", "boolean": False}
    known = [F.coalesce(F.col(k), F.lit(filler.get(t, 0))).alias(k) for k, t in df.select(*keys).dtypes]
    return df.select(*keys).dropna().select(*known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def hot_of_counts(counts: DataFrame, min_rows: int = MIN_HOT_ROWS, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """The hot keys of ``key_counts`` with the number of slices (``_slices``) each should be cut into."""
    limit = counts.agg(
        F.greatest(F.lit(min_rows).cast("double"), F.sum("_n") / F.lit(max_keys)).alias("_limit")
    )
    slice_rows = F.lit(max(1, min_rows))
    return (
        counts.crossJoin(F.broadcast(limit))  # one row
        .where(F.col("_n") > F.col("_limit"))
        .withColumn("_slices", F.ceil(F.col("_n") / slice_rows).cast("int"))
        .drop("_n", "_limit")
    )


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    min_rows: int = MIN_HOT_ROWS,
    max_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    return hot_of_counts(key_counts(df, keys), min_rows, max_keys)


def salted_join(
    big: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    min_rows: int = MIN_HOT_ROWS,
    max_keys: int = MAX_HOT_KEYS,
    spread: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Equi-join in which rows of ``big`` with a hot key are spread over several tasks.

    Each hot key gets as many slices as its row count asks for; the matching rows of ``other`` are
    copied once per slice. Every pair still meets exactly once, so the result is that of a plain
    join. ``how`` may be any type that keeps or drops rows of ``big``: inner, left, left_semi,
    left_anti. Rows are dealt to slices by a hash of ``spread`` (default: all columns), which should
    tell rows of one key apart.

    ``hot`` replaces the count of ``big`` by key. Its columns other than ``_slices`` must be functions of
    the key that both sides carry, so it can be coarser than the key and cheaper to count; it must
    come from ``hot_keys``, which bounds its size.

    ``hint`` is a join hint for ``other``. Rows made by an ``explode`` aren't in Catalyst's estimate of its size, so
    where it grows by one, "merge" keeps it from being broadcast on the size of the file that it was read from.
    """
    keys = list(keys)
    if hot is None:
        hot = hot_keys(big, keys, min_rows, max_keys)
    cells = [c for c in hot.columns if c != "_slices"]
    hot = F.broadcast(hot)
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    slices = F.when(no_key, NULL_KEY_SLICES).otherwise(F.coalesce(F.col("_slices"), F.lit(1)))
    cut = (
        big.join(hot, cells, "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*(spread or big.columns)), slices).cast("int"))
        .drop("_slices")
    )
    copies = (
        other.join(hot, cells, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_slices")
    )
    return cut.join(copies.hint(hint) if hint else copies, [*keys, "_slice"], how).drop("_slice")


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    **salting: object,
) -> DataFrame:
    """Join with a lookup table: broadcast when its checked size allows, salted shuffle otherwise.

    The check counts ``table``, so pass one that is cheap to count (a file, a materialized result). ``salting`` goes to
    ``salted_join``.
    """
    keys = list(keys)
    if table.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(table), keys, how)
    return salted_join(big, table, keys, how, **salting)
