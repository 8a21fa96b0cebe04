"""A table of bits that tells which rows can have one of a set of keys, so that the others need not be shuffled for a join.

The table has 2**``BITS`` bits (16 MB) however many keys there are; that is all that the driver gets and that is broadcast.
A row whose bit isn't set has none of the keys. One whose bit is set may have one: a join must still tell. The more keys
there are against 134 million bits, the more rows pass; results don't depend on it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 27
# Bits of one value of ``bitmap_construct_agg``.
BUCKET_BITS = 15


def _place(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << BITS))


def mark_table(keys: DataFrame) -> Broadcast:
    """The table of bits of all keys (all columns of ``keys``; the types must be those of the columns that are looked up)."""
    place = keys.select(_place(*keys.columns).alias("place"))
    parts = place.select(F.shiftright("place", BUCKET_BITS).alias("bucket"), F.col("place").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).alias("at"))
    # Dealt by bucket before they are put together, so that a task has only its own buckets.
    found = parts.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toArrow()
    bits, length = np.zeros(1 << (BITS - 3), np.uint8), 1 << (BUCKET_BITS - 3)
    for bucket, part in zip(found["bucket"].to_pylist(), found["bits"].to_pylist(), strict=True):
        bits[bucket * length : (bucket + 1) * length] = np.frombuffer(part, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def is_marked(known: Broadcast, *columns: Column | str) -> Column:
    """Whether the bit of a row's key is set. Only the place of the bit is sent to Python, not the row."""

    @F.pandas_udf("boolean")
    def is_set(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((known.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return is_set(_place(*columns))
