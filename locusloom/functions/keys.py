"""Position keys and interval coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BUCKET_WIDTH, KEY_SCALE


def div(left: Column, right: Column | int) -> Column:
    """SQL ``div``: integer division with a BIGINT result."""
    right = right if isinstance(right, Column) else F.lit(right)
    return F.call_function("div", left, right)


def bucket_key(contig_index: Column, pos: Column, width: int = BUCKET_WIDTH) -> Column:
    """One BIGINT that orders buckets by contig, then position."""
    return contig_index.cast("bigint") * F.lit(KEY_SCALE) + div(pos, width)


def key_contig(key: Column) -> Column:
    return div(key, KEY_SCALE).cast("int")


def key_bucket(key: Column) -> Column:
    return key % F.lit(KEY_SCALE)


def bed_start(start: Column) -> Column:
    """1-based closed start to the 0-based start of a half-open interval (the end is unchanged)."""
    return start - F.lit(1)


def region_string(contig: Column, start: Column, end: Column) -> Column:
    """``contig:start-end`` in 1-based closed coordinates."""
    return F.concat(contig, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))
