"""Pairing of mate files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Records of a bucket of stored mates (some 300 MB of short reads).
RECORDS_PER_BUCKET = 1_000_000


def interleave_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Join two mate files on the record ordinal and put the mates one after the other.

    Both have (rec_no, name, seq, qual). The result has one row per mate with ``mate`` 1 or 2; order
    it by (rec_no, mate) where the order matters. Records without a partner are left out.
    """

    return _one_by_one(_joined(first, second))


def _joined(first: DataFrame, second: DataFrame, hint: str | None = None) -> DataFrame:
    def packed(df: DataFrame, mate: int, alias: str) -> DataFrame:
        return df.select("rec_no", F.struct(F.lit(mate).alias("mate"), "name", "seq", "qual").alias(alias))

    other = packed(second, 2, "_m2")
    return packed(first, 1, "_m1").join(other.hint(hint) if hint else other, "rec_no")


def _one_by_one(pairs: DataFrame) -> DataFrame:
    return pairs.select("rec_no", F.explode(F.array("_m1", "_m2")).alias("_m")).select("rec_no", "_m.*")


def buckets_for(n_records: int, records_per_bucket: int = RECORDS_PER_BUCKET) -> int:
    """Number of buckets for files of so many records; both files of a pair must be stored with the same."""
    return max(1, -(-n_records // records_per_bucket))


def interleave_stored(spark: SparkSession, first: str, second: str) -> DataFrame:
    """``interleave_pairs`` of two tables that ``sinks.sink_mates`` stored with the same number of buckets.

    The tables lie by record ordinal already, so bucket meets bucket and no record is shuffled; inside a partition of the
    result the mates stand one after the other, by ordinal. Raises an error where the buckets differ.
    """
    found = [_buckets(spark, name) for name in (first, second)]
    if found[0] != found[1]:
        raise ValueError(f"{first} has {found[0]} buckets, {second} has {found[1]}")
    return _one_by_one(_joined(spark.table(first), spark.table(second), "merge"))


def _buckets(spark: SparkSession, name: str) -> int:
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return int(about.get("Num Buckets", 0))
