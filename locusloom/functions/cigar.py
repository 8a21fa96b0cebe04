"""Alignment geometry from CIGAR strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import FLAG_REVERSE, FLAG_UNMAPPED


def is_unmapped(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(FLAG_UNMAPPED)) != 0


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(FLAG_REVERSE)) != 0


def is_aligned(flag: Column, cigar: Column) -> Column:
    """Mapped, with an alignment to speak of: exactly the reads that have an alignment end."""
    return ~is_unmapped(flag) & (cigar != "*")


def _sum_lengths(cigar: Column, pattern: str) -> Column:
    lengths = F.regexp_extract_all(cigar, F.lit(pattern), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))


def reference_span(cigar: Column) -> Column:
    """Number of reference bases an alignment covers (M, D, N, =, X)."""
    return _sum_lengths(cigar, r"(\d+)[MDN=X]")


def alignment_end(flag: Column, pos: Column, cigar: Column) -> Column:
    """Last reference base of a read, 1-based; null when it is unmapped."""
    return F.when(is_aligned(flag, cigar), pos + reference_span(cigar) - F.lit(1))


def _clip(cigar: Column, pattern: str) -> Column:
    unclipped = ~(cigar.contains("S") | cigar.contains("H"))
    return F.when(unclipped, F.lit(0).cast("bigint")).otherwise(_sum_lengths(F.regexp_extract(cigar, pattern, 1), r"(\d+)[SH]"))


def leading_clip(cigar: Column) -> Column:
    return _clip(cigar, r"^((?:\d+[SH])*)")


def trailing_clip(cigar: Column) -> Column:
    return _clip(cigar, r"((?:\d+[SH])*)$")


def unclipped_five_prime(flag: Column, pos: Column, aend: Column, cigar: Column) -> Column:
    """Reference position of the first sequenced base, as if clipped bases had been aligned."""
    return F.when(is_reverse(flag), aend + trailing_clip(cigar)).otherwise(pos - leading_clip(cigar))


def has_indel(cigar: Column) -> Column:
    return cigar.rlike("[ID]")


def cigar_items(cigar: Column) -> Column:
    """ARRAY<STRUCT<op, len, ref_off, read_off>>: every item with what lies before it on both sides.

    ``ref_off`` counts reference bases and ``read_off`` read bases of the items to the left.
    """
    item = "struct<op:string,len:int,ref_off:int,read_off:int>"
    start = F.struct(
        F.lit(0).alias("ref_off"),
        F.lit(0).alias("read_off"),
        F.array().cast(f"array<{item}>").alias("items"),
    )

    def step(acc: Column, text: Column) -> Column:
        op = F.right(text, F.lit(1))
        length = F.regexp_extract(text, r"^(\d+)", 1).cast("int")
        entry = F.struct(
            op.alias("op"),
            length.alias("len"),
            acc["ref_off"].alias("ref_off"),
            acc["read_off"].alias("read_off"),
        )
        return F.struct(
            (acc["ref_off"] + F.when(op.isin("M", "D", "N", "=", "X"), length).otherwise(0)).alias("ref_off"),
            (acc["read_off"] + F.when(op.isin("M", "I", "S", "=", "X"), length).otherwise(0)).alias("read_off"),
            F.concat(acc["items"], F.array(entry)).alias("items"),
        )

    texts = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.aggregate(texts, start, step, lambda acc: acc["items"])
