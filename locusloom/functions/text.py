"""Small text fields: names, read-group strings, numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_int(text: Column, type_name: str = "bigint") -> Column:
    """Integer value of ``text``; null when it is anything but an optionally signed integer."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast(type_name))


def read_group_id(read_group: Column) -> Column:
    r"""Text between ``ID:`` and the next backslash of a read-group string such as ``@RG\tID:x\tSM:y``."""
    return F.regexp_extract(read_group, r"ID:([^\\]*)\\", 1)


def region_base_name(file_name: Column) -> Column:
    """File name of a region without its ``.bed`` or ``.vcf`` ending."""
    return F.regexp_replace(file_name, r"\.(bed|vcf)$", "")


def region_name_parts(file_name: Column) -> tuple[Column, Column]:
    """(load-balancing region, region) of a name such as ``3_17.bed``."""
    parts = F.split(region_base_name(file_name), "_")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")
