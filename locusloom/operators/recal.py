"""Base-quality recalibration: error table and its application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PHRED_OFFSET, RECAL_MAX_QUALITY, RECAL_MIN_QUALITY
from ..functions import cigar as C
from ..session import materialize
from .bases import mask_known_sites, with_covariates
from .skew import MIN_HOT_ROWS, salted_join

ReferenceBase = Callable[[Column, Column], Column]

# Corrections of all read groups together are broadcast up to so many bytes; larger ones meet the reads in a salted join.
MAX_LEVEL_BYTES = 64_000_000


def empirical_quality(observations: Column, mismatches: Column) -> Column:
    return F.lit(-10.0) * F.log10((mismatches + 1) / (observations + 2))


def recal_counts(reads: DataFrame, sites: DataFrame, reference_base: ReferenceBase) -> DataFrame:
    """Observations and mismatches per (read group, reported quality, cycle, context), known sites masked.

    ``reads`` carry read_group and contig_index; ``reference_base(contig_index, position)`` gives the
    reference as a column expression.
    """
    bases = with_covariates(mask_known_sites(reads, sites))
    mismatch = F.col("base") != reference_base(F.col("contig_index"), F.col("ref_pos"))
    return bases.groupBy("read_group", "quality", "cycle", "context").agg(
        F.count(F.lit(1)).alias("observations"), F.count_if(mismatch).alias("mismatches")
    )


def recal_table(reads: DataFrame, sites: DataFrame, reference_base: ReferenceBase) -> DataFrame:
    return recal_counts(reads, sites, reference_base).withColumn(
        "empirical_quality", empirical_quality(F.col("observations"), F.col("mismatches"))
    )


def recal_levels(table: DataFrame) -> DataFrame:
    """The coarser levels used for correction, from the finest one, in one pass of grouping sets.

    ``level`` tells them apart: ``quality`` (read group, quality), ``cycle`` and ``context`` (each with
    one more column; cells without a context have no level of that kind).
    """
    keys = ["read_group", "quality"]
    cells = table.select(*keys, "cycle", "context", "observations", "mismatches")
    sets = [[*keys], [*keys, "cycle"], [*keys, "context"]]
    left_out = F.grouping_id(*keys, "cycle", "context")  # a bit per column that a set leaves out: cycle 2, context 1
    levels = cells.groupingSets(sets, *keys, "cycle", "context").agg(
        left_out.alias("_out"), F.sum("observations").alias("observations"), F.sum("mismatches").alias("mismatches")
    )
    level = F.when(F.col("_out") == 3, "quality").when(F.col("_out") == 1, "cycle").otherwise("context")
    return (
        levels.where((F.col("_out") != 2) | F.col("context").isNotNull())
        .withColumn("level", level)
        .withColumn("empirical_quality", empirical_quality(F.col("observations"), F.col("mismatches")))
        .select("level", *keys, "cycle", "context", "observations", "mismatches", "empirical_quality")
    )


def _dense(cells: Column, kind: str) -> Column:
    """Array with ``e`` of each (at, e) at the place ``at`` and nulls in between; ``cells`` are sorted and their places distinct."""
    none = F.lit(None).cast(kind)

    def stretch(cell: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(cells, i - 1)["at"])
        return F.concat(F.array_repeat(none, cell["at"] - before - 1), F.array(cell["e"]))

    return F.flatten(F.transform(cells, stretch))


def _pair(first: Column, second: Column) -> Column:
    """Number of a pair of bases that are numbered 1 to 4; null where one of them is another letter or missing."""
    return first * 5 + second


def _base_number(letter: Column) -> Column:
    return F.nullif(F.instr(F.lit("ACGT"), letter), F.lit(0))


def packed_levels(table: DataFrame) -> DataFrame:
    """A row per read group (read_group, _base, _cycles, _contexts).

    ``_base`` has the empirical quality by reported one, ``_cycles`` the same with the correction by cycle, and ``_contexts`` the
    corrections by number of the pair of bases; both are by quality and, inside, by cycle or pair.
    """
    at, e = F.col("level"), F.col("empirical_quality")
    pair = _pair(*[_base_number(F.substring("context", k, 1)) for k in (1, 2)])

    def listed(level: str, place: Column) -> Column:
        return F.array_sort(F.collect_list(F.when((at == level) & (place >= 0), F.struct(place.alias("at"), e.alias("e")))))

    def corrections(name: str) -> Column:
        return F.transform(name, lambda x: F.struct(x["at"].alias("at"), (x["e"] - F.col("_e")).alias("e")))

    by_quality = (
        recal_levels(table)
        .where("quality >= 0")  # other bases keep their quality
        .groupBy("read_group", "quality")
        .agg(
            F.max(F.when(at == "quality", e)).alias("_e"),
            listed("cycle", F.col("cycle").cast("int")).alias("_cycles"),
            listed("context", F.when(F.length("context") == 2, pair)).alias("_contexts"),
        )
        .withColumn("_cycles", F.transform(corrections("_cycles"), lambda x: F.struct(x["at"], (F.col("_e") + x["e"]).alias("e"))))
        .withColumn("_contexts", corrections("_contexts"))
    )
    parts = {"_base": F.col("_e"), "_cycles": _dense(F.col("_cycles"), "double"), "_contexts": _dense(F.col("_contexts"), "double")}
    quality = F.col("quality").cast("int").alias("at")
    gathered = by_quality.groupBy("read_group").agg(
        *[F.array_sort(F.collect_list(F.struct(quality, part.alias("e")))).alias(name) for name, part in parts.items()]
    )
    inner = {"_base": "double", "_cycles": "array<double>", "_contexts": "array<double>"}
    return gathered.select("read_group", *[_dense(F.col(name), kind).alias(name) for name, kind in inner.items()])


def _renewed() -> Column:
    """New Phred string of a read that stands beside the levels of its read group (nulls where there are none).

    Reads of the reverse strand are turned round first and back again afterwards, so that no base has to ask for its strand.
    """
    reverse = F.coalesce(C.is_reverse(F.col("flag")), F.lit(False))
    in_turn = F.when(reverse, F.reverse("qual")).otherwise(F.col("qual"))
    # Sequences as long as their qualities; others ('*') get no context. On the reverse strand the complement is read.
    strand = F.when(reverse, F.reverse(F.translate("seq", "ACGT", "TGCA"))).otherwise(F.col("seq"))
    letters = F.transform(F.split(F.when(F.length("seq") == F.length("qual"), strand), ""), _base_number)
    qualities = F.transform(F.split(in_turn, ""), lambda c: F.ascii(c) - PHRED_OFFSET)

    def renew(quality: Column, i: Column, pairs: Column) -> Column:
        base = F.get(F.col("_base"), quality)
        by_cycle = F.coalesce(F.get(F.get(F.col("_cycles"), quality), i + 1), base)
        by_context = F.coalesce(F.get(F.get(F.col("_contexts"), quality), F.get(pairs, i)), F.lit(0.0))
        value = F.floor(by_cycle + by_context + 0.5)
        limited = F.least(F.lit(RECAL_MAX_QUALITY), F.greatest(F.lit(RECAL_MIN_QUALITY), value))
        return F.chr(F.when(base.isNull(), quality).otherwise(limited) + PHRED_OFFSET)

    def string(letters: Column) -> Column:
        pairs = F.zip_with(F.concat(F.array(F.lit(None).cast("int")), letters), letters, _pair)
        return F.transform(F.array(pairs), lambda p: F.array_join(F.transform(qualities, lambda q, i: renew(q, i, p)), ""))[0]

    renewed = F.transform(F.array(letters), string)[0]
    return F.when(F.length("qual") > 0, F.when(reverse, F.reverse(renewed)).otherwise(renewed)).otherwise(F.col("qual"))


def apply_recal(
    reads: DataFrame, table: DataFrame, slice_reads: int = MIN_HOT_ROWS, max_level_bytes: int = MAX_LEVEL_BYTES
) -> DataFrame:
    """Add ``new_qual``, the recalibrated Phred string of each read.

    With E the empirical quality of a level, the new quality is
    ``E(rg,q) + [E(rg,q,cycle) - E(rg,q)] + [E(rg,q,context) - E(rg,q)]``, rounded and limited; a
    correction without a cell is 0, and a base without an (rg, q) cell keeps its quality.

    Reads are neither exploded nor, where the corrections of all read groups have at most ``max_level_bytes``, shuffled:
    a row of arrays per read group is broadcast, and each base looks its corrections up by place. Beyond that size reads and
    corrections meet by read group, large groups in slices of ``slice_reads`` reads. A null read group is one of its own.
    """
    reads = reads.drop("new_qual")
    packed = materialize(packed_levels(table), "levels")  # read once for its size, once for the join
    cells = F.size("_base") + F.size(F.flatten("_cycles")) + F.size(F.flatten("_contexts"))
    n_bytes = 8 * (packed.agg(F.sum(cells.cast("long"))).first()[0] or 0)
    keys = {"_group": F.coalesce("read_group", F.lit("")), "_none": F.col("read_group").isNull()}
    cut, levels = reads.withColumns(keys), packed.withColumns(keys).drop("read_group")
    if n_bytes <= max_level_bytes:
        joined = cut.join(F.broadcast(levels), list(keys), "left")
    else:
        plain = [c for c, kind in reads.dtypes if "map<" not in kind]
        joined = salted_join(cut, levels, list(keys), "left", min_rows=slice_reads, spread=plain)
    return joined.select(*reads.columns, _renewed().alias("new_qual"))
