"""Allele counts per locus and a simple diploid call from them."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BASE_ERROR
from ..functions.keys import div
from ..session import materialize
from .intervals import merge_spans
from .overlaps import FEW_INTERVALS, OVERLAP_BIN, interval_intersect, read_intervals
from .recal import ReferenceBase
from .skew import MAX_HOT_KEYS, MIN_HOT_ROWS

# The functions below travel to executors whole, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASES = ("A", "C", "G", "T")
COUNTS = ("depth", *[f"n_{b.lower()}" for b in BASES])
# Most bases of a batch that are laid out at a time, however long its reads are.
CHUNK_BASES = 2_000_000


def _aligned_items(cigar: str) -> list[tuple[int, int, int]]:
    """Reference offset, read offset and length of every aligned item (M, =, X)."""
    ref_off, read_off, items = 0, 0, []
    for digits, op in re.findall(r"([0-9]+)([MIDNSHP=X])", cigar):
        if op in "M=X":
            items.append((ref_off, read_off, int(digits)))
        ref_off += int(digits) if op in "MDN=X" else 0
        read_off += int(digits) if op in "MIS=X" else 0
    return items


def _ranges(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers ``first``, ``first`` + 1, ... (``n`` of them) for each row, one after the other, with the row they are for."""
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) + (first - np.cumsum(n) + n)[of]


def _count_stretch(places: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places, and for each the number of bases by code (0 to 3 as in BASES, 4 for any other)."""
    low, span = int(places.min()), int(places.max() - places.min()) + 1
    if span <= 4 * len(places):
        counts = np.bincount((places - low) * 5 + codes, minlength=5 * span).reshape(-1, 5)
        found = np.flatnonzero(counts.any(axis=1))
        return found + low, counts[found]
    distinct, at = np.unique(places, return_inverse=True)
    return distinct, np.bincount(at * 5 + codes, minlength=5 * len(distinct)).reshape(-1, 5)


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bases by locus of each batch of pieces of reads (contig, start, end, pos, cigar, seq), to be added up."""
    code_of = np.full(256, 4, np.int64)
    for code, base in enumerate(BASES):
        code_of[ord(base)] = code
    for batch in batches:
        contigs, cigars = (batch.column(c).dictionary_encode() for c in ("contig", "cigar"))
        seq = pc.fill_null(batch.column("seq"), "").cast(pa.large_string())
        if pc.sum(pc.binary_length(seq)).as_py() != pc.sum(pc.utf8_length(seq)).as_py():
            seq = pc.replace_substring_regex(seq, r"[^\x00-\x7F]", "N")  # a byte each
        offsets = np.frombuffer(seq.buffers()[1], np.int64)[seq.offset : seq.offset + len(seq) + 1]
        letters = code_of[np.frombuffer(seq.buffers()[2] or b"", np.uint8)]
        # A row per aligned item of each piece, cut to the piece; rows of a contig together.
        known = [np.array(_aligned_items(c), np.int64).reshape(-1, 3) for c in cigars.dictionary.to_pylist()]
        sizes = np.array([len(k) for k in known], np.int64)
        number = cigars.indices.to_numpy(zero_copy_only=False)
        row, item = _ranges((np.cumsum(sizes) - sizes)[number], sizes[number])
        ref_off, read_off, length = np.concatenate([*known, np.zeros((0, 3), np.int64)])[item].T
        pos, start, end = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("pos", "start", "end"))
        begin = np.maximum(start + 1, pos + ref_off)
        n = np.maximum(np.minimum(end, pos + ref_off + length - 1) - begin + 1, 0)
        contig = contigs.indices.to_numpy(zero_copy_only=False)[row]
        in_order = np.flatnonzero(n)
        in_order = in_order[np.argsort(contig[in_order], kind="stable")]
        begin, n, contig, row = begin[in_order], n[in_order], contig[in_order], row[in_order]
        in_read, until = begin - (pos - read_off + ref_off)[in_order], np.cumsum(n)
        at, beyond = offsets[row] + in_read, offsets[row + 1]
        for c in np.unique(contig).tolist():
            low, high = np.searchsorted(contig, c), np.searchsorted(contig, c, side="right")
            done, last = int(until[low] - n[low]), int(until[high - 1])
            while done < last:
                upto = min(done + CHUNK_BASES, last)
                i, j = np.searchsorted(until, done, side="right"), np.searchsorted(until, upto, side="left") + 1
                skipped = np.maximum(done - (until[i:j] - n[i:j]), 0)
                of, step = _ranges(skipped, np.minimum(until[i:j], upto) - (until[i:j] - n[i:j]) - skipped)
                letter = at[i:j][of] + step
                there = letter < beyond[i:j][of]
                codes = letters[letter] if there.all() else np.where(there, np.append(letters, 4)[np.where(there, letter, -1)], 4)
                places, counts = _count_stretch(begin[i:j][of] + step, codes)
                names = pa.DictionaryArray.from_arrays(np.full(len(places), c, np.int32), contigs.dictionary).cast(pa.string())
                columns = [pa.array(x, pa.int64()) for x in (places, counts.sum(axis=1), *counts.T[:4])]
                yield pa.RecordBatch.from_arrays([names, *columns], ["contig", "pos", *COUNTS])
                done = upto


def pileup_counts(
    reads: DataFrame,
    targets: DataFrame,
    bin_width: int = OVERLAP_BIN,
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    max_few: int = FEW_INTERVALS,
) -> DataFrame:
    """Depth and base counts at every covered locus of the targets (half-open contig, start, end).

    Reads are cut to the merged targets first. Only the overlapping bases are laid out, in arrays of a batch and never as
    rows, and they are counted by locus before they are shuffled: pieces of reads come by bins, so a batch has few loci.
    Up to ``max_few`` merged targets (counted) are broadcast; then reads are gone over once, only pieces in targets are dealt
    to bins, and adaptive execution cuts a bin of very many pieces, since counts of a locus are added up afterwards anyway.
    """
    spans = read_intervals(reads).select("contig", "start", "end", "pos", "cigar", "seq")
    # Stored, since it is counted, asked for its levels and joined.
    disjoint = materialize(merge_spans(targets.select("contig", "start", "end")).select("contig", "start", "end"), "targets")
    few = disjoint.limit(max_few + 1).count() <= max_few
    # Inlining one struct keeps Catalyst from moving null checks of ends below them, where ends are worked out a second time.
    left = spans.select(F.inline(F.array(F.struct(*spans.columns)))) if few else spans
    pieces = interval_intersect(left, disjoint, bin_width, min_hot_rows, max_hot_keys, few).select(*spans.columns)
    if few:
        by_bin = pieces.withColumn("_tile", F.xxhash64("contig", div(F.col("start"), bin_width))).hint("rebalance", "_tile")
        pieces = by_bin.sortWithinPartitions("_tile").drop("_tile")
    counted = pieces.mapInArrow(_count_pieces, "contig string, pos bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))
    return counted.groupBy("contig", "pos").agg(*[F.sum(c).alias(c) for c in COUNTS])


def variant_calls(
    pileup: DataFrame, contigs: DataFrame, reference_base: ReferenceBase, min_confidence: float = 0.0
) -> DataFrame:
    """Candidate single-base variants: genotype by likelihood, kept when the confidence is reached.

    The alternative is the most frequent base that is not the reference (ties: alphabetical). A
    ``min_confidence`` of 0 means no threshold. This looks at one locus at a time; it does not
    assemble haplotypes.
    """
    ref = F.col("ref")
    counts = {b: F.col(f"n_{b.lower()}") for b in BASES}
    others = {b: F.when(ref != b, n) for b, n in counts.items()}
    n_ref = F.coalesce(*[F.when(ref == b, n) for b, n in counts.items()], F.lit(0))
    n_alt = F.greatest(*others.values())
    # First of the alphabet among the most frequent ones.
    alt = F.coalesce(*[F.when(n == n_alt, b) for b, n in others.items()])
    right, wrong, half = math.log10(1 - BASE_ERROR), math.log10(BASE_ERROR), math.log10(0.5)
    r, a = F.col("ref_count").cast("double"), F.col("alt_count").cast("double")
    scored = (
        pileup.join(contigs.select("contig", "contig_index"), "contig")
        .withColumn("ref", reference_base(F.col("contig_index"), F.col("pos")))
        .withColumn("ref_count", n_ref.cast("bigint"))
        .withColumn("alt", alt)
        .withColumn("alt_count", n_alt.cast("bigint"))
        .withColumn("_rr", r * right + a * wrong)
        .withColumn("_ra", (r + a) * half)
        .withColumn("_aa", r * wrong + a * right)
        .withColumn("_best", F.greatest("_rr", "_ra", "_aa"))
        .withColumn(
            "genotype",
            F.when(F.col("_best") == F.col("_rr"), "0/0").when(F.col("_best") == F.col("_ra"), "0/1").otherwise("1/1"),
        )
        .withColumn("confidence", F.lit(10.0) * (F.col("_best") - F.col("_rr")))
    )
    # Inlining one struct changes no row; it keeps Catalyst from moving the filter below the
    # expressions and evaluating copies of all of them there.
    columns = ["contig", "contig_index", "pos", "ref", "alt", "depth", "ref_count", "alt_count", "genotype", "confidence"]
    return scored.select(F.inline(F.array(F.struct(*columns)))).where(
        (F.col("genotype") != "0/0") & (F.col("confidence") >= min_confidence)
    )
