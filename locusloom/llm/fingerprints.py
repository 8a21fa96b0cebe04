"""Document fingerprints by content-defined chunking.

A rolling gear hash over the last 32 bytes cuts a text where some of its bits are zero; the cut is harder before a
chunk has its normal length and easier after it (normalised chunking), so lengths stay near that. Cuts depend on
nearby bytes only: after an edit or a shift, chunks further on are the same again. A fingerprint is the sorted set
of chunks, each as 8 hex digits of its digest and 2 of its length in bytes. The likeness of two fingerprints is
containment: the length of common chunks over that of the shorter set.

``successors`` walks documents in descending order of id along with the next one: ids are cut into ranges (by
quantiles of all ids), a range goes to one task, and the first row of a range is also sent to the range before it.

Defined cases: null or empty text has an empty fingerprint, which is like another empty one (1) and unlike all others
(0); a null ``doc_id`` comes last; rows with equal ``doc_id`` follow by text; a single document is its own next one;
an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LEAST, NORMAL, MOST = 6, 16, 64
WINDOW = 32
# Zero bits asked of the hash before and after the normal length.
HARD = np.uint32(0xFC000000)
EASY = np.uint32(0xE0000000)
FIRST = -(2**63)  # stands for a null doc_id
RANGES_PER_PARTITION = 4

_GEAR = np.random.default_rng(20250902).integers(0, 2**32, 256, dtype=np.uint32)
_BYTE = np.random.default_rng(20250903).integers(1, 2**63, 256, dtype=np.uint64)
_POWER = np.multiply.accumulate(np.concatenate(([1], np.full(MOST, 0x9E3779B97F4A7C15, np.uint64))).astype(np.uint64))


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the last 32 bytes' gear values, each shifted by its distance (by doubling)."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        shifted = h[:-step] << np.uint32(step)
        h[step:] += shifted
    return h


def cuts(raw: list[bytes], data: np.ndarray) -> tuple[list[int], list[int]]:
    """Chunk ends in the joined bytes, text by text, and how many chunks each text has."""
    # Zero bytes before each text keep the window from reaching into the one before.
    padded = np.frombuffer(b"".join([x for t in raw for x in (bytes(WINDOW), t)]), np.uint8)
    begins = np.cumsum([len(t) + WINDOW for t in raw]) - [len(t) for t in raw]
    own = np.ones(len(padded), bool)
    own[(begins[:, None] - np.arange(1, WINDOW + 1)).ravel()] = False
    h = gear_hashes(padded)[own]
    hard = np.flatnonzero(h & HARD == 0).tolist()
    easy = np.flatnonzero(h & EASY == 0).tolist()
    hard.append(len(data) + MOST)
    easy.append(len(data) + MOST)
    ends, counts, at = [], [], 0
    for text in raw:
        stop, before = at + len(text), len(ends)
        while at < stop:
            # A cut after byte p ends the chunk at p + 1.
            p = hard[bisect_left(hard, at + LEAST - 1)]
            if p >= at + NORMAL - 1:
                p = easy[bisect_left(easy, at + NORMAL - 1)]
            at = min(p + 1, at + MOST, stop)
            ends.append(at)
        counts.append(len(ends) - before)
    return ends, counts


def chunk_sets(texts: list[str]) -> list[np.ndarray]:
    """Per text its distinct chunks, sorted, each as digest * 256 + length."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends, counts = cuts(raw, data)
    if not ends:
        return [np.zeros(0, np.uint64) for _ in raw]
    ends = np.array(ends)
    starts = np.concatenate(([0], ends[:-1]))
    length = (ends - starts).astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    digest = np.add.reduceat(_BYTE[data] * _POWER[place], starts) + length
    digest ^= digest >> np.uint64(32)
    digest *= np.uint64(0xBF58476D1CE4E5B9)
    chunks = (digest >> np.uint64(32) << np.uint64(8)) | length
    text = np.repeat(np.arange(len(raw)), counts)
    order = np.lexsort((chunks, text))
    chunks, text = chunks[order], text[order]
    new = np.ones(len(chunks), bool)
    new[1:] = (chunks[1:] != chunks[:-1]) | (text[1:] != text[:-1])
    return np.split(chunks[new], np.cumsum(np.bincount(text[new], minlength=len(raw)))[:-1])


def printed(chunks: np.ndarray) -> str:
    """Ten hex digits for each chunk."""
    return chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    mask = np.uint64(255)
    common = np.intersect1d(a, b, assume_unique=True) & mask
    return float(common.sum()) / float(min((a & mask).sum(), (b & mask).sum()))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the begin of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _search(bounds: list[int], order: Column) -> Column:
    """How many of the sorted ``bounds`` are below ``order``, in two steps of about the root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    every, coarse = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[step - 1 :: step]))
    skipped = F.size(F.filter(coarse, lambda b: b < order)) * step
    return skipped + F.size(F.filter(F.slice(every, skipped + 1, F.lit(step)), lambda b: b < order))


def ranges(docs: DataFrame) -> DataFrame:
    """Rows (``range``, ``extra``, ``order``, doc_id, text) sorted for ``successors``.

    ``extra`` rows are the first of the next range, or, in the last one, the first of all.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))
    own = docs.select(order.alias("order"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [k / (n * RANGES_PER_PARTITION) for k in range(1, n * RANGES_PER_PARTITION)]
    row = own.agg(F.percentile_approx("order", parts, 10 * len(parts)).alias("b"), F.max("order").alias("most")).first()
    # Ranges from the lowest ids up; each bound is the highest id of its range.
    bounds = sorted({*(row.b or []), row.most if row.most is not None else 0})
    number = _search(bounds, F.col("order"))
    at_bound = F.element_at(F.array(*map(F.lit, bounds)), number + 1) == F.col("order")
    other = F.when(F.col("order") == bounds[-1], 0).otherwise(number + 1)
    places = F.array(F.struct(number.alias("range"), F.lit(0).alias("extra")))
    with_extra = F.concat(places, F.array(F.struct(other.alias("range"), F.lit(1).alias("extra"))))
    placed = own.select("order", "doc_id", "text", F.explode(F.when(at_bound, with_extra).otherwise(places)).alias("_p"))
    rows = placed.select("_p.range", "_p.extra", "order", "doc_id", "text")
    return rows.repartition(n, "range").sortWithinPartitions("range", "extra", F.desc("order"), "text")


def successors(batches: Iterator[pa.RecordBatch], slice_chars: int = 1_500_000) -> Iterator[tuple[list, list[str], pa.DataType]]:
    """Slices of (ids, texts) of neighbours; the last text of a slice is only the next one of the one before it."""
    ids, texts, size, now, kind = [], [], 0, None, None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        columns = (batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text"))
        for where, extra, doc, text in zip(*columns, strict=True):
            if where != now:
                ids, texts, size, now = [], [], 0, where
            elif not texts:
                continue  # this range is done
            if extra and not texts:
                continue  # a range without rows of its own
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if extra:
                yield ids, texts, kind
                ids, texts, size = [], [], 0
            elif size > slice_chars and len(texts) > 1:
                yield ids, texts, kind
                ids, texts, size = ids[-1:], texts[-1:], len(text)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are, and it and its next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, kind in successors(batches):
            new = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
            sets = chunk_sets([*texts, *new])
            own, changed = sets[: len(texts)], sets[len(texts) :]
            arrays = [
                pa.array(ids[:-1], kind),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                pa.array([printed(s) for s in own[:-1]], pa.string()),
                pa.array([printed(s) for s in changed], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, changed, strict=False)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ranges(docs).mapInArrow(run, columns)
