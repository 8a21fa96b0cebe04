"""Periodic runs: stretches of words that repeat with a period at least four times, found in whole texts.

A run of period q and length 4q or more is alike to itself q words further on for 3q words or more, so every third of the
places 0, q, 2q, ... meets it. The texts of a slice stand in one sequence of word numbers; for each q the pairs (i, i + q) of
that coarse grid are compared, which is about a third of n ln n comparisons for n words, by strides. Where they are alike,
the longest common extensions to the right and to the left (``lce``: difference cover, few words compared, then a sparse
table) give the whole run; only texts in which some pair is alike for long enough enter that structure. Runs with equal
ends are one run, whose period is the smallest q.

A text is never cut; memory of a task goes with ``SLICE_WORDS`` or its longest text.

Defined cases: a null or empty text has no words, no runs, nulls for the longest run and empty digests' input; rows that are
repeated or share a ``doc_id`` are looked at each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, words
from .lce import Extensions

LEAST_LENGTH = 6
LEAST_TIMES = 4
SLICE_WORDS = 300_000


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, equal ones for equal words, and the texts' limits; each ends with a number of its own."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    limits = np.cumsum(sizes)
    out = np.empty(int(limits[-1]), np.int64)
    for t, end in zip(texts, limits, strict=True):
        out[end - 1 - len(t) : end - 1] = [number[w] for w in t]
    out[limits - 1] = len(number) + np.arange(len(texts))
    return out, limits


def _pairs(numbers: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods q so that the words i and i + q are alike, i on the grid of every 3q words."""
    places, periods = [], []
    for q in range(1, longest // LEAST_TIMES + 1):
        step = (LEAST_TIMES - 1) * q
        found = np.flatnonzero(numbers[: len(numbers) - q : step] == numbers[q::step])
        if len(found):
            places.append(found * step)
            periods.append(np.full(len(found), q, np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _alike(numbers: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Pairs that are alike over eight words around them, which a run of this length or longer must be."""
    keep = np.arange(len(place))
    # In a run, words around i and i + q are alike to the left, to the right, or both, for 3q words together.
    need = np.minimum(np.maximum((LEAST_TIMES - 1) * period, LEAST_LENGTH - period), 8)
    right = np.ones(len(place), np.int64)
    left = np.zeros(len(place), np.int64)
    for side, total in ((1, right), (-1, left)):
        going = keep
        for step in range(1, 8):
            a = place[going] + side * step
            b = a + period[going]
            inside = (a >= 0) & (b < len(numbers))
            going = going[inside][numbers[a[inside]] == numbers[b[inside]]]
            if not len(going):
                break
            total[going] += 1
    return right + left >= need


def find_runs(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of the texts: text, start, length, period, ordered by text, start and period."""
    none = np.zeros(0, np.int64)
    if not texts:
        return none, none, none, none
    numbers, limits = _numbered(texts)
    place, period = _pairs(numbers, max(map(len, texts)))
    owner = np.searchsorted(limits, place, side="right")
    held = np.flatnonzero(owner == np.searchsorted(limits, place + period, side="right"))
    held = held[_alike(numbers, place[held], period[held])]
    place, period, owner = place[held], period[held], owner[held]
    if not len(place):
        return none, none, none, none

    # Only the texts that still have pairs are indexed.
    own = np.unique(owner)
    sizes = np.diff(limits, prepend=0)[own]
    begins = (limits - np.diff(limits, prepend=0))[own]
    new_begins = np.cumsum(sizes) - sizes
    index = np.repeat(begins - new_begins, sizes) + np.arange(int(sizes.sum()))
    _, dense = np.unique(numbers[index], return_inverse=True)
    which = np.searchsorted(own, owner)
    i = place - begins[which] + new_begins[which]
    groups = np.repeat(np.arange(len(own)), sizes)
    right = Extensions(dense, groups).common(i, i + period)
    # Backwards, a text ends with the number that closes the text before it.
    back = np.append(dense[::-1][1:], dense.max() + 1)
    at = len(dense) - 1 - i  # the word left of i
    left = Extensions(back, groups[-1] - groups[::-1]).common(at - period, at)
    start = i - left
    length = left + right + period
    runs = (length >= LEAST_LENGTH) & (length >= LEAST_TIMES * period)
    text, start, length, period = owner[runs], (start - new_begins[which])[runs], length[runs], period[runs]
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    first = np.ones(len(text), bool)  # of those with equal ends, the smallest period
    first[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[first], start[first], length[first], period[first]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``runs`` by start and period (word numbers from 0), ``collapsed``: words kept, of each run its first period."""

    def rows_of(texts: list[list[bytes]]) -> tuple[list[int], np.ndarray, list[bytes]]:
        text, *run = find_runs(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        change = np.zeros(int(sizes.sum()) + 1, np.int64)
        start, length, period = run
        np.add.at(change, begins[text] + start + period, 1)
        np.add.at(change, begins[text] + start + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        touched = np.zeros(len(texts), bool)
        touched[text] = True
        kept = [b" ".join(t if not hit else [w for w, g in zip(t, gone[b : b + len(t)], strict=True) if not g]) for t, b, hit in zip(texts, begins, touched, strict=True)]
        return np.bincount(text, minlength=len(texts)), np.stack(run), kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, texts, held = 0, [], 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append(text.encode().split())  # at ASCII white space only
                held += len(texts[-1])
                if held >= SLICE_WORDS or i + 1 == batch.num_rows:
                    counts, found, kept = rows_of(texts)
                    each = pa.StructArray.from_arrays([pa.array(c) for c in found], ["start", "length", "period"])
                    runs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), each)
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, len(texts)), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])
                    begin, texts, held = i + 1, [], 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    return documents(docs).mapInArrow(run, f"doc_id {kind}, runs {RUNS}, collapsed string")


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in a tenth of the documents, from some word on, the words repeat with a period that the id gives."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) div 10")
    n, a, p = F.col("_n"), F.col("_a"), F.col("_p")
    text = F.col("text")
    # Only the planted tenth is split into words here.
    split = documents(docs).withColumn("_g", F.when(h % 10 == 0, g)).withColumn("_words", F.when(F.col("_g").isNotNull(), words(text)))
    split = split.withColumn("_n", F.when(F.size("_words") > 0, F.size("_words")))
    split = split.withColumn("_a", F.col("_g") % n).withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    again = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", place(i))), " ")
    return split.select("doc_id", F.when(n.isNotNull(), again).otherwise(text).alias("text"))


def longest(runs: Column) -> Column:
    """The run with the most repeats, compared exactly; the first of equals."""
    first = F.get(runs, F.lit(0))
    more = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.aggregate(runs, first, more)


def report(docs: DataFrame) -> DataFrame:
    """A row per document: number of runs, the one with the most repeats, digests of all runs and of the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = detect(docs).withColumn("_best", longest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
