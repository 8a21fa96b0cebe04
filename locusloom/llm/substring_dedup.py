"""Removal of long passages that stood in an earlier document, found level by level.

A passage of ``WIDTH`` words can repeat only if the shorter windows in it do. The first level looks at windows of
``SHORT`` words, half of ``WIDTH``, and only at those with the smallest hash among the short windows of some
window of ``WIDTH`` (about one in four): equal passages choose equal ones. Only where a short window is in two
documents, it is extended to windows of twice its length, the second level. A level brings equal hashes
together by one shuffle and a sort; a task then streams over them, so a window that is in a third of
all documents needs no memory. Before the shuffle, equal windows of a slice of documents become one row.

Short windows only choose candidates, so a hash they share by chance costs a look. Words are removed by windows of ``WIDTH``
that agree in two independent hashes of 64 bits, the second one of their own words: among 10**13 windows, two different ones
agree by chance with a probability of about 10**-13.

At ``WIDTH`` no candidate is left: longer windows need no look, since windows of ``WIDTH`` cover all their words.

Which document is earlier goes by ``doc_id``. Defined cases: null or empty text has no words and empty kept text; a null
``doc_id`` comes after all others (two of them never are earlier than one another); rows with equal
``doc_id`` are not earlier than one another, whatever their texts; texts equal to that of an earlier document
go as a whole, if they have ``WIDTH`` words, without a look at their windows; an empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_batches
from .sorted_groups import gather, list_offsets, shared
from .wordhash import hash_windows, hash_words, slices

WIDTH = 13
SHORT = (WIDTH + 1) // 2  # two of them, overlapping in a word, make a window of WIDTH
LAST = 2**63 - 1  # stands for a null doc_id
# A place is the word's number plus 2**40 times 16 bits of the text's hash, which tell apart texts with one doc_id.
PLACE_BITS = 40


def _inside(counts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether each run of ``width`` words lies in one text."""
    text = np.repeat(np.arange(len(counts)), counts)
    return text[:n] == text[width - 1 : width - 1 + n]


def chosen(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Short windows' hashes; which of them some window of ``WIDTH`` words chooses; the choice of each of those."""
    short = hash_windows(hashes, SHORT)
    n = max(0, len(hashes) - WIDTH + 1)
    if n == 0:
        return short, np.zeros(len(short), bool), np.zeros(0, np.uint64)
    least = short[:n].copy()
    span = WIDTH - SHORT + 1
    for k in range(1, span):
        np.minimum(least, short[k : k + n], out=least)
    inside = _inside(counts, n, WIDTH)
    picked = np.zeros(len(short), bool)
    for k in range(span):
        picked[k : k + n] |= inside & (short[k : k + n] == least)
    return short, picked, least


def _short_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.column("doc").to_numpy()
        for first, raw in slices(batch.column("text").to_pylist()):
            hashes, _, _, _, counts = hash_words(raw)
            short, picked, _ = chosen(hashes, counts)
            doc = np.repeat(docs[first : first + len(raw)], counts)[: len(short)][picked]
            key = short[picked].view(np.int64)
            pairs = np.unique(np.rec.fromarrays((key, doc)))
            (keys,), (head,), (more,) = gather([pairs["f0"]], pairs["f1"])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(head), more], ["window", "doc", "doc_more"])


def _in_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each document that another one has too."""
    for (keys,), (doc,), _ in shared(batches, ["window"], ["doc"]):
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(keys)], ["doc", "window"])


def _long_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, texts = batch.column("doc").to_numpy(), batch.column("text").to_pylist()
        tags = (batch.column("_hash").to_numpy().view(np.uint64) >> np.uint64(48)).astype(np.int64) << PLACE_BITS
        found, n_found = list_offsets(batch.column("windows"))
        ends = np.concatenate(([0], np.cumsum(n_found)))
        for first, raw in slices(texts):
            hashes, _, _, _, counts = hash_words(raw)
            n = max(0, len(hashes) - WIDTH + 1)
            _, _, least = chosen(hashes, counts)
            text = np.repeat(np.arange(len(counts)), counts)
            # A hash and its text in one number each, so that one look-up serves the slice.
            salt = hash_windows(np.arange(len(raw), dtype=np.uint64) + np.uint64(1), 1)
            mine = found[ends[first] : ends[first + len(raw)]].view(np.uint64) ^ np.repeat(salt, n_found[first : first + len(raw)])
            candidate = _inside(counts, n, WIDTH) & np.isin(least ^ salt[text[:n]], mine) if n else np.zeros(0, bool)
            windows = hash_windows(hashes, WIDTH)[candidate].view(np.int64)
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            which = text[:n][candidate]
            place = np.flatnonzero(candidate) - starts[which] + tags[first : first + len(raw)][which]
            check = hash_windows(hash_words(raw, seed=1)[0], WIDTH)[candidate].view(np.int64)
            keys, heads, more = gather([windows, check], docs[first : first + len(raw)][which], place)
            yield pa.RecordBatch.from_arrays([*map(pa.array, [*keys, *heads]), *more], ["window", "check", "doc", "place", "doc_more", "place_more"])


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that an earlier document has too."""
    for _, (doc, place), least in shared(batches, ["window", "check"], ["doc", "place"]):
        late = doc > least
        yield pa.RecordBatch.from_arrays([pa.array(doc[late]), pa.array(place[late])], ["doc", "place"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, first = batch.column("text").to_pylist(), batch.column("_first").to_pylist()
        tags = (batch.column("_hash").to_numpy().view(np.uint64) >> np.uint64(48)).astype(np.int64)
        places, n_places = list_offsets(batch.column("places"))
        ends = np.concatenate(([0], np.cumsum(n_places)))
        rows = []
        for i, text in enumerate(texts):
            words = text.encode().split()
            mine = places[ends[i] : ends[i + 1]]
            mine = mine[(mine >> PLACE_BITS) == tags[i]] & ((1 << PLACE_BITS) - 1)
            if not first[i] and len(words) >= WIDTH:
                kept = []
            elif len(mine):
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, mine, 1)
                np.add.at(cover, mine + WIDTH, -1)
                kept = [w for w, c in zip(words, np.cumsum(cover), strict=False) if c == 0]
            else:
                kept = words
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def first_of_text(docs: DataFrame) -> DataFrame:
    """``doc`` with ``firsts``: hashes of its texts that no earlier document has as they are."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha"))
    return own.groupBy("_hash", "_sha").agg(F.min("doc").alias("doc")).groupBy("doc").agg(F.collect_set("_hash").alias("firsts"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` per document.

    The texts are shuffled once, by ``doc``; that exchange serves all three passes over them.
    """
    small_batches(docs.sparkSession)
    firsts = materialize(first_of_text(docs), "first-texts")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")
    )
    mine = texts.join(firsts.hint("merge"), "doc", "left").withColumn("_first", F.coalesce(F.array_contains("firsts", F.col("_hash")), F.lit(False)))
    looked_at = mine.where("_first").select("doc", "text", "_hash")
    short = looked_at.mapInArrow(_short_windows, "window bigint, doc bigint, doc_more array<bigint>")
    in_two = short.repartition("window").sortWithinPartitions("window", "doc").mapInArrow(_in_two, "doc bigint, window bigint")
    windows = in_two.groupBy("doc").agg(F.collect_set("window").alias("windows"))
    long = looked_at.join(windows.hint("merge"), "doc").mapInArrow(_long_windows, "window bigint, check bigint, doc bigint, place bigint, doc_more array<bigint>, place_more array<bigint>")
    later = long.repartition("window").sortWithinPartitions("window", "check", "doc").mapInArrow(_later, "doc bigint, place bigint")
    places = later.groupBy("doc").agg(F.collect_list("place").alias("places"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    done = mine.join(places.hint("merge"), "doc", "left").select(F.nullif("doc", F.lit(LAST)).cast(kind).alias("doc_id"), "text", "_hash", "_first", "places")
    return done.mapInArrow(_cut, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")
