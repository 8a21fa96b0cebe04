"""Phrase collocations: runs of 2 to 4 words that occur together far more often than apart, per language.

Every n-gram is named by a Rabin-Karp fingerprint: prefix polynomials over the bytes of a slice of texts, at two random
points modulo the prime 2**31 - 1, give the value of any stretch of words from its two ends. Fingerprints (with their
language and number of words) are counted, and only frequent ones are ever turned into words:

1. Per length, shortest first: a slice counts its fingerprints, one shuffle brings equal ones together, sums them and keeps
   those with ``MIN_COUNT`` occurrences. An n-gram is counted only if all shorter ones in it are frequent, as it can't be
   frequent otherwise. What is kept comes back as a table of 2**``BITS`` bits (16 MB at any size of the corpus, the only
   thing that is broadcast): a set bit stands for all fingerprints with these leading bits, so an n-gram too many may be
   counted, never one too few. The lengths 3 and 4 share a pass, both held to the frequent pairs in them.
2. Last pass: for each fingerprint whose bit is set, a slice keeps a pointer to its first occurrence, compares all others
   with the words there, byte by byte, cuts the phrase out at the pointer, and ships (language, phrase, occurrences); one
   that differs in its words is shipped as a phrase of its own. Phrases are summed by their words, so the counts are exact
   whatever fingerprints collide.

Scores come from joins of the frequent phrases with themselves: each cut of a phrase asks for the counts of its two parts
(which are frequent, as the phrase is), each longer phrase reports its count to the phrases inside it. The best of a language
are found per slice of its phrases first, so no task ranks a whole language.

Fingerprints are dealt to 65,536 buckets by their leading bits; a bucket is merged as a stream, in memory for its distinct
fingerprints. A frequent word is one row per slice, so no bucket is hot.

Defined cases: a null text is empty, a null language is ``und`` (like the string itself); rows that are repeated or share a
``doc_id`` count each; NUL and other control characters are letters; languages without a candidate have no rows; an empty
table gives an empty result; columns other than ``text`` and ``lang`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .wordhash import mix

MIN_COUNT = 30
LONGEST = 4
BEST = 2000
# A phrase goes where one around it has 80 percent of its occurrences.
INSIDE_PERCENT = 80
BITS = 27
BUCKET_BITS = 16
# Fingerprints that a task holds before it ships their counts, and that a bucket gathers before it merges them.
HELD = 3_000_000
# Slices of a language that are ranked apart.
RANK_SLICES = 64

_PRIME = np.uint64(2**31 - 1)
_SHIFT = np.uint64(31)
_POINTS = (1_357_986_421, 1_948_263_747)  # random numbers below the prime
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[9, 32]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_CUT = re.compile(rb"[.,;:!?\x0A-\x0D]")
SLICE_BYTES = 2_000_000


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, for x below 2**62."""
    x = (x & _PRIME) + (x >> _SHIFT)
    x = (x & _PRIME) + (x >> _SHIFT)
    return np.where(x == _PRIME, np.uint64(0), x)


_known_powers: dict[int, np.ndarray] = {}


def _powers(point: int, n: int) -> np.ndarray:
    """1, point, point**2, ... modulo the prime, by doubling; kept for the next slice, as slices are about equal."""
    out = _known_powers.get(point, np.ones(1, np.uint32))
    while len(out) < n:
        step = np.uint64(pow(point, len(out), int(_PRIME)))
        out = np.concatenate((out, _reduced(out * step).astype(np.uint32)))
    _known_powers[point] = out
    return out[:n].astype(np.uint64)


class Slice:
    """Words of a slice of texts, set apart by one space each, with prefix polynomials over their bytes."""

    def __init__(self, raw: list[bytes], langs: list[str]):
        data = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
        stop = _BREAK[data]
        word = ~(stop | _GAP[data])
        edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0))
        starts, ends = edge[::2], edge[1::2]  # the last byte is a break, so every word ends
        lengths = ends - starts
        piece = np.cumsum(stop)[starts]
        keep = word.copy()
        keep[ends] = True
        data = np.where(word, data, np.uint8(32))
        self.bytes = data[keep]
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        limits = np.cumsum([len(r) + 1 for r in raw])
        self.counts = np.diff(np.searchsorted(starts, limits), prepend=0)  # words per text
        self.langs, number = np.unique(np.array(langs, object), return_inverse=True) if langs else (np.zeros(0, object), np.zeros(0, int))
        self.lang = np.repeat(number, self.counts)
        self.salt = np.array([xxhash.xxh3_64_intdigest(l) for l in self.langs], np.uint64)
        self.joined = np.zeros(len(starts), bool)  # the next word is in the same piece
        self.joined[:-1] = piece[1:] == piece[:-1]
        self.sums, self.inverse = [], []
        for point in _POINTS:
            terms = _reduced((self.bytes.astype(np.uint64) + np.uint64(1)) * _powers(point, len(self.bytes)))  # NUL counts too
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
            self.sums.append((_reduced(sums[self.starts]), _reduced(sums[self.ends])))
            self.inverse.append(_powers(pow(point, -1, int(_PRIME)), len(self.bytes) + 1)[self.starts])

    def keys(self, first: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the runs of ``n`` words that begin at the words ``first``."""
        last = first + n - 1
        value = np.zeros(len(first), np.uint64)
        for (low, high), inverse in zip(self.sums, self.inverse, strict=True):
            part = _reduced(_reduced(high[last] + _PRIME - low[first]) * inverse[first])
            value = (value << _SHIFT) | part
        return mix(value ^ mix(self.salt[self.lang[first]] + np.uint64(n)))

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        """The words of such runs."""
        begin, size = self.starts[first], self.ends[first + n - 1] - self.starts[first]
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        flat = self.bytes[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
        return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])

    def same(self, one: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
        """Whether two runs of ``n`` words each are equal, words and language."""
        size = self.ends[one + n - 1] - self.starts[one]
        out = (size == self.ends[other + n - 1] - self.starts[other]) & (self.lang[one] == self.lang[other])
        size = np.where(out, size, 1)
        at = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(at, size)
        unlike = self.bytes[np.repeat(self.starts[one], size) + step] != self.bytes[np.repeat(self.starts[other], size) + step]
        return out & ~np.logical_or.reduceat(unlike, at) if len(at) else out

    def frequent(self, bits: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length up to ``longest``: first words of runs whose bit is set, as all shorter ones' in them; and their keys."""
        fine = np.ones(len(self.starts), bool)
        for n in range(1, longest + 1):
            first = self.around(fine) if n > 1 else np.arange(len(fine))
            keys = self.keys(first, n)
            held = is_set(bits, keys)
            yield n, first[held], keys[held]
            fine = np.zeros(len(fine), bool)
            fine[first[held]] = True

    def around(self, fine: np.ndarray) -> np.ndarray:
        """First words of runs of one word more, inside a piece, both of whose shorter runs are ``fine``."""
        one = fine & self.joined
        one[:-1] &= fine[1:]
        one[-1:] = False
        return np.flatnonzero(one)


def is_set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs, up to ``MIN_COUNT`` times: that many are enough, and fit a byte."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    if counts is None:
        total = np.diff(np.append(head, len(keys)))
    else:
        total = np.add.reduceat(counts.astype(np.int64), head) if len(head) else np.zeros(0, int)
    return keys[head], np.minimum(total, MIN_COUNT).astype(np.uint8)


COUNTED = "bucket int, keys binary, counts binary"


def _by_bucket(keys: np.ndarray) -> pa.RecordBatch:
    """Counts of a task's fingerprints, a row per bucket: the next 32 bits of each, and a byte for its count.

    Fingerprints that share their first 48 bits are counted together here, which may let one too many pass.
    """
    keys, counts = summed(keys >> np.uint64(64 - BUCKET_BITS - 32))
    bucket = (keys >> np.uint64(32)).astype(np.int32)
    head = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, int)
    offsets = np.append(head, len(keys)).astype(np.int32)
    blob = lambda a: pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets * np.int32(a.itemsize)), pa.py_buffer(a)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[head]), blob(keys.astype(np.uint32)), blob(counts)], ["bucket", "keys", "counts"])


def _slices(batch: pa.RecordBatch) -> Iterator[Slice]:
    """Texts in slices of about ``SLICE_BYTES``; one that is longer is cut at breaks, which no phrase crosses."""
    raw, langs, size = [], [], 0
    for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
        rest = (text or "").encode()
        while rest:
            place = _CUT.search(rest, SLICE_BYTES)
            part, rest = (rest, b"") if place is None else (rest[: place.start()], rest[place.start() :])
            raw.append(part)
            langs.append(lang)
            size += len(part)
            if size >= SLICE_BYTES:
                yield Slice(raw, langs)
                raw, langs, size = [], [], 0
    if raw:
        yield Slice(raw, langs)


def _counted(texts: DataFrame, lengths: tuple[int, ...], known: Broadcast | None) -> DataFrame:
    """Fingerprints of the runs of these lengths with their counts per task; of runs all of whose known parts are frequent."""
    below = min(lengths) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint8) if known else None
        held: list[np.ndarray] = []
        for batch in batches:
            for part in _slices(batch):
                fine = np.zeros(len(part.starts), bool)
                if below:
                    for _, first, _ in part.frequent(bits, below):
                        pass
                    fine[first] = True
                for n in lengths:
                    first = part.around(fine) if n > 1 else np.arange(len(fine))
                    held.append(part.keys(first, n))
                    fine = np.zeros(len(fine), bool)
                    fine[first] = True
                if sum(map(len, held)) >= HELD:
                    yield _by_bucket(np.concatenate(held))
                    held = []
        if held:
            yield _by_bucket(np.concatenate(held))

    return texts.mapInArrow(run, COUNTED)


def _merged(counted: DataFrame) -> DataFrame:
    """Per bucket with a frequent fingerprint: its part of the table of bits."""
    room = 2 ** (BITS - BUCKET_BITS)

    def bits_of(keys: np.ndarray, counts: np.ndarray) -> bytes | None:
        keys, counts = summed(keys, counts)
        place = keys[counts >= MIN_COUNT] >> np.uint32(32 - BITS + BUCKET_BITS)
        if not len(place):
            return None
        flags = np.zeros(room, bool)
        flags[place] = True
        return np.packbits(flags, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, keys, counts, size, limit = None, [], [], 0, HELD
        done: list[tuple[int, bytes]] = []

        def close() -> None:
            if bucket is not None:
                found = bits_of(np.concatenate(keys), np.concatenate(counts))
                if found:
                    done.append((bucket, found))

        for batch in batches:
            for b, k, c in zip(batch.column("bucket").to_pylist(), batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                if b != bucket:
                    close()
                    bucket, keys, counts, size, limit = b, [], [], 0, HELD
                keys.append(np.frombuffer(k, np.uint32))
                counts.append(np.frombuffer(c, np.uint8))
                size += len(keys[-1])
                if size > limit:  # keep what is distinct
                    one, n = summed(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, size, limit = [one], [n], len(one), max(HELD, 2 * len(one))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.binary())], ["bucket", "bits"])
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.binary())], ["bucket", "bits"])

    return counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, bits binary")


def frequent_bits(texts: DataFrame) -> Broadcast:
    """The table of bits of all frequent fingerprints. It has 2**(BITS - 3) bytes, which is also all that the driver gets."""
    spark = texts.sparkSession
    bits = np.zeros(2 ** (BITS - 3), np.uint8)
    section = 2 ** (BITS - BUCKET_BITS - 3)
    known = None
    for lengths in ((1,), (2,), tuple(range(3, LONGEST + 1))):
        found = _merged(_counted(texts, lengths, known)).toArrow()
        for bucket, part in zip(found["bucket"].to_pylist(), found["bits"].to_pylist(), strict=True):
            bits[bucket * section : (bucket + 1) * section] |= np.frombuffer(part, np.uint8)
        if known is not None:
            known.unpersist()
        known = spark.sparkContext.broadcast(bits.tobytes())
    return known


def phrase_rows(part: Slice, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (lang, words, phrase, n) of a slice's runs whose bit is set; with 0 words, the slice's number of words."""
    names = ["lang", "words", "phrase", "n"]
    count = np.bincount(part.lang, minlength=len(part.langs)).astype(np.int64)
    langs = pa.array(part.langs, pa.string())
    yield pa.RecordBatch.from_arrays([langs, pa.array(np.zeros(len(count), np.int32)), pa.array([""] * len(count), pa.string()), pa.array(count)], names)
    for n, first, keys in part.frequent(bits, LONGEST):
        if not len(first):
            break
        _, pointer, group = np.unique(keys, return_index=True, return_inverse=True)
        same = part.same(first, first[pointer][group], n)
        shown = np.concatenate((first[pointer], first[~same]))  # what only shares its fingerprint is shown by its own words
        times = np.concatenate((np.bincount(group[same], minlength=len(pointer)), np.ones(int((~same).sum()), np.int64)))
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(part.lang[shown])), pa.array(np.full(len(shown), n, np.int32)), part.texts(shown, n), pa.array(times.astype(np.int64))], names)


def _phrases(texts: DataFrame, known: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint8)
        for batch in batches:
            for part in _slices(batch):
                yield from phrase_rows(part, bits)

    return texts.mapInArrow(run, "lang string, words int, phrase string, n bigint")


def _parts(phrase: Column, words: Column) -> Column:
    """Runs of two words or more inside a longer phrase, without itself."""
    each = F.split(phrase, " ")
    run = lambda at, n: F.array_join(F.slice(each, at, n), " ")
    two = [run(1, 2), run(2, 2)]
    return F.when(words == 3, F.array(*two)).otherwise(F.array(*two, run(3, 2), run(1, 3), run(2, 3)))


def count_phrases(docs: DataFrame) -> DataFrame:
    """``lang, words, phrase, n`` of all phrases of up to ``LONGEST`` words with ``MIN_COUNT`` occurrences; 0 words: all words of the language."""
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    known = frequent_bits(texts)
    counts = _phrases(texts, known).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return counts.where((F.col("words") == 0) | (F.col("n") >= MIN_COUNT))


def collocations(docs: DataFrame) -> DataFrame:
    """The ``BEST`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    frequent = materialize(count_phrases(docs), "phrases")
    total = frequent.where("words = 0").select("lang", F.col("n"))
    phrases = frequent.where("words > 0")
    several = phrases.where("words > 1").withColumnRenamed("n", "a")
    part = phrases.select("lang", "phrase", "n")

    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # 2,000,000 a / (l + r) in two steps, as a < l + r: each stays within 63 bits
    parts = F.col("l") + F.col("r")
    whole = F.expr("(1000 * a) div (l + r)")
    cuts = cuts.withColumn("score", 2000 * whole + F.expr("(2000 * ((1000 * a) % (l + r))) div (l + r)")).drop("left", "right")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_least"))
    scored = scored.select("lang", "phrase", "a", "_least.l", "_least.r", "_least.score")

    longer = several.where("words > 2").select("lang", F.explode(_parts(F.col("phrase"), F.col("words"))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("_around") < INSIDE_PERCENT * F.col("a"), F.lit(True)))

    order = "score DESC, a DESC, phrase"
    near = kept.withColumn("_place", F.expr(f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), {RANK_SLICES}) ORDER BY {order})")).where(F.col("_place") <= BEST)
    ranked = near.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang ORDER BY {order})").cast("long")).where(F.col("rank") <= BEST)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
