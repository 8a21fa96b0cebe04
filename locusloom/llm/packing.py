"""Packing documents into sequences of at most ``CAPACITY`` tokens: best fit, then swap-based local search.

Documents become token ids with an end id; longer ones are cut into full pieces and a rest. Only piece
lengths matter from there on. Full pieces are sequences already. The others are dealt at random to groups of about
``GROUP`` pieces, each packed in a task of its own: with so many pieces a group wastes less than one
sequence more than the whole would. In a group every piece goes to the fullest bin that takes it (largest first);
then underfull bins exchange pieces (``bin_search``): one piece for one, one for two, or a plain move, each of which raises the
sum of squared fills, until there are no more bins than any packing needs or no exchange is left.

Defined cases: null or empty text is the end id alone; a null ``doc_id`` is kept as it is; repeated rows are packed
as documents of their own; an empty table gives an empty result; columns other than ``doc_id`` and ``text``
are ignored.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bin_search
from .common import small_batches
from .wordhash import hash_runs

CAPACITY = 2048
END = 0
GROUP = 40_000
# Ids of pieces are kept per worker, for at most twice so many (about 170 bytes each).
KEPT = 400_000
# Texts are encoded together up to about so many code points.
SLICE_CHARS = 1_500_000

# Characters U+0000..U+00FF of lower-cased text as the tokenizer sorts them (its rules are fixed values): white space, letters,
# digits, of which each is a piece, and signs. Runs of letters or signs are pieces; so are these after a quote that stands alone.
_SPACE, _LETTER, _NUMBER, _SIGN = range(4)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[*range(9, 14), 32, 0x85, 0xA0]] = _SPACE
_CLASS[[*range(ord("a"), ord("z") + 1), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASS[[*range(ord("0"), ord("9") + 1), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
_AFTER_QUOTE = ("s", "t", "re", "ve", "m", "ll", "d")


def pieces_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of each piece of lower-cased Latin-1 text that ends with white space."""
    kind = _CLASS[data]
    begins = (kind != _SPACE) & ((kind != np.concatenate(([_SPACE], kind[:-1]))) | (kind == _NUMBER))
    quote = np.flatnonzero(begins & (data == ord("'")))
    quote = quote[kind[quote + 1] == _LETTER]
    one, two = data[quote + 1], data[np.minimum(quote + 2, len(data) - 1)]
    for letters in _AFTER_QUOTE:
        hit = one == ord(letters[0])
        if len(letters) == 2:
            hit &= two == ord(letters[1])
        at = quote[hit]
        begins[at + 1] = False
        behind = at + 1 + len(letters)
        begins[behind] |= kind[behind] == _LETTER
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(begins | (kind == _SPACE))  # a piece ends where the next or white space begins
    return starts, stops[np.searchsorted(stops, starts, side="right")] - starts


def pack_ids(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Memo:
    """What is known by word (or hash of one); past ``limit`` words, those not asked for since the last such time are forgotten."""

    def __init__(self, limit: int):
        self.limit, self.now, self.before = limit, {}, {}

    def missing(self, words: Iterable) -> list:
        """Which of the words have to be added; the others are ready in ``now``."""
        if len(self.now) > self.limit:
            self.now, self.before = {}, self.now
        now, before = self.now, self.before
        new = [w for w in words if w not in now]
        if before:
            now.update({w: before[w] for w in new if w in before})
            new = [w for w in new if w not in now]
        return new


class PieceIds:
    """Token ids of texts as bytes of little-endian 32-bit numbers.

    The tokenizer treats runs of letters or of signs, and single digits, one by one, so equal ones have equal ids and are
    encoded once. A worker tells pieces apart by a hash of 64 bits and keeps about a million of them, so two different ones
    are taken for one another with a chance of some 10**-8 in a worker's life. Texts with characters beyond U+00FF, where the normalizer could join characters, with
    separators that Python takes for white space and it does not, or with special tokens go through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.odd = ["\x1c", "\x1d", "\x1e", "\x1f", *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.memo = Memo(KEPT)

    def encode(self, texts: list[str]) -> list[bytes]:
        raw = [self._plain(t) for t in texts]
        found = iter(self._by_pieces([r for r in raw if r is not None]))
        return [next(found) if r is not None else self._whole(t) for t, r in zip(texts, raw, strict=True)]

    def _plain(self, text: str) -> bytes | None:
        """The text in lower case and Latin-1, if it can be cut into pieces."""
        try:
            raw = text.lower().encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if any(s in text for s in self.odd) or (not text.isascii() and len(raw) != len(text)) else raw

    def _by_pieces(self, raw: list[bytes]) -> list[bytes]:
        joined = b"\n".join([*raw, b""])
        data = np.frombuffer(joined, np.uint8)
        starts, lengths = pieces_of(data)
        if not len(starts):
            return [b""] * len(raw)
        inside = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        hashes, first, which = np.unique(hash_runs(data[inside], lengths), return_index=True, return_inverse=True)
        keys = hashes.tolist()
        new = self.memo.missing(keys)
        known = self.memo.now
        at = first[np.searchsorted(hashes, np.array(new, np.uint64))]
        pieces = [joined[s : s + n].decode("latin-1") for s, n in zip(starts[at].tolist(), lengths[at].tolist(), strict=True)]
        for key, e in zip(new, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False), strict=True):
            known[key] = pack_ids(e.ids)
        ids = [known[key] for key in keys]
        size = np.array([len(i) for i in ids], np.int64) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        begin, n = (np.cumsum(size) - size)[which], size[which]
        ends = np.cumsum(n)
        out = flat[np.repeat(begin - ends + n, n) + np.arange(int(ends[-1]))].tobytes()
        limits = np.cumsum([len(r) + 1 for r in raw])
        stops = np.concatenate(([0], ends))[np.searchsorted(starts, limits)] * 4
        return [out[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]

    def _whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)


@cache
def piece_ids(path: str) -> PieceIds:
    """One per worker process."""
    return PieceIds(path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _encoded(encoder: PieceIds, texts: list[str | None]) -> Iterator[bytes]:
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size > SLICE_CHARS:
            yield from encoder.encode(part)
            part, size = [], 0
    yield from encoder.encode(part)


PIECE_COLUMNS = "piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id``, piece, start, length, ids_crc32. ``path``: the tokenizer's, on executors."""
    end = pack_ids([END])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(path or tokenizer_path())
        for batch in batches:
            place, rows = [], []
            for i, ids in enumerate(_encoded(encoder, batch.column("text").to_pylist())):
                ids += end
                for k, start in enumerate(range(0, len(ids) // 4, CAPACITY)):
                    part = ids[4 * start : 4 * (start + CAPACITY)]
                    place.append(i)
                    rows.append((k, start, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(place, pa.int64())), *arrays], ["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PIECE_COLUMNS}")


def best_fit(lengths: list[int]) -> list[list[int]]:
    """Bins of places in ``lengths``: largest first, each to the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_gap: dict[int, list[int]] = defaultdict(list)
    gaps = 0  # a bit for each gap that some bin has
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fitting = gaps >> n
        if fitting:
            gap = n + (fitting & -fitting).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
        else:
            gap, b = CAPACITY, len(bins)
            bins.append([])
        bins[b].append(i)
        if gap > n:
            by_gap[gap - n].append(b)
            gaps |= 1 << (gap - n)
    return bins


def improve(lengths: list[int], bins: list[list[int]]) -> list[list[int]]:
    """Bins after all exchanges that raise the sum of squared fills, while there are more bins than any packing needs."""
    return bin_search.improve(lengths, bins, CAPACITY)


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row per piece with its place: ``sequence_id`` and ``offset`` there."""
    cuts = materialize(cut(docs, path).withColumn("_deal", F.rand(11)), "pieces")
    full = cuts.where(F.col("length") == CAPACITY).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cuts.where(F.col("length") < CAPACITY)
    groups = -(-rest.count() // GROUP) or 1

    def run(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_pylist()
        number = group.column("_group")[0].as_py()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for b, items in enumerate(improve(lengths, best_fit(lengths))):
            at = 0
            for i in items:
                sequence[i], offset[i] = (number << 32) + b, at
                at += lengths[i]
        return group.drop_columns(["_group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = (
        rest.select("doc_id", "piece", "start", "length", "ids_crc32", F.floor(F.col("_deal") * groups).cast("long").alias("_group"))
        .groupBy("_group")
        .applyInArrow(run, f"doc_id {kind}, {PIECE_COLUMNS}, sequence_id bigint, offset bigint")
    )
    return full.unionByName(packed)
