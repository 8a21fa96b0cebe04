"""Hashes of words and word windows for a batch of texts, with numpy (used inside tasks)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(20250901).integers(1, 2**63, 2, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Texts are hashed in slices of about so many bytes, which bounds the size of temporary arrays.
SLICE_BYTES = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: Iterable[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of encoded texts of about ``SLICE_BYTES`` with the place of their first; a null is an empty text."""
    first, part, size = 0, [], 0
    for i, t in enumerate(texts):
        raw = b"" if t is None else t.encode()
        part.append(raw)
        size += len(raw)
        if size >= SLICE_BYTES:
            yield first, part
            first, part, size = i + 1, [], 0
    if part:
        yield first, part


def hash_runs(data: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash for each of the runs of bytes that ``data`` is made of.

    Eight bytes at a time are mixed with their place in the run, the sum is mixed with its length. Equal runs have equal
    hashes; different ones, however alike, share theirs with a chance of about 2**-64. The two seeds give independent hashes.
    """
    ends = np.cumsum(lengths)
    place = (np.arange(len(data)) - np.repeat(ends - lengths, lengths)).astype(np.uint64)
    lane = place & np.uint64(7)
    head = np.flatnonzero(lane == 0)
    blocks = np.add.reduceat(data.astype(np.uint64) << (lane << np.uint64(3)), head)
    mixed = mix(blocks ^ mix((place[head] >> np.uint64(3)) * _STEP + _SEEDS[seed]))
    n_blocks = (lengths + 7) >> 3
    return mix(np.add.reduceat(mixed, np.cumsum(n_blocks) - n_blocks) + lengths.astype(np.uint64) * _STEP)


def hash_words(raw: list[bytes], lower: bool = False, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word of all texts in order: hash, first byte, end (both in the joined bytes); the joined bytes; and words per text."""
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1))
    starts, ends = edge[::2], edge[1::2]
    if len(starts) > len(ends):
        ends = np.append(ends, len(data))
    if len(starts) == 0:
        return np.zeros(0, np.uint64), starts, ends, data, np.zeros(len(raw), np.int64)
    own = data if not lower else _LOWER[data]
    hashes = hash_runs(own[~space], ends - starts, seed)
    limits = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    return hashes, starts, ends, data, counts


def hash_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbours (across texts too; take those inside one)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out ^= out >> np.uint64(29)  # a step that is not linear, so that patterns of few words don't cancel out
        out *= _STEP
        out += hashes[k : k + n]
    return mix(out)
