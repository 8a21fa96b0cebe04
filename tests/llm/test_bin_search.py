"""The local search on bins against plain search for exchanges, and packing in several groups."""

from __future__ import annotations

import itertools
import random

import brute  # noqa: F401  (its folder holds the helpers)
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locusloom.llm import bin_search, packing
from locusloom.llm.packing import PieceIds, best_fit


def an_exchange(sizes, bins, capacity):
    """Some exchange that raises the sum of squared fills, by trying all."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    for a, b in itertools.permutations(range(len(bins)), 2):
        if not (fill[a] <= fill[b] < capacity and fill[a]):
            continue
        for x in bins[a]:
            for back in [(), *itertools.combinations(bins[b], 1), *itertools.combinations(bins[b], 2)]:
                gain = sizes[x] - sum(sizes[i] for i in back)
                if 0 < gain <= capacity - fill[b]:
                    return a, x, b, back
    return None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_ends_at_a_local_optimum(sizes, rng):
    capacity = 40
    order = list(range(len(sizes)))
    rng.shuffle(order)
    bins = []
    for i in order:  # next fit: much to improve
        if bins and sum(sizes[j] for j in bins[-1]) + sizes[i] <= capacity:
            bins[-1].append(i)
        else:
            bins.append([i])
    after = bin_search.improve(sizes, bins, capacity)
    assert sorted(i for b in after for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= capacity for b in after)
    squares = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert squares(after) >= squares(bins) and len(after) <= len(bins)
    least = bin_search.least_bins(np.array(sizes), capacity)
    assert -(-sum(sizes) // capacity) <= least <= len(after)
    if len(after) > least:
        assert an_exchange(sizes, after, capacity) is None


def fewest(sizes, capacity):
    best = len(sizes)

    def place(k, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if k == len(sizes):
            best = len(fills)
            return
        for i in range(len(fills)):
            if fills[i] + sizes[k] <= capacity:
                place(k + 1, (*fills[:i], fills[i] + sizes[k], *fills[i + 1 :]))
        place(k + 1, (*fills, sizes[k]))

    place(0, ())
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_no_packing_has_fewer_bins_than_the_bound(sizes):
    assert bin_search.least_bins(np.array(sizes), 20) <= fewest(sizes, 20)


def test_the_bound_counts_pieces_above_half():
    assert bin_search.least_bins(np.array([11] * 7), 20) == 7
    assert bin_search.least_bins(np.array([11] * 4 + [10] * 3), 20) == 6


def test_more_sources_than_the_emptiest():
    """Exchanges that help lie among the fuller of many underfull bins."""
    sizes = [1100] * 200 + [600, 640] * 3 + [700, 748] * 3
    bins = [[i] for i in range(200)] + [[200 + 2 * i, 201 + 2 * i] for i in range(6)]
    after = bin_search.improve(sizes, bins, 2048)
    assert len(after) < len(bins) and an_exchange(sizes, after, 2048) is None


def test_many_pieces_take_seconds():
    rng = random.Random(3)
    sizes = [rng.choice([rng.randrange(300, 701), rng.randrange(683, 724), rng.randrange(1025, 1226)]) for _ in range(3000)]
    packed = best_fit(sizes)
    assert len(bin_search.improve(sizes, packed, 2048)) < len(packed)


def test_tiny_pieces_in_one_bin():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 4) for _ in range(3000)] + [2047, 2046, 1500]
    after = bin_search.improve(sizes, [[i] for i in range(len(sizes))], 2048)
    assert len(after) == -(-sum(sizes) // 2048)


def test_several_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    texts = [" ".join(f"w{k * j % 97}" for j in range(20 + k * 7 % 400)) for k in range(300)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert {(r.doc_id, r.piece) for r in rows if r.piece == 0} == {(k, 0) for k in range(300)}
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    groups = len({s >> 32 for s in by_sequence if s >= 0})
    assert groups > 3
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // packing.CAPACITY) + groups


ODD = ["'", "s", "t", "re", "ve", "l", "ll", "d", "m", "'S", "ABC", " ", "\n", "1", "²", "½", "ª", "µ", "ß", "é", "É", "ÿ", "Ÿ", "À", "!", "''", '"', "\xa0", "\x85", "\x00", "\x1c", "<|endoftext|>", "…", "İ", "·", "÷", "×", "$"]


@pytest.fixture(scope="module")
def encoder():
    return PieceIds(packing.tokenizer_path())


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(ODD), max_size=14).map("".join), max_size=6))
def test_pieces_have_the_ids_of_whole_texts(encoder, texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
