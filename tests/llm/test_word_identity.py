"""Words that are built to collide under linear hashes are told apart."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from locusloom.llm import ngram_join, substring_dedup
from locusloom.llm.wordhash import hash_windows, hash_words


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def complement(word):
    return word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("seed", [0, 1])
def test_words_differ(seed):
    rng = random.Random(seed)
    words = {"a", "a\0", "\0", "\0\0", "a" * 8, "a" * 9, "a" * 8 + "\0", "ab", "ba", "b" * 16}
    for n in (64, 512, 1024, 2048, 4096):
        words |= {thue_morse(n), complement(thue_morse(n)), thue_morse(n)[: n // 2] * 2}
    for _ in range(3000):  # the same blocks in other orders, one letter changed, blocks swapped
        blocks = [rng.choice(["abababab", "babababa", "aaaaaaaa", "00000000"]) for _ in range(rng.randrange(1, 12))]
        words.add("".join(blocks) + "x" * rng.randrange(9))
    words = sorted(words)
    hashes = hash_words([w.encode() for w in words], seed=seed)[0]
    assert len(hashes) == len(words) == len(set(hashes.tolist()))
    again = hash_words([" ".join(words).encode()], seed=seed)[0]
    assert (again == hashes).all()


def test_windows_of_two_words_differ():
    hashes = hash_words([" ".join(thue_morse(8192)).encode()])[0]
    for width in (13, 64, 1024):
        windows = hash_windows(hashes, width)
        text = thue_morse(8192)
        assert len(set(windows.tolist())) == len({text[i : i + width] for i in range(len(text) - width + 1)})
    assert np.array_equal(hash_windows(hashes, 9000), np.zeros(0, np.uint64))


def test_substring_dedup_of_long_words(spark):
    one, rest = thue_morse(1024), " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{one} {rest}"), (2, f"{complement(one)} {rest}"), (3, f"{one} {rest} end"), (4, "x" * 100_000 + " " + rest)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.substring_dedup(rows)
    assert got[2][1] == 0 and got[3][1] == 13


def test_join_of_long_words(spark):
    one = thue_morse(1024)
    rows = [(1, " ".join([one] * 6)), (2, " ".join([complement(one)] * 6)), (3, " ".join([one] * 7)), (4, "x" * 50_000), (5, "x" * 50_000), (6, "x" * 49_999 + "y")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.jaccard_components(rows)
    assert got[2][1] == 2 and got[3][1] == 1
