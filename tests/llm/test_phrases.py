"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from locusloom.llm import phrases


def brute(rows, best=2000):
    """Rows of (lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = defaultdict(list)
    frequent = {g: c for g, c in f.items() if c >= 30}
    around = {g: c for g, c in frequent.items() if len(g) > 3}
    for g, a in frequent.items():
        lang, words = g[0], g[1:]
        if len(words) < 2:
            continue
        score, _, left, right = min((2_000_000 * a // (f[g[: k + 1]] + f[(lang, *words[k:])]), k, f[g[: k + 1]], f[(lang, *words[k:])]) for k in range(1, len(words)))
        m = len(words)
        if any(h[0] == lang and len(h) > len(g) and 100 * c >= 80 * a and any(h[1 + i : 1 + i + m] == words for i in range(len(h) - m)) for h, c in around.items()):
            continue
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1)}


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = ["the", "The", "of", "new", "york", "ÉTÉ", "été", "new york", "a\tb", "x\x00", "x", "\x1c", "中", "。", "in", "san  francisco bay area"]
    out = [(None, "en"), ("", "en"), (" \t. , \n", "fr"), ("lonely", "xx"), (None, None)]
    for i in range(500):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r", " "]) for _ in range(rng.randrange(1, 40)))
        out.append((text, rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    out += [("one passage that many documents share, word by word", "de")] * 40
    out.append((" ".join(rng.choice(words) for _ in range(30_000)), "en"))
    return out


def test_rows(spark, rows):
    docs = spark.createDataFrame([(i % 7 or None, t, lang, "q", 5) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int").repartition(5)
    want = brute(rows)
    assert len(want) > 50 and got(phrases.collocations(docs)) == want


def test_best_and_empty(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(phrases, "BEST", 5)
    assert got(phrases.collocations(docs)) == brute(rows, 5)
    assert phrases.collocations(docs.where("false")).collect() == []


class Colliding(phrases.Slice):
    def keys(self, first, n):
        return super().keys(first, n) % np.uint64(5) + np.uint64(n * 10)


def test_colliding_fingerprints_are_told_apart_by_their_words():
    texts = ["a bb ccc dddd eeeee f gg", "a bb ccc", "gg a bb, a bb"]
    part = Colliding([t.encode() for t in texts], ["en", "en", "fr"])
    bits = np.full(2 ** (phrases.BITS - 3), 255, np.uint8)
    found = Counter()
    for batch in phrases.phrase_rows(part, bits):
        for row in batch.to_pylist():
            if row["words"]:
                found[(row["lang"], row["phrase"])] += row["n"]
    want = Counter()
    for text, lang in zip(texts, ["en", "en", "fr"], strict=True):
        for piece in text.split(","):
            w = piece.split()
            want.update((lang, " ".join(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert found == want


def test_fingerprints_of_equal_words_are_equal_and_of_others_not():
    thue = "a"
    for _ in range(11):
        thue += thue.translate(str.maketrans("ab", "ba"))
    texts = [f"{thue} x", f"{thue.translate(str.maketrans('ab', 'ba'))} x", f"q. {thue}   x"]
    part = phrases.Slice([t.encode() for t in texts], ["en"] * 3)
    keys = part.keys(np.flatnonzero(part.joined), 2)
    assert keys[0] == keys[2] != keys[1]
    assert part.same(np.array([0, 0]), np.array([5 - 0, 2]), 1).tolist() == [True, False]


def test_long_texts_are_cut_at_breaks(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 50)
    import pyarrow as pa

    text = "one two three, four five. " * 40 + "x" * 200 + " end"
    batch = pa.RecordBatch.from_pydict({"text": [text, None], "lang": ["en", "en"]})
    parts = list(phrases._slices(batch))
    assert len(parts) > 10 and sum(len(p.starts) for p in parts) == len(re.findall("[^ .,]+", text))


def test_counts_merge():
    keys, counts = phrases.summed(np.array([5, 1, 5, 9, 9], np.uint32), np.array([29, 1, 2, 10, 19], np.uint8))
    assert keys.tolist() == [1, 5, 9] and counts.tolist() == [1, 30, 29]
    keys, counts = phrases.summed(np.array([7] * 300 + [3], np.uint64))
    assert keys.tolist() == [3, 7] and counts.tolist() == [1, 30]
