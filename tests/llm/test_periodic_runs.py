"""Runs, extensions and collapsed texts against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from locusloom.llm import periodic_runs
from locusloom.llm.lce import COVER, CYCLE, Extensions


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def all_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                out.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in out.items())


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, re.findall("[^\x20\x09-\x0d]+", text or ""))
    runs = all_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_cover_reaches_every_difference():
    assert {(b - a) % CYCLE for a in COVER for b in COVER} == set(range(CYCLE))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=120), min_size=1, max_size=4), st.integers(1, 40), st.randoms(use_true_random=False))
def test_extensions(parts, repeat, rng):
    parts = [(p * repeat)[:400] for p in parts]
    numbers, groups = [], []
    for k, p in enumerate(parts):
        numbers += [*p, 10 + k]
        groups += [k] * (len(p) + 1)
    ext = Extensions(np.array(numbers), np.array(groups))
    pairs = []
    for _ in range(60):
        i = rng.randrange(len(numbers))
        same = [j for j in range(len(numbers)) if groups[j] == groups[i] and j != i]
        if same:
            pairs.append((i, rng.choice(same)))
    if not pairs:
        return
    one, other = map(np.array, zip(*pairs, strict=True))
    want = []
    for i, j in pairs:
        k = 0
        while max(i, j) + k < len(numbers) and numbers[i + k] == numbers[j + k]:
            k += 1
        want.append(k)
    assert ext.common(one, other).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=6), st.integers(1, 9)), max_size=6), min_size=1, max_size=5))
def test_runs(texts):
    texts = [[c.encode() for piece, times in t for c in piece * times] for t in texts]
    found = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in periodic_runs.find_runs(texts)), strict=True):
        found[t].append(tuple(run))
    assert found == [all_runs(t) for t in texts]


def test_long_runs():
    rng = random.Random(3)
    unit = [str(rng.randrange(50)).encode() for _ in range(700)]
    texts = [unit * 5 + [b"x"] + unit[:-1] * 3 + unit, [b"a"] * 5000, unit * 4, (unit[:30] * 20 + [b"end"]) * 6, [b"%d" % i for i in range(900)]]
    found = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in periodic_runs.find_runs(texts)), strict=True):
        found[t].append(tuple(run))
    assert found == [all_runs(t) for t in texts]


def test_rows(spark):
    rng = random.Random(8)
    texts = [None, "", " \t\n", "one", "a a a a a a", "a a a a a", "x y " * 9, "é\x1cq z\n" * 4 + "é\x1cq", "A a " * 5, "x y " * 3 + "x"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 400))) for _ in range(150)]
    texts += [" ".join(str(rng.randrange(40)) for _ in range(3000)) for _ in range(12)]
    rows = [(None if i == 40 else i, t, "p", 3) for i, t in enumerate(texts)] + [(7, texts[7], "p", 3), (7, "b " * 8, None, None), (None, "c d " * 6, "p", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, period string, start int").repartition(3)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    got = sorted((tuple(r) for r in periodic_runs.report(periodic_runs.plant(docs)).collect()), key=key)
    assert got == sorted((expected(d, t) for d, t, *_ in rows), key=key)
    assert sum(r[1] > 0 for r in got) > 20
    assert periodic_runs.report(periodic_runs.plant(docs.where("false"))).collect() == []


def test_query_against_brute_force(spark):
    from locusloom.llm.queries import op13_periodic_runs

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op13_periodic_runs(spark, folder).collect())
    short = {r.doc_id: expected(r.doc_id, r.text) for r in docs if len(r.text or "") < 6000}
    assert [r for r in got if r[0] in short] == sorted(short.values()) and len(got) == len(docs)
