"""Fingerprints against a chunker that goes byte by byte."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locusloom.llm import fingerprints as fp

GEAR = [int(x) for x in fp._GEAR]
BYTE = [int(x) for x in fp._BYTE]
POWER = [int(x) for x in fp._POWER]


def plain_chunks(text):
    raw, out, begin = text.encode(), [], 0
    for p in range(len(raw)):
        length = p + 1 - begin
        rolling = sum(GEAR[raw[p - k] if p >= k else 0] << k for k in range(32)) % 2**32
        asked = int(fp.HARD) if length < fp.NORMAL else int(fp.EASY)
        if p + 1 == len(raw) or length == fp.MOST or (length >= fp.LEAST and rolling & asked == 0):
            out.append(raw[begin : p + 1])
            begin = p + 1
    return out


def plain_set(text):
    found = set()
    for chunk in plain_chunks(text):
        digest = (sum(BYTE[b] * POWER[i] for i, b in enumerate(chunk)) + len(chunk)) % 2**64
        digest = (digest ^ (digest >> 32)) * 0xBF58476D1CE4E5B9 % 2**64
        found.add((digest >> 32 << 8) | len(chunk))
    return found


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    weight = lambda s: sum(c & 255 for c in s)
    return weight(a & b) / min(weight(a), weight(b))


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéß中") for _ in range(rng.randrange(1, 9))) for _ in range(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=200), st.builds(lambda s, n: prose(s, n), st.integers(0, 99), st.integers(1, 60)), st.sampled_from(["a" * 300, "\0" * 100, "ab" * 90])), min_size=1, max_size=5))
def test_chunks_of_a_slice(texts):
    texts = [t.encode(errors="ignore").decode() for t in texts]
    got = fp.chunk_sets(texts)
    assert [s.tolist() for s in got] == [sorted(plain_set(t)) for t in texts]


@pytest.mark.parametrize("partitions", [1, 4])
def test_rows(spark, partitions):
    rows = [(k, prose(k % 23, 5 + k * 3 % 90)) for k in range(40)] + [(100, None), (101, ""), (102, "x"), (103, "a" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = {r.doc_id: r for r in fp.fingerprint(docs).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(got) == len(rows)
    for (d, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        own, new, other = plain_set(text), plain_set(edited), plain_set(following)
        r = got[d]
        assert r.fingerprint == "".join(f"{c:010x}" for c in sorted(own)) and r.edited_fingerprint == "".join(f"{c:010x}" for c in sorted(new))
        assert r.near_edited == pytest.approx(plain_likeness(own, new)) and r.near_next == pytest.approx(plain_likeness(own, other))
