"""The pipeline's near-duplicate stage against a brute force of five words and 80 percent."""

from __future__ import annotations

import os
import random

import brute
import pytest

import corpus_pipeline
from locusloom.llm import line_crf
from locusloom.llm.common import table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def kept(rows):
    """Ids that stay, by comparing all pairs of sets that share a shingle."""
    sets = {}
    for d, text in rows:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in brute.WORD.findall(text or "")]
        sets[d] = frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in where.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted(d for d in sets if root(d) == d)


def copies():
    r = random.Random(3)
    rows = []
    for group in range(6):
        base = [f"g{group}w{r.randrange(400)}" for _ in range(500)]
        longer = base + [f"t{group}w{k}" for k in range(90 + 6 * group)]
        edited = list(base)
        for k in range(11):
            edited[20 + 44 * k] = f"e{group}w{k}"
        rows += [(10 * group, base), (10 * group + 1, longer), (10 * group + 2, edited)]
    return [(d, " ".join(words)) for d, words in rows]


def test_near_copies_between_the_thresholds_go(spark):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == kept(rows)
    assert got == [d for d, _ in rows if d % 10 == 0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_stage_on_the_documents_of_the_stage_before(spark):
    good = line_crf.keep_good(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in good.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == kept(rows)


def test_unlike_texts_of_one_id_are_documents_of_their_own(spark):
    words = lambda tag, n=40: " ".join(f"{tag}{k}" for k in range(n))
    rows = [
        (5, words("a"), "x"), (1, words("a") + " end", "y"),  # 5 is linked with 1 by this text
        (5, words("b"), "x"),  # and stays with this one
        (7, words("c"), "q"), (7, words("c"), "p"), (7, words("d"), "p"), (8, words("d"), "p"), (9, words("c") + " end", "r"),
        (10, None, "n"), (10, "", "m"), (11, None, "n"), (None, words("a"), "z"), (None, words("a"), "z"), (3, words("e"), None), (3, words("e"), "s"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "")[:2], r._row) for r in kept.collect()), key=str)
    want = [(1, "a0", "y"), (5, "b0", "x"), (7, "c0", "p"), (7, "d0", "p"), (10, "", "n"), (11, "", "n"), (None, "a0", "z"), (None, "a0", "z"), (3, "e0", None)]
    assert got == sorted(want, key=str)
    again = sorted(((r.doc_id, (r.text or "")[:2], r._row) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(7), "").collect()), key=str)
    assert again == got


def test_rows_of_one_id_and_text_are_one(spark):
    rows = [(2, "one two three four five six", "b", {"k": 1}), (2, "one two three four five six", "a", {"k": 2}), (4, "other words here", "c", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, tags map<string, int>")
    got = sorted((r.doc_id, r.lang, r.tags) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == [(2, "a", {"k": 2}), (4, "c", None)]
