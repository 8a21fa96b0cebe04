"""The bits that keep rows out of a shuffle, and what the similarity join shuffles on their account."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom.llm import ngram_join
from locusloom.llm.marks import is_marked, mark_table


def test_all_keys_are_marked_and_hardly_any_other(spark):
    keys = spark.range(0, 3_000_000, 1_000).select(F.col("id").alias("doc"), (F.col("id") * 7).alias("s"))
    known = mark_table(keys)
    rows = spark.range(0, 300_000).select(F.col("id").alias("doc"), (F.col("id") * 7).alias("s")).where(is_marked(known, "doc", "s"))
    got = {r.doc for r in rows.collect()}
    assert got >= set(range(0, 300_000, 1_000)) and len(got) < 330
    assert spark.range(9).where(is_marked(mark_table(keys.select("doc").where("false")), "id")).count() == 0


def sentences(seed=5, phrases=60, texts=200):
    """Texts with words of their own between phrases that many others have, too: alike in no more than these."""
    r = random.Random(seed)
    pool = [" ".join(f"p{k}w{j}" for j in range(6)) for k in range(phrases)]
    return [(d, " ".join(" ".join(f"d{d}x{i}y{j}" for j in range(4)) + " " + p for i, p in enumerate(r.sample(pool, 40)))) for d in range(texts)]


def test_no_frequent_column_passes_for_rare(spark, monkeypatch):
    """However many frequent columns there are: rows that meet in these alone are in no block."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 5, raising=False)
    members = []

    def links(texts, rows, width, like, own=ngram_join.block_links):
        members.append(rows.count())
        return own(texts, rows, width, like)

    monkeypatch.setattr(ngram_join, "block_links", links)
    rows = sentences()
    rows.append((999, rows[7][1] + " one word more"))
    got = {x.doc_id: x.component_id for x in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: 7 if d == 999 else d for d, _ in rows}
    assert members == [2]


@pytest.mark.parametrize("levels", [1, 2, 256])
def test_links_do_not_depend_on_the_tables(spark, monkeypatch, levels):
    rng = np.random.default_rng(levels)
    tables = [rng.integers(0, levels, 1 << bits, dtype=np.uint8 if levels < 256 else np.int64).astype(np.uint8) for bits in ngram_join.LEVEL_BITS]
    monkeypatch.setattr(ngram_join, "frequent_columns", lambda docs, width: tables)
    rows = sentences(6, 45, 30)
    rows += [(100 + d, text + f" end {d}") for d, text in rows[:10]] + [(200, "a b"), (201, "A b"), (202, "a"), (203, ""), (204, None)]
    got = {x.doc_id: x.component_id for x in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d - 100 if 100 <= d < 200 else 200 if d == 201 else d for d, _ in rows}


def test_columns_of_a_prefix_come_back():
    rng = np.random.default_rng(4)
    columns, counts = rng.integers(0, 2**64, 50, dtype=np.uint64, endpoint=False), np.array([0, 20, 0, 30, 0])
    packed = ngram_join._packed(columns, counts)
    for part, want in ((packed, columns), (packed.slice(2, 2), columns[20:])):
        keys, n = ngram_join._unpacked(part)
        assert keys.tolist() == [int(c) & (1 << 40) - 1 for c in want] and n.sum() == len(want)


def test_texts_are_shuffled_only_where_they_are_asked_for(spark):
    texts = spark.createDataFrame([(d, f"a{d} b c d e") for d in range(500)], "doc long, text string")
    places = spark.createDataFrame([(3, 2, 1, 0, 0, 0), (4, 2, 1, 0, 0, 0)], "doc long, n long, block long, tile long, tile_2 long, side int")
    placed = ngram_join._placed_sets(texts, places, 4)
    assert sorted(r.doc for r in placed.collect()) == [3, 4]
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") > plan.index("Join")  # below the join


def test_documents_that_stay_are_not_shuffled(spark):
    rows = [(d, text, "a") for d, text in sentences(7, 60, 40)]
    rows += [(100, rows[3][1], "x"), (5, rows[5][1], "0"), (None, "n", "x"), (None, "n", "x"), (101, "", "x"), (101, None, "x")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    want = [r for r in rows if r[0] != 100 and r not in ((5, rows[5][1], "a"), (101, "", "x"))]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and plan.splitlines()[0].startswith("Union")
