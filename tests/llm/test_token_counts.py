"""Token counts against the tokenizer on whole texts."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locusloom.llm import token_counts
from locusloom.llm.token_counts import balanced, count_tokens, parts, tokenizer, vocabulary_path

PATH = vocabulary_path()


def whole(text: str | None) -> int:
    return len(tokenizer(PATH).encode(text or "", add_special_tokens=False))


ALPHABET = ["the", "The", "<|ENDOFTEXT|>", "<|", ".", ",", "!?", '."', "K", "A", "ß", "Don't", " ", "\n", "\t ", "12", "3456", "<|endoftext|>", "<|startoftext|>", "é", "́", "İ", "Σς", "中文", "。", "，", "字", "'", "s", " ", "　", "ﬁ", "😀", "½", "\x1c", "\x85", "…", "가", "ᄀ", "ᅡ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join), st.integers(1, 6))
def test_parts_are_cut_at_safe_places_only(text, size):
    cut = list(parts(text, size))
    assert "".join(cut) == text
    assert sum(map(whole, cut)) == whole(text)


def test_batches_are_balanced_by_bytes():
    texts = ["é" * 30] * 50 + ["word " * 4000] + [None, ""] + ["x"] * 1000
    batches = list(balanced(texts, 60_000))
    sizes = [sum(len(t.encode()) for t in b) for _, b in batches]
    assert all(60_000 <= n < 60_000 + token_counts.PART_BYTES * 4 for n in sizes[:-1]) or len(sizes) == 1
    again = [""] * len(texts)
    for place, batch in batches:
        for i, part in zip(place, batch, strict=True):
            again[i] += part
    assert again == [t or "" for t in texts]


def test_rows(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice(ALPHABET) for _ in range(60_000))
    digits = "7" * 120_000
    texts = [None, "", " \n", "Hello, WORLD's 42", "<|endoftext|> a<|endoftext|>b", long, digits, "a" * 60_000, "same", "same"]
    docs = spark.createDataFrame([(None if i == 2 else min(i, 8), t, "en", 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_tokens long, place string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs).collect())
    want = sorted((i != 2, 0 if i == 2 else min(i, 8), len((t or "").encode()), whole(t), whole(t) > 2048) for i, t in enumerate(texts))
    assert got == want
    assert count_tokens(docs.where("false")).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_against_whole_texts(spark, folder):
    from locusloom.llm.queries import op11_token_counts

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op11_token_counts(spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == {i: (len((t or "").encode()), whole(t)) for i, t in docs.items()}
    assert len(rows) == len(docs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ALPHABET, "x" * 200]), max_size=40).map("".join), max_size=4))
def test_words_add_up(texts):
    assert token_counts.lengths(PATH).count(texts) == list(map(whole, texts))


def test_only_short_words_are_kept():
    known = token_counts.Lengths(PATH)
    assert known.count(["a " + "é" * 100 + " b", "a"]) == [whole("a " + "é" * 100 + " b"), 1]
    assert set(known.memo.now) == {b"a", b"b"}
