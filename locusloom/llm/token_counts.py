"""Number of tokens of every text: batches of about equal bytes go through the tokenizer, only lengths come back.

A task takes its texts as they come and deals them into batches of about ``BATCH_BYTES``: short texts share a batch, a
text longer than ``PART_BYTES`` is cut into parts that are counted apart and summed, so neither one long text nor many
short ones make a batch that is larger than the others. Inside a batch the parts are cut on, at white space and between an
ASCII letter and a stop or comma, and what is new among these words goes through the tokenizer as one batch; lengths of
words seen lately are kept (``KEPT`` of them). Cuts are safe for the vocabulary ``word_bpe_49k.json``, which
drops white space, never joins tokens across it, and normalises (NFC, one space for many, lower case letter by letter) without
joining such places: a text is cut before an ASCII white space character, between two ASCII digits, each of which is a
token of its own, and between a full-width stop, comma or the like and an ideograph, which are never one token. Between
such places nothing is cut; a part grows until there is one. Strings of special tokens hold none of them.

Defined cases: a null text counts as an empty one (0 bytes, 0 tokens); rows that are repeated or share a ``doc_id`` are
counted each; a null ``doc_id`` stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents
from .packing import Memo

LIMIT = 2048
BATCH_BYTES = 500_000
PART_BYTES = 50_000
# Lengths are kept per worker for at most twice so many words, of at most so many bytes each.
KEPT = 300_000
KEPT_BYTES = 64
_SAFE = re.compile(r"(?=[\x20\x09-\x0D])|(?<=[0-9])(?=[0-9])|(?<=[\u3001\u3002\uFF01\uFF0C\uFF1A\uFF1B\uFF1F])(?=[\u4E00-\u9FFF])")


@cache
def tokenizer(path: str):
    """One per worker process; Spark's tasks are the threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parts(text: str, size: int = PART_BYTES) -> Iterator[str]:
    """The text in pieces of about ``size`` code points, cut at safe places only."""
    begin = 0
    while len(text) - begin > size:
        place = _SAFE.search(text, begin + size)
        if place is None:
            break
        yield text[begin : place.start()]
        begin = place.start()
    yield text[begin:]


def balanced(texts: list[str | None], size: int = BATCH_BYTES) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of parts of about ``size`` bytes, with the place of each part's text."""
    place: list[int] = []
    batch: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        for part in parts(text or ""):
            place.append(i)
            batch.append(part)
            held += len(part) if part.isascii() else len(part.encode())
            if held >= size:
                yield place, batch
                place, batch, held = [], [], 0
    if batch:
        yield place, batch


_BEFORE_STOP = re.compile(rb"(?<=[A-Za-z])(?=[.,;:!?])")


def words_of(part: str) -> list[bytes]:
    """Pieces of a part whose tokens add up to those of the part; in lower case, as the tokenizer has them."""
    raw = part.encode()
    if b"<|" not in raw:  # a special token's string is one in lower case only
        raw = raw.lower()
    return _BEFORE_STOP.sub(b" ", raw).split()  # at ASCII white space only


class Lengths:
    """Numbers of tokens by word, for words as bytes without white space."""

    def __init__(self, path: str):
        self.encode = tokenizer(path).encode_batch_fast
        self.memo = Memo(KEPT)

    def count(self, batch: list[str]) -> list[int]:
        """Number of tokens per part."""
        words = [words_of(part) for part in batch]
        new = self.memo.missing(set().union(*words))
        known = self.memo.now
        known.update(zip(new, map(len, self.encode([w.decode() for w in new], add_special_tokens=False)), strict=True))
        counts = [sum(map(known.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > KEPT_BYTES:
                del known[w]
        return counts


@cache
def lengths(path: str) -> Lengths:
    """One per worker process."""
    return Lengths(path)


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, n_bytes, n_tokens, over_limit per row. ``path``: the vocabulary's on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lengths(path or vocabulary_path())
        for rows in batches:
            counts = np.zeros(rows.num_rows, np.int64)
            for place, batch in balanced(rows.column("text").to_pylist()):
                np.add.at(counts, place, known.count(batch))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("n_bytes"), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = documents(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return sized.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > LIMIT)
