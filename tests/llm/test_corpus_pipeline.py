"""The pipeline's stages against plain Python, each on what the one before it kept."""

from __future__ import annotations

import os
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from test_llm_operators import packed_ok, water_fill
from test_near_duplicate_stage import kept

import corpus_pipeline
from locusloom.llm import line_crf, packing
from locusloom.llm.common import table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """What each stage returns, written and read again, the table documents first."""
    out = [table(spark, FOLDER, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_stay(outputs):
    assert all(o.columns == outputs[0].columns for o in outputs[1:-1])


def test_quality_stage_keeps_what_the_classifier_accepts(spark, outputs):
    scored = line_crf.score(outputs[0], table(spark, FOLDER, "labels")).where("predicted = 1").collect()
    assert Counter(r.doc_id for r in scored) == Counter(r.doc_id for r in outputs[1].collect())
    good = {r.doc_id for r in table(spark, FOLDER, "labels").where("quality = 1").collect()}
    here = {r.doc_id for r in outputs[0].collect()}
    assert good & here <= {r.doc_id for r in outputs[1].collect()}


def test_one_of_each_group_of_near_copies_stays(outputs):
    rows = [(r.doc_id, r.text) for r in outputs[1].collect()]
    assert sorted(r.doc_id for r in outputs[2].collect()) == kept(rows)  # five words, 80 percent


def test_personal_data_goes_and_other_text_stays(outputs):
    before = {r.doc_id: r.text for r in outputs[2].collect()}
    after = {r.doc_id: r.text for r in outputs[3].collect()}
    assert before.keys() == after.keys()
    changed = 0
    for d, text in after.items():
        assert not brute.personal(text)
        if text != before[d]:
            changed += 1
            assert brute.personal(before[d])
    assert changed > 0


def test_the_mix_comes_near_its_targets(outputs):
    rows = outputs[3].collect()
    sizes, largest = Counter(), Counter()
    for r in rows:
        n = len(brute.WORD.findall(r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    want = water_fill(sizes, 1.5 * sum(sizes.values()))
    mixed, copies = Counter(), Counter()
    for r in outputs[4].collect():
        mixed[r.source] += len(brute.WORD.findall(r.text or ""))
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 2 and set(copies) <= {r.doc_id for r in rows}
    # Whole documents only: at each end of a pass one may be missing or too much.
    assert all(abs(mixed[s] - want[s]) <= largest[s] for s in sizes)


def test_packed_pieces_are_those_of_the_mix(outputs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for r in outputs[4].collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r.doc_id, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048)))
    rows = outputs[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    _, sequences = packed_ok(rows, want)
    assert len(sequences) <= -(-sum(k[3] * n for k, n in want.items()) // packing.CAPACITY) + 1


def test_the_whole_run(spark, outputs):
    got = corpus_pipeline.run(spark, FOLDER)
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got.collect()) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in outputs[5].collect())
