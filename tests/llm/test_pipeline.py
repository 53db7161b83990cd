"""Each stage on its own input against a brute-force version of it."""
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, str(Path(__file__).parent))

from test_mixing import check as check_mix  # noqa: E402
from test_simhash_dedup import slow_components, slow_print  # noqa: E402
from test_suffix_dedup import brute as slow_repeats  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from lograft.llm import mixing, piece_viterbi  # noqa: E402
from lograft.llm.common import land, table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Output of every stage, the table itself first."""
    out = [table(spark, SF, "documents")]
    for name, stage in P.STAGES:
        out.append(land(stage(spark, out[-1], SF), name))
    return out


def test_stage_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "source_mix", "sentencepiece"]
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_language_stage_keeps_clean_documents(steps):
    before, after = ({r.doc_id for r in d.collect()} for d in steps[:2])
    assert after <= before and len(after) >= 0.99 * len(before)


def test_simhash_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    comps = slow_components([(i, slow_print(t)) for i, t in rows])
    assert {r.doc_id for r in steps[2].collect()} == {i for i, c in comps.items() if i == c}


def test_suffix_stage(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[2].collect())
    want = {}
    for (i, _), (b, m) in zip(rows, slow_repeats(rows, 100)):
        kept = bytes(x for x, y in zip(b, m) if not y).decode("utf-8", "ignore")
        if not any(m) or kept.strip(" \t\n\x0b\x0c\r"):
            want[i] = kept
    got = {r.doc_id: r for r in steps[3].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_mix_stage(steps):
    rows = [(r.doc_id, r.text, r.source) for r in steps[3].collect()]
    plan = mixing.mix(steps[3]).collect()
    check_mix(rows, plan)
    assert Counter(r.doc_id for r in steps[4].collect()) == Counter({r.doc_id: r.taken // r.size for r in plan if r.taken})


def test_piece_stage(steps):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_viterbi.MODEL))
    ids = {t: sp.encode(t) for t in {r.text for r in steps[4].collect()}}
    want = sorted((r.doc_id, len(ids[r.text]), zlib.crc32(np.array(ids[r.text], "<i4").tobytes()), "▁" not in r.text) for r in steps[4].collect())
    assert sorted(tuple(r) for r in steps[5].collect()) == want


def test_empty_and_null_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (None, "der die das und schein " * 9, "de", "s", 9), (2, "", "en", "s", 0), (2, "the and of this is here " * 9, "en", None, 9),
            (2, "the and of this is here " * 9, "en", None, 9), (3, "x", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in P.STAGES:
            docs = land(stage(spark, docs, SF), name)
        docs.count()


def test_run_equals_the_stages(spark, steps):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, steps[-1].collect()))
