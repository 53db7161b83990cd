import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lograft.llm import bpe_backtrack as B

PATH = public_tokenizers.path(B.TOKENIZER)
PIECES = ["a", "b", "e", "th", "ing", "ß", "İ", "ẞ", "Σ", "ς", "é", "é", "́", "क़", "क़", "1", "²", "½", "'", "'s", "'LL", "’", "<|", "|>",
          "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " ", "\n", " ", "　", "\x0b", "\x1c", "\x85", "​", "!", "?!", "...", ",", "漢", "字", "ภ",
          "😀", "👨‍👩‍👧", "\x00", "\x01", "_", "-", "한", "ᄀ", "ᅡ", "ᆨ", "Ᲊ", "\U00010d50", "ǅ", "ﬁ", "Å", "</w>", "϶", "ϓ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, texts):
    out = []
    for e in library.encode_batch(texts, add_special_tokens=False):
        out.append((len(e.ids), sha(" ".join(map(str, e.ids))), sha(library.decode(e.ids, skip_special_tokens=False))))
    return out


def fuzz(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    mixed = ["".join(r.choice(PIECES) for _ in range(r.randrange(25))) for _ in range(n)]
    letters = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(60))) for _ in range(n)]
    wild = ["".join(chr(r.choice([r.randrange(1, 0x250), r.randrange(0x250, 0xd800), r.randrange(0xe000, 0x11000)])) for _ in range(r.randrange(20))) for _ in range(n)]
    return mixed + letters + wild


def test_ids_equal_the_library(library):
    m, texts = B.model(PATH), fuzz(4000, 3)
    for x in range(0, len(texts), 500):
        some = texts[x:x + 500]
        ids, n = m.encode(pa.array(some, pa.string()))
        cut = np.r_[0, np.cumsum(n)]
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_every_letter_before_every_sign(library):
    """Letters whose lower case is more than letters must not lose their sign."""
    m = B.model(PATH)
    letters = [chr(c) for c in range(0x80, 0x3100) if chr(c).isalpha()]
    texts = [f"{c}{s} a{c}{s}" for c in letters for s in (".", "!")]
    ids, n = m.encode(pa.array(texts))
    cut = np.r_[0, np.cumsum(n)]
    assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words_and_small_memory(library, monkeypatch):
    """One word of many thousand letters, runs that span documents, and a
    memory too small to keep anything."""
    monkeypatch.setattr(B, "RUN", 7)
    monkeypatch.setattr(B, "REMEMBER", 1)
    monkeypatch.setattr(B, "PAIRS", 1)
    m = B.BacktrackBpe(PATH)
    texts = ["a" * 30_000, "", "ab" * 500 + " " + "thing" * 300, "!" * 900, "", "in" * 777, *fuzz(60, 9)]
    for _ in range(2):
        ids, n = m.encode(pa.array(texts))
        assert list(zip(n.tolist(), m.digits.digests(ids, n), m.text.digests(ids, n))) == expected(library, texts)


def test_whole_operator(spark, library):
    texts = fuzz(40, 5) + [None, "", "the same", "the same", "long " * 60_000]
    rows = [(None if i == 3 else i % 100, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    want = sorted((-1 if i is None else i, *e) for (i, _, _), e in zip(rows, expected(library, [t or "" for t in texts])))
    got = B.bpe_digest(df, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()) == want
    enc = B.encode_bpe(df, PATH)
    assert sorted((-1 if r.doc_id is None else r.doc_id, sha(" ".join(map(str, r.ids)))) for r in enc.collect()) == sorted((w[0], w[2]) for w in want)
    assert sorted((-1 if r.doc_id is None else r.doc_id, sha(r.text)) for r in B.decode_bpe(enc, PATH).collect()) == sorted((w[0], w[3]) for w in want)
    assert B.bpe_digest(df.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    with open(PATH) as f:
        spec = json.load(f)
    spec["normalizer"]["normalizers"].pop()
    p = tmp_path / "other.json"
    p.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        B.BacktrackBpe(str(p))
    with pytest.raises(ValueError):
        B.BacktrackBpe(public_tokenizers.path("byte_bpe_50k.json"))
