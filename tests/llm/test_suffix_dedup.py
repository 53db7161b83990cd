import hashlib
import random

import numpy as np
import pytest

from lograft.llm import suffix_dedup as S


def brute(docs, length):
    """docs: [(id, text)] in key order -> removed-byte masks by exhaustive search."""
    seen, masks = set(), []
    for _, text in docs:
        b = (text or "").encode()
        m = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                m[i:i + length] = [True] * length
            seen.add(w)
        masks.append((b, m))
    return masks


def expected(docs, length):
    out = []
    for (i, _), (b, m) in zip(docs, brute(docs, length)):
        spans = sum(1 for j in range(len(m)) if m[j] and (j == 0 or not m[j - 1]))
        out.append((i, len(b), sum(m), spans, hashlib.sha256(bytes(x for x, y in zip(b, m) if not y)).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeñ") for _ in range(r.randint(1, 7))) for _ in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, long = text(40), text(800)
    docs = [None, "", "short", "x" * 99, "y" * 300, "ab" * 200, passage, long, long, long[:900] + "!" + long[901:], long + passage]
    docs += [text(20) + passage[r.randint(0, 30):] + text(5) for _ in range(25)] + [text(60) + passage + text(30) + passage for _ in range(5)]
    docs += [long[r.randint(0, 400):][:r.randint(90, 600)] for _ in range(20)]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("hot", [S.HOT, 3])
def test_matches_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(S, "removed_bytes", lambda keyed, length=S.LENGTH, f=S.removed_bytes: f(keyed, length, hot))
    docs = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(df).collect())
    assert got == expected(docs, S.LENGTH)


def test_entries_cover_every_window_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "SLICE", 150)
    bodies = [t.encode() for _, t in corpus(5) if t]
    starts = {(int(k), int(p)) for w0, w1, ks, s, n in S._entries(list(range(len(bodies))), bodies, 100) for k, s0, m in zip(ks, s, n) for p in range(s0, s0 + m)}
    assert starts == {(i, p) for i, b in enumerate(bodies) for p in range(len(b) - 99)}


def test_dirty_ids_extra_columns_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(1, long, 5), (1, long, 5), (None, long, 6), (2, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k long")
    got = sorted((r.id is None, r.id or 0, r.n_removed) for r in S.suffix_dedup(df).collect())
    n = len(long)
    assert got == [(False, 1, 0), (False, 1, n), (False, 2, 0), (True, 0, n)]
    assert S.suffix_dedup(df.limit(0)).count() == 0


def test_dedup_text_keeps_first_copy_and_columns(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(1, long, "a", len(long)), (1, long, "a", len(long)), (2, "new words " + long, "b", 0), (3, "clean", "c", 5), (4, None, "d", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = S.dedup_text(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect())
    assert got == [(1, long, len(long)), (2, "new words ", 10), (3, "clean", 5), (4, None, None)]


def test_multikey_order():
    r = np.random.default_rng(0)
    words = [r.integers(0, 9, 3000), r.integers(0, 50, 3000), r.integers(0, 10**6, 3000)]
    o = S.multikey_order(words, small=8)
    assert [tuple(int(w[i]) for w in words) for i in o] == sorted(zip(*(w.tolist() for w in words)))
