import random

import pytest
import xxhash

from lograft.llm import simhash_dedup as S


def slow_print(text, shingle=3):
    words, cur = [], ""
    for ch in text or "":
        ch = ch.lower() if "A" <= ch <= "Z" else ch
        if ch in " \t\n\x0b\x0c\r":
            words, cur = words + [cur] * bool(cur), ""
        else:
            cur += ch
    words += [cur] * bool(cur)
    if not words:
        return 0
    sh = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def slow_components(rows, max_bits=3):
    comp = {i: i for i, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for n, (a, fa) in enumerate(rows):
        for b, fb in rows[:n]:
            if bin(fa ^ fb).count("1") <= max_bits:
                ra, rb = sorted((find(a), find(b)))
                comp[rb] = ra
    return {i: find(i) for i, _ in rows}


def corpus(seed):
    r = random.Random(seed)
    base = [" ".join(r.choice(["Ab", "b,", "ÇÀ", "dd", "e f", "g", "hh"]) for _ in range(300)) for _ in range(6)]
    texts = [None, "", " \t\n", "One", "one TWO", "one two three"] + base
    for b in base:
        for _ in range(8):
            w = b.split(" ")
            w[r.randrange(300)] = "new%d" % r.randrange(9)
            texts.append(" ".join(w))
    r.shuffle(texts)
    return list(enumerate(texts, 5))


@pytest.mark.parametrize("crowd", [S.CROWD, 4])
def test_matches_brute_force(spark, crowd, monkeypatch):
    monkeypatch.setattr(S, "link_fingerprints", lambda reps, bits=3, f=S.link_fingerprints: f(reps, bits, crowd))
    docs = corpus(1)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.id: (r.fp & (2**64 - 1), r.component) for r in S.near_duplicates(df).collect()}
    prints = {i: slow_print(t) for i, t in docs}
    comps = slow_components(list(prints.items()))
    assert got == {i: (prints[i], comps[i]) for i in prints}
    assert len(set(comps.values())) < len(comps) - 10


def test_random_bits_near_threshold(spark):
    r = random.Random(4)
    fps = [r.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for d in (1, 2, 3, 4):
            fps.append(f ^ sum(1 << b for b in r.sample(range(64), d)))
    rows = list({f: i for i, f in enumerate(fps)}.items())
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for f, i in rows], "rep long, fp long")
    links = S.link_fingerprints(df)
    comps = {x.node: x.component for x in S.connected_components(links).collect()}
    want = slow_components([(i, f) for f, i in sorted(rows, key=lambda x: x[1])])
    assert {i: comps.get(i, i) for _, i in rows} == want


def test_dirty_rows_and_keep_first(spark):
    rows = [(7, "same text here", "x"), (7, "same text here", "x"), (3, "same text here", "x"), (None, "same text here", "y"), (9, "other words entirely now", "z"), (9, "totally different content again", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    comps = sorted((r.id is None, r.id or 0, r.component) for r in S.near_duplicates(df).collect())
    assert comps == [(False, 3, 3), (False, 7, 3), (False, 7, 3), (False, 9, 9), (False, 9, 9), (True, 0, None)]
    out = S.keep_first(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "9", "None"]
    assert S.near_duplicates(df.limit(0)).count() == 0 and S.keep_first(df.limit(0)).count() == 0


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 139)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in S.connected_components(df).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, **{i: 5 for i in range(100, 140)}, 5: 5}
