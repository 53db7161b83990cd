import random
import re
from collections import Counter, defaultdict

import pytest

from lograft.llm import source_divergence as D


def brute(rows, min_docs, top):
    docs = [(t or "", lang or "", s or "") for t, lang, s in rows]
    words = [re.findall(D.TERM, "".join(c.lower() if c in D.UPPER else c for c in t)) for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [(s, w) for (_, x, s), w in zip(docs, words) if x == lang]
        seen = Counter(t for _, w in mine for t in set(w))
        kept = sorted(t for t in seen if seen[t] >= min_docs)
        v = len(kept)
        count = defaultdict(Counter)
        for s, w in mine:
            count[s].update(t for t in w if t in set(kept))
        every = sum(count.values(), Counter())

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p, q = {s: shares(count[s]) for s in {s for s, _ in mine}}, shares(every)
        gap = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in p:
            pair = [(sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            term = [(gap(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, got, most in (("pair", pair, None), ("term", term, top)):
                got.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(got[:most])]
    return sorted(out)


def corpus(n, seed):
    r = random.Random(seed)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["é", "É", "日本", "naïve", "Ünder"]
    form = [lambda w: w, str.upper, lambda w: w + ",", lambda w: f"({w})", lambda w: f"{w}-{w}", lambda w: f"{w}1{w}", str.title]
    rows = []
    for _ in range(n):
        weights = [1 / (i + 1) for i in range(len(vocab))]
        text = r.choice([" ", "\n", "\t", "\x0b", "　 "]).join(r.choice(form)(w) for w in r.choices(vocab, weights, k=r.randrange(0, 25)))
        rows.append((text, r.choice(["en", "en", "en", "de", None, ""]), r.choice(["hot"] * 5 + [f"s{i}" for i in range(7)] + [None])))
    return rows + [(None, "fr", "only"), ("", "fr", "two"), ("alone", "xx", "one"), (" ", "en", "no terms"), rows[0], rows[0], ("a" * 100_000 + " " + "b " * 50_000, "en", "long")]


@pytest.mark.parametrize("min_docs,block,bucket", [(3, 128, 200_000), (4, 2, 40), (10, 3, 1000)])
def test_equals_brute_force(spark, min_docs, block, bucket):
    rows = corpus(250, min_docs)
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term int").repartition(5)
    got = D.divergence(df, min_docs=min_docs, top=4, block=block, bucket=bucket)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, min_docs, 4)


def test_terms_between_the_bounds(spark):
    """A term whose chunks are all rare, and shared or not by documents."""
    ends = "!?.,;:)("
    one = [(" ".join("Word" + e for e in ends), "en", "a")] * 2                       # 8 chunks, 2 documents
    many = [("term" + e, "en", "b") for e in ends] + [("other" + e * 2, "en", "b") for e in ends[:4]] + [("base", "en", "a")] * 6
    got = D.divergence(spark.createDataFrame(one + many, "text string, lang string, source string"), min_docs=5)
    assert sorted(tuple(r) for r in got.collect()) == brute(one + many, 5, 10)
    assert {r["item"] for r in got.collect() if r["part"] == "term"} == {"term", "base"}


def test_empty_table(spark):
    assert D.divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_counts_beyond_long_products(spark):
    """10^9 (n + 2) does not fit a long."""
    df = spark.createDataFrame([(10**12, 4 * 10**12, 7)], "n long, t long, v long")
    assert df.select(D._share("n", "t", "v").alias("p")).first().p == 1 + 10**9 * (10**12 + 2) // (4 * 10**12 + 14)
