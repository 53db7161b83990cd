import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lograft.llm import mixing as M


def targets(sizes, cap=3):
    """Plain resharing: {source: size} -> {source: target}."""
    order = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: 1 + i % 3 for i, s in enumerate(order)}
    out, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if share * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: share * w[s] for s in open_}
        out |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return out


def check(rows, got):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = {}
    for _, t, s in rows:
        sums[s] = sums.get(s, 0) + size(t)
    want = targets(sums)
    by_target = {}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, size(t)) for i, t, _ in rows)
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 3 * r.size
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    assert set(by_target) == {(sums[s], round(want[s], 6)) for s in sums}
    for (_, target), rs in by_target.items():
        n = len([s for s in sums if (sums[s], round(want[s], 6)) == (rs[0].source_size, target)])
        assert abs(sum(r.taken for r in rs) - n * target) <= n * max([r.size for r in rs]) / 2 + 1e-6


def corpus(n, seed):
    r = random.Random(seed)
    src = ["big"] * 30 + ["b", "é", "z", "tiny", "A", None] * 3
    return [(i, " ".join(["w"] * r.randint(1, 40)) + r.choice(["", " $$$ 12", "\n"]), r.choice(src)) for i in range(n)]


@pytest.mark.parametrize("n", [60, 900])
def test_targets_and_sums(spark, n):
    rows = corpus(n, n)
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, source string, size long").repartition(5)
    got = M.mix(df).collect()
    check(rows, got)
    again = M.mix(df.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    # epochs come first: within a source no two documents differ by more than one epoch
    for s in {x[2] for x in rows}:
        ids = {x[0] for x in rows if x[2] == s}
        times = {r.taken // r.size for r in got if r.doc_id in ids}
        assert max(times) - min(times) <= 1


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x y", "c"), (3, "x y", "c"), (None, "p q r", None), (4, "one", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, M.mix(df).collect())
    assert M.mix(df.limit(0)).count() == 0
    out = M.apply_mix(df)
    assert out.columns == df.columns
    taken = sum(r.taken // r.size for r in M.mix(df).filter("size > 0").collect())
    assert out.count() == taken


def test_buckets_of_poor_documents_are_small(spark):
    r = random.Random(4)
    text = {"poor": "12 34 $$ 56 78", "fair": "one 2 three 4", "good": "plain words only"}
    rows = [(i, text[s] if s != "mixed" else r.choice(list(text.values())), s) for i in range(8_000) for s in [r.choice(["poor", "fair", "good", "mixed"])]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size, signs = F.regexp_count("text", F.lit(M.WORD)), F.regexp_count("text", F.lit(M.SIGNS))
    x = df.withColumn("quality", F.greatest(F.lit(M.LEAST_WEIGHT), 1 - signs / size)).withColumn("no_source", F.lit(False)) \
        .withColumn("key", -F.log((F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)) / F.col("quality"))
    docs = x.groupBy("source").agg(F.count(F.lit(1)).alias("docs")).withColumn("buckets", F.ceil(F.sqrt("docs")).cast("long"))
    got = x.join(M._level_counts(x), ["no_source", "source"]).join(docs, "source").withColumn("bucket", M._bucket()).select("source", "key", "bucket", "docs").collect()
    counts = Counter((g.source, g.bucket) for g in got)
    assert max(n / d for (s, _), n in counts.items() for d in {g.docs for g in got if g.source == s}) < 0.05
    for s in text:
        mine = sorted((g.key, g.bucket) for g in got if g.source == s)
        assert [b for _, b in mine] == sorted(b for _, b in mine)      # buckets follow the key
