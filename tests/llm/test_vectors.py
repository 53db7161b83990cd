import math

import numpy as np
import pytest

from lograft.llm import nearest_neighbours as N
from lograft.llm import vector_dedup as V
from lograft.llm.binary_codes import Codes

ODD = [(9000, None, 1), (9020, [0.0] * 64, 1), (9040, [float("nan")] + [1.0] * 63, 1), (9060, [float("inf")] + [1.0] * 63, 1), (9080, [None] + [1.0] * 63, 1), (9100, [1.0] * 3, 1), (None, [1.0] * 64, 1)]


def vectors(n=600, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 64))
    group = r.integers(0, n // 6, n)
    x = np.where((r.random(n) < 0.7)[:, None], x[group] + r.normal(size=(n, 64)) * 0.13, x)
    x[5:60] = x[4] + r.normal(size=(55, 64)) * 0.11      # a large group
    x[100:130] = x[99]                                    # exact copies
    x[140] = x[139] * 3
    return x.astype(np.float32), r.integers(0, 3, n)


def brute_links(x, label):
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = (u @ u.T >= V.THRESHOLD) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(comp, np.where(link, comp[None, :], len(x)).min(axis=1))
        if (new == comp).all():
            break
        comp = new
    return link.sum(axis=1), comp


@pytest.mark.parametrize("m,crowd", [(None, V.CROWD), (6, 7), (4, V.CROWD), (12, 10)])
def test_dedup_matches_brute_force(spark, m, crowd):
    x, label = vectors()
    label[:200] = 1
    rows = [(i, v.tolist(), int(y), "n") for i, (v, y) in enumerate(zip(x, label))]
    rows += [(i, v, y, "n") for i, v, y in ODD] + [(9200, x[0].tolist(), None, "n"), (3, x[3].tolist(), int(label[3]), "n")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string").repartition(4)
    got = V.vector_dedup(df, crowd=crowd, m=m).collect()
    assert len(got) == len(rows)
    # the second row of id 3 is a vector of its own
    links, comp = brute_links(np.concatenate([x, x[3:4]]), np.append(label, label[3]))
    assert sum(r.vec_id == 3 for r in got) == 2
    by = {r.vec_id: r for r in got}
    assert links.max() > 40
    found = sum(by[i].n_links for i in range(len(x)))
    assert found >= 0.99 * links.sum() and all(by[i].n_links <= links[i] for i in range(len(x)))
    assert np.mean([by[i].component_id == comp[i] for i in range(len(x))]) >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert [(by[i].n_links, by[i].component_id) for i in (9000, 9020, 9040, 9060, 9080, 9100, 9200)] == [(0, i) for i in (9000, 9020, 9040, 9060, 9080, 9100, 9200)]


@pytest.mark.parametrize("groups,mean", [([0.25] * 3, 1.0), ([1 / 3] * 3, 0.0), ([0.5], 0.0), ([0.25] * 3, 3.0)])
def test_links_of_hot_groups_are_found(spark, groups, mean):
    """Near copies that dominate, also around a common mean direction."""
    r = np.random.default_rng(4)
    x, at = r.normal(size=(900, 64)), 0
    for g in groups:
        n = int(900 * g)
        x[at:at + n] = x[at] + r.normal(size=(n, 64)) * 0.11
        at += n
    x = ((x + mean * r.normal(size=64))[r.permutation(900)]).astype(np.float32)
    links, comp = brute_links(x, np.zeros(900, int))
    got = {r.vec_id: r for r in V.vector_dedup(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")).collect()}
    assert sum(got[i].n_links for i in range(900)) >= 0.999 * links.sum() and all(got[i].n_links <= links[i] for i in range(900))
    assert np.mean([got[i].component_id == comp[i] for i in range(900)]) >= 0.999


def test_every_pair_within_the_radius_is_retrieved():
    """Pigeonhole: within RADIUS bits some substring is within RADIUS // m."""
    r = np.random.default_rng(1)
    for m in V.LAYOUTS:
        t = V.substrings(m)
        assert sum(b for _, b in t) == 64
        for _ in range(300):
            d = sum(1 << int(b) for b in r.choice(64, V.RADIUS, replace=False))
            assert sum(V._first_table(np.array([d], np.uint64), t, V.RADIUS // m, k)[0] for k in range(m)) == 1


def test_layout_follows_size():
    assert V.layout([1000] * 10) == 12 and V.layout([10**6] * 10) in (4, 6) and V.layout([10**8]) == 4


def test_nearest_recall_and_scores(spark):
    x, _ = vectors(1500, 2)
    x[7] *= 4
    rows = [(i, v.tolist(), "n") for i, v in enumerate(x)] + [(i, v, "n") for i, v, _ in ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(4)
    got = {}
    for r in N.nearest(df, block=400).collect():
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == list(range(0, 1500, 20))
    hit = 0
    for q, rs in got.items():
        rs.sort(key=lambda r: r.rank)
        s = x.astype(float) @ x[q].astype(float)
        assert [r.rank for r in rs] == list(range(1, 21)) and all(math.isclose(r.score, s[r.vec_id], rel_tol=1e-12, abs_tol=1e-12) for r in rs)
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs) and q not in [r.vec_id for r in rs]
        s[q] = -np.inf
        hit += len({r.vec_id for r in rs} & set(np.lexsort((np.arange(1500), -s))[:20].tolist()))
    assert hit / (20 * len(got)) >= 0.95


@pytest.mark.parametrize("n", [3000, 12000])
def test_nearest_recall_with_skewed_norms(spark, n):
    """Lognormal norms, random directions; the share reranked does not shrink."""
    r = np.random.default_rng(5)
    x = r.normal(size=(n, 64)) / 8 * np.exp(r.normal(size=(n, 1)))
    every = n // 100
    got = {}
    for q in N.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4), every=every).collect():
        got.setdefault(q.query_id, set()).add(q.vec_id)
    hit = 0
    for q, ids in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(ids & set(np.argsort(-s)[:20].tolist()))
    assert len(got) == 100 and hit / 2000 >= 0.98


def test_nearest_of_repeated_ids_and_mixed_dimensions(spark):
    """Every row is a candidate, whatever its id or dimension; only its own query leaves it out."""
    rows = [(1, [3.0, 0.0]), (1, [0.5, 0.0]), (20, [1.0, 0.0]), (20, [2.0, 0.0]), (40, [1.0, 0.0, 0.0]), (41, [4.0, 0.0, 0.0]), (60, [1.0] * 5)]
    got = N.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = [(i, -s, v) for a, (i, q) in enumerate(rows) if i % 20 == 0
            for s, v in sorted((-sum(x * y for x, y in zip(q, c)), j) for b, (j, c) in enumerate(rows) if a != b and len(c) == len(q))]
    assert sorted((r.query_id, r.score, r.vec_id) for r in got) == sorted(want) and len(want) == 7
    assert sorted(r["rank"] for r in got if r.query_id == 20) == [1, 1, 2, 2, 3, 3]


def test_dedup_of_repeated_ids_and_mixed_dimensions(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (3, [1.0, 0.01], 1), (20, [1.0, 0.02], 1), (30, [1.0, 0.0], 2),
            (31, [0.0, 1.0, 0.0], 1), (32, [0.0, 1.0, 0.01], 1), (7, [0.0, 0.0, 0.0, 1.0], 1), (8, None, 1)]
    got = V.vector_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    want = [(1, 2, 1, True), (1, 1, 1, True), (3, 2, 1, False), (20, 2, 1, False), (30, 1, 1, False),
            (31, 1, 31, True), (32, 1, 31, False), (7, 0, 7, True), (8, 0, 8, True)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_nearest_small_and_empty(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 42)], "vec_id long, embedding array<double>")
    got = N.nearest(df).orderBy("query_id", "rank").collect()
    want = [(q, k + 1, v) for q in (20, 40) for k, v in enumerate(sorted((v for v in range(1, 42) if v != q), reverse=True)[:20])]
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == want
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in N.nearest(few).orderBy("rank").collect()] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0)]
    assert N.nearest(df.limit(0)).count() == 0
    empty = df.withColumn("label", df.vec_id.cast("int")).limit(0)
    assert V.vector_dedup(empty).count() == 0


def test_codes_are_balanced():
    x, _ = vectors(2000, 3)
    bits = np.unpackbits(Codes(x.astype(float), 2).encode(x.astype(float)).view(np.uint8), axis=1)
    assert bits.shape == (2000, 128) and (abs(bits.mean(axis=0) - 0.5) < 0.01).all()
