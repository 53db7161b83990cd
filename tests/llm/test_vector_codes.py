import hashlib
import math

import numpy as np
import pytest

from lograft.llm import vector_codes as V


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, sha) by plain k-means on Python's own integers."""
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in {len(v) for _, v, _ in kept}:
        mine = sorted([(i is None, i or 0, [math.floor(256 * x) for x in v], y) for i, v, y in kept if len(v) == dim], key=lambda r: r[:3])
        step = -(-dim // parts)
        cut = [[(v + [0] * (step * parts - dim))[p * step:(p + 1) * step] for p in range(parts)] for _, _, v, _ in mine]
        books = [[c[p] for c in cut[:entries]] for p in range(parts)]

        def near(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            for p in range(parts):
                got = {}
                for c in cut:
                    got.setdefault(near(c[p], books[p])[1], []).append(c[p])
                books[p] = [[sum(z) // len(z) for z in zip(*got[k])] if k in got else e for k, e in enumerate(books[p])]
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for (none, i, _, y), c in zip(mine, cut):
            best = [near(c[p], books[p]) for p in range(parts)]
            out.append((None if none else i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), y, sha))
    total = {}
    for _, _, e, y, _ in out:
        total[y] = total.get(y, 0) + e
    return [(i, c, e, total[y], s) for i, c, e, y, s in out]


def order(rows):
    return sorted((tuple((x is None, x) if i == 0 else x for i, x in enumerate(r)) for r in rows), key=str)


def data(n, dim, seed, scale=0.1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)) * scale
    x[n // 2:n // 2 + n // 4] = x[0] + r.normal(size=(n // 4, dim)) * 0.01      # a dense group
    x[-n // 8:] = x[1]                                                          # exact copies
    return x


@pytest.mark.parametrize("dim,block", [(64, 4096), (64, 100), (32, 4096)])
def test_codes_equal_brute_force(spark, dim, block):
    x = data(400, dim, dim)
    x[20:60] = np.round(x[20:60] * 8) / 8          # ties
    rows = [(int(i) - 50, v.astype(np.float32).tolist(), int(i) % 7 if i % 11 else None) for i, v in enumerate(x)]
    rows = [rows[i] for i in np.random.default_rng(1).permutation(len(rows))]
    df = spark.createDataFrame([(*r, "n") for r in rows], "vec_id long, embedding array<float>, label int, code string").repartition(5)
    got = V.compress(df, block=block)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert order(tuple(r) for r in got.collect()) == order(brute([(i, [float(np.float32(a)) for a in v], y) for i, v, y in rows]))


def test_odd_rows(spark):
    """Nulls, non-finite components, repeated ids, other dimensions, few rows."""
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=16).tolist(), i % 2) for i in range(20)]
    rows += [(3, rows[3][1], 1), (3, r.normal(size=16).tolist(), None), (None, r.normal(size=16).tolist(), 0), (90, None, 1), (91, [None] * 16, 1),
             (92, [float("nan")] * 16, 1), (93, [float("inf")] + [0.0] * 15, 1), (94, [0.0] * 16, None), (95, [], 1), (96, [1.5, -2.5, 0.25], 0), (97, [1.5, -2.5, 7.0], 0), (98, r.normal(size=70).tolist(), 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert order(tuple(x) for x in V.compress(df).collect()) == order(brute(rows))
    assert V.compress(df.limit(0)).count() == 0
    assert V.compress(df.filter("embedding is null")).count() == 0
    with pytest.raises(Exception, match="too large"):
        V.compress(spark.createDataFrame([(1, [1e30], 1)], "vec_id long, embedding array<double>, label int")).count()


def test_trees_hold_sums_and_own_balls():
    """Balls hold their points, sums equal the points', and most points are
    counted without being compared."""
    r = np.random.default_rng(2)
    x = (r.normal(size=(20, 4))[r.integers(0, 20, 3000)] * 900 + r.normal(size=(3000, 4)) * 30).astype(np.int64)
    t = V.Tree.build(x)
    assert sorted(t.order.tolist()) == list(range(3000)) and len(t.start) > 2 * 3000 // V.LEAF
    for k in range(len(t.start)):
        some = t.x[t.start[k]:t.stop[k]]
        assert (some.sum(axis=0) == t.sums[k]).all() and np.sqrt(((some - t.centre[k]) ** 2).sum(axis=1)).max() <= t.radius[k] + 1e-6
        if t.left[k] >= 0:
            assert (t.start[k], t.stop[k]) == (t.start[t.left[k]], t.stop[t.right[k]]) and t.stop[t.left[k]] == t.start[t.right[k]]
    book = x[:64]
    owned, (place, _, _) = t.walk(book)
    assert sum(t.n[b].sum() for b, _ in owned) + len(place) == 3000
    assert sum(t.n[b].sum() for b, _ in owned) > 0
    d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    e, dist = t.assign(book)
    assert (e == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    sums, counts = np.zeros_like(book), np.zeros(64, np.int64)
    t.add(book, sums, counts)
    assert (counts == np.bincount(e, minlength=64)).all() and all((sums[k] == x[e == k].sum(axis=0)).all() for k in range(64))
