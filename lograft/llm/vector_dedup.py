"""Embedding near-dedup: ITQ codes, multi-index Hamming tables, exact rerank.

1. Identical vectors of a label collapse to one class with a size.
2. Rotations learned by iterative quantisation give each class 64-bit codes.
   Two vectors at cosine 0.98 differ in 4 bits on average; what is within RADIUS
   bits in any of the codes is retrieved. A dense group must not set the cuts:
   rotations are fitted to sample rows of which none is near another, and cuts
   keep clear of crowds. There are as many codes as the sample's own pairs need
   (at least 2); if MOST do not find RECALL of them, codes cannot tell these
   vectors apart and each label is compared pair by pair.
3. Each code is cut into m substrings. Two codes within RADIUS bits have a
   substring within r = RADIUS // m bits (pigeonhole): each class is indexed
   under its m substrings and probes the keys within r bits. Every layout
   (m, r) retrieves the same pairs; the one with the least estimated work for
   the label sizes at hand is used.
4. In a table's bucket, candidates within RADIUS bits are reranked by cosine in
   double precision. A pair counts in its first matching table of its first
   matching code only, so only link counts per class and a spanning forest leave the task, never pairs.
   Buckets over `crowd` classes are dealt into chunks compared pair by pair.
5. Components by alternating stars.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .binary_codes import SEED, Codes, by_dimension, keyed_vectors, leaders, matrix, sample_matrix, usable
from .common import connected_components, land, parts, table

THRESHOLD = 0.98
RADIUS = 11
CROWD = 4096
LAYOUTS = (12, 6, 4)       # numbers of substrings
ROW_COST = 400.0           # moving a class once, in code comparisons
APART = 0.95               # cosine from which a sample row adds nothing to the fit
MOST = 6                   # codes of a class
RECALL = 0.999             # of the sample's pairs that the codes must find
PROBED = 500               # sample rows whose pairs are looked at


def substrings(m: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each of m substrings of 64 bits."""
    edges = [round(64 * i / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def flips(bits: int, r: int) -> list[int]:
    """Masks of 1 to r of `bits` bits."""
    return [sum(1 << b for b in some) for k in range(1, r + 1) for some in combinations(range(bits), k)]


def layout(sizes: list[int], radius: int = RADIUS) -> int:
    """The number of substrings with the least estimated work."""
    def work(m: int) -> float:
        r = radius // m
        keys = [(1 + len(flips(b, r)), 1 << b) for _, b in substrings(m)]
        return sum(ROW_COST * n * sum(p for p, _ in keys) + n * n * sum(p / k for p, k in keys) for n in sizes)
    return min(LAYOUTS, key=work)


def fit_codes(x: np.ndarray, threshold: float = THRESHOLD, radius: int = RADIUS) -> tuple[list[Codes], bool]:
    """Codes fitted to sample rows `x` (unit vectors), and whether they find
    RECALL of the linked pairs: of the sample's, and of pairs made to be just
    linked (a sample of a large table may hold no pairs)."""
    lead, width = leaders(x, APART), np.sqrt(2 * (1 - threshold) / x.shape[1])
    off = np.random.default_rng(SEED).normal(size=x.shape)
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-300)
    made = threshold * x + np.sqrt(1 - threshold * threshold) * off
    i, j = np.nonzero(x[:PROBED] @ x.T >= threshold)
    i, j = i[i != j], j[i != j]
    lost, lost_made, out = np.ones(len(i), bool), np.ones(len(x), bool), []
    while len(out) < MOST:
        out.append(Codes(lead, seed=SEED + len(out), every=x, width=width))
        mine, other = out[-1].encode(x)[:, 0], out[-1].encode(made)[:, 0]
        lost &= np.bitwise_count(mine[i] ^ mine[j]) > radius
        lost_made &= np.bitwise_count(mine ^ other) > radius
        good = lost.sum() <= (1 - RECALL) * len(lost) and lost_made.sum() <= (1 - RECALL) * len(lost_made)
        if good and len(out) >= 2:
            return out, True
    return out, False


def _encode(codes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("v"))
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                code = np.stack([c.encode(x)[:, 0] for c in codes.value], axis=1).astype(np.uint64).view(np.int64)
                code = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * code.shape[1], pa.array(code.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*b.columns, code], [*b.schema.names, "code"])
    return run


def _first_table(near: np.ndarray, tables: list[tuple[int, int]], r: int, t: int) -> np.ndarray:
    """Of code differences: is t the first table whose substring is within r?"""
    ok = np.ones(near.shape, bool)
    for s, (first, bits) in enumerate(tables[:t + 1]):
        d = np.bitwise_count((near >> np.uint64(first)) & np.uint64((1 << bits) - 1)) <= r
        ok &= d if s == t else ~d
    return ok


def _first(a: np.ndarray, b: np.ndarray, tables: list[tuple[int, int]], r: int, radius: int, t: int) -> np.ndarray:
    """Of the codes of a x b: is t (tables of the first code, then of the next,
    ...) the first that holds the pair?"""
    c, t = divmod(t, len(tables))
    ok = _first_table(a[:, c, None] ^ b[None, :, c], tables, r, t)
    for s in range(c):
        ok &= np.bitwise_count(a[:, s, None] ^ b[None, :, s]) > radius
    return ok


def _links(ca: np.ndarray, xa: np.ndarray, cb: np.ndarray, xb: np.ndarray, radius: int, threshold: float) -> np.ndarray:
    """Candidates by code, verified by cosine: boolean matrix a x b."""
    out = np.bitwise_count(ca[:, None] ^ cb[None, :]) <= radius
    r, c = np.flatnonzero(out.any(axis=1)), np.flatnonzero(out.any(axis=0))
    if len(r):
        out[np.ix_(r, c)] &= xa[r] @ xb[c].T >= threshold
    return out


def _parts(adj: np.ndarray) -> np.ndarray:
    """Component number of each row of a symmetric adjacency matrix."""
    comp = np.full(len(adj), -1)
    for s in range(len(adj)):
        if comp[s] < 0:
            comp[s] = s
            todo = np.array([s])
            while len(todo):
                todo = np.flatnonzero(adj[todo].any(axis=0) & (comp < 0))
                comp[todo] = s
    return comp


class _Out:
    def __init__(self):
        self.ids, self.n, self.a, self.b = [], [], [], []

    def count(self, ids, sizes, hit) -> None:
        """hit: a x b links; adds the linked sizes to each row of a."""
        some = np.flatnonzero(hit.any(axis=1))
        if len(some):
            self.ids.append(ids[some])
            self.n.append(hit[some].astype(np.int64) @ sizes)

    def edges(self, a, b) -> None:
        self.a.append(np.asarray(a, np.int64))
        self.b.append(np.asarray(b, np.int64))

    def batch(self) -> pa.RecordBatch:
        cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        i, n, a, b = (cat(x) for x in (self.ids, self.n, self.a, self.b))
        self.__init__()
        none = lambda k: pa.nulls(k, pa.int64())
        col = lambda x, pad, front: pa.concat_arrays([none(pad), pa.array(x, pa.int64())] if front else [pa.array(x, pa.int64()), none(pad)])
        return pa.RecordBatch.from_arrays([col(i, len(a), False), col(n, len(a), False), col(a, len(i), True), col(b, len(i), True)], ["id", "n", "a", "b"])


def _compare(m: int, radius: int, threshold: float, step: int = 1024):
    tables, r, radius = _tables(m, radius)

    def bucket(out: _Out, t: int, i: int, j: int, kind, chunk, ids, sizes, code, x) -> Iterator[pa.RecordBatch]:
        own = code[:, t // len(tables)]
        if i != j:      # two chunks of a crowded bucket: only across
            a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        else:
            a = b = np.flatnonzero(kind == 0)
        full = np.zeros((len(a), len(b)), bool)
        for s in range(0, len(a), step):
            rows = a[s:s + step]
            link = _links(own[rows], x[rows], own[b], x[b], radius, threshold)
            if i == j:
                link &= rows[:, None] != b[None, :]
            full[s:s + step] = link
            counted = link & _first(code[rows], code[b], tables, r, radius, t) if link.any() else link
            out.count(ids[rows], sizes[b], counted)
            if i != j:
                out.count(ids[b], sizes[rows], counted.T)
        if i != j:
            if full.any():
                both = np.zeros((len(a) + len(b),) * 2, bool)
                both[:len(a), len(a):] = full
                both[len(a):, :len(a)] = full.T
                comp, ab = _parts(both), np.r_[a, b]
                out.edges(ids[ab], ids[ab[comp]])
            return
        comp = _parts(full) if full.any() else np.arange(len(a))
        out.edges(ids[a][comp != np.arange(len(a))], ids[a[comp[comp != np.arange(len(a))]]])
        probes = np.flatnonzero(kind == 1)
        for s in range(0, len(probes), step):
            p = probes[s:s + step]
            link = _links(own[p], x[p], own[a], x[a], radius, threshold) & (ids[p][:, None] < ids[a][None, :])
            if link.any():
                link &= _first(code[p], code[a], tables, r, radius, t)
                out.count(ids[p], sizes[a], link)
                out.count(ids[a], sizes[p], link.T)
                q, c = np.nonzero(link)
                pair = np.unique(np.stack([q, comp[c]], axis=1), axis=0)
                out.edges(ids[p[pair[:, 0]]], ids[a[pair[:, 1]]])
        if sum(map(len, out.ids)) + sum(map(len, out.a)) > 100_000:
            yield out.batch()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, at = _Out(), [], None
        names = ["label", "t", "key", "i", "j", "kind", "chunk", "id", "size"]

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            cols = [np.concatenate([h[c] for h in held]) for c in range(len(names) + 2)]
            g = {n: cols[k] for k, n in enumerate(names)}
            if len(g["id"]) > 1:
                yield from bucket(out, int(g["t"][0]), int(g["i"][0]), int(g["j"][0]), g["kind"], g["chunk"], g["id"], g["size"], cols[-2], cols[-1])
            held.clear()

        for b in batches:                       # sorted by bucket: one bucket at a time is held
            if not b.num_rows:
                continue
            cols = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
            code = b.column("code").flatten().to_numpy().view(np.uint64).reshape(b.num_rows, -1)
            x = matrix(b.column("v"))
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            cut = np.zeros(b.num_rows, bool)
            for c in cols[:5]:
                cut[1:] |= c[1:] != c[:-1]
            cut = [0, *np.flatnonzero(cut).tolist(), b.num_rows]
            for lo, hi in zip(cut, cut[1:]):
                key = tuple(c[lo] for c in cols[:5])
                if key != at:
                    yield from close()
                    at = key
                held.append([c[lo:hi] for c in cols] + [code[lo:hi], x[lo:hi]])
        yield from close()
        yield out.batch()
    return run


def _tables(m: int, radius: int) -> tuple[list[tuple[int, int]], int, int]:
    """Substrings, bits a substring may differ in, radius; m = 0 is every pair."""
    return (substrings(m), radius // m, radius) if m else ([(0, 0)], 0, 64)


def class_links(classes: DataFrame, codes: int, threshold: float = THRESHOLD, radius: int = RADIUS, crowd: int = CROWD, m: int | None = None) -> DataFrame:
    """Partial results (id, n) - linked sizes - and (a, b) - spanning links - of
    classes (id long, label long, size long, code array<long> of `codes`, v).
    With m = 0 every pair of a label is compared."""
    spark = classes.sparkSession
    if m is None:
        # labels are few; were they many, the largest decide
        sizes = [r["count"] for r in classes.groupBy("label").count().orderBy(F.desc("count")).limit(1000).collect()]
        m = layout(sizes, radius)
    tables, r, _ = _tables(m, radius)
    each = [(c * len(tables) + t, F.shiftrightunsigned(F.col("code")[c], first).bitwiseAND((1 << bits) - 1), bits)
            for c in range(codes if m else 1) for t, (first, bits) in enumerate(tables)]
    keys = []
    for t, own, bits in each:
        for mask in [0, *flips(bits, r)]:
            keys.append(F.struct(F.lit(t).alias("t"), own.bitwiseXOR(F.lit(mask).cast("long")).alias("key"), F.lit(int(mask > 0)).alias("kind")))
    rows = classes.withColumn("k", F.explode(F.array(*keys))).select("label", "k.t", "k.key", "k.kind", "id", "size", "code", "v")
    on = ["label", "t", "key"]
    own = F.array(*[F.struct(F.lit(t).alias("t"), own.alias("key")) for t, own, _ in each])
    full = land(classes.select("label", F.explode(own).alias("k")).select("label", "k.t", "k.key").groupBy(*on).count().filter(F.col("count") > crowd).select(*on, F.ceil(F.col("count") / crowd).cast("int").alias("chunks")), "crowded")
    rows = lookup_join(rows, full, on).withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("chunk", F.when(F.col("kind") == 0, F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).otherwise(-1))
    # an indexed class meets every chunk, a probe meets each chunk once
    groups = F.expr("if(kind = 0, transform(sequence(0, chunks - 1), y -> struct(least(chunk, y) as i, greatest(chunk, y) as j)),"
                    " transform(sequence(0, chunks - 1), y -> struct(y as i, y as j)))")
    rows = rows.withColumn("g", F.explode(groups)).select("label", "t", "key", F.col("g.i").alias("i"), F.col("g.j").alias("j"), "kind", "chunk", "id", "size", "code", "v")
    by = ["label", "t", "key", "i", "j"]
    n = parts(spark, classes.count() * len(keys), 50_000)
    return rows.repartition(n, *by).sortWithinPartitions(*by).mapInArrow(_compare(m, radius, threshold), "id long, n long, a long, b long")


def vector_dedup(vectors: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS, crowd: int = CROWD, m: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Only vectors of one label that is not null and of one dimension are compared.
    Vectors that are null, zero or not finite link with nothing; so do rows
    without id, which are kept and have no component. Rows that repeat an id are
    rows of their own: each links by its own label and vector, and all are kept if
    the id is their component's smallest. Extra columns are ignored; an empty
    table gives an empty result.
    """
    keyed = keyed_vectors(vectors.withColumn("label", F.col("label").cast("long")), "label")
    rows = land(usable(keyed, "label").filter("label is not null"), "vectors")
    every = keyed.select("k", "vec_id")
    parted = [_linked(part, threshold, radius, crowd, m) for _, part in by_dimension(rows)]
    if parted:
        own = every.join(functools.reduce(DataFrame.unionByName, parted), "k", "left")
    else:
        own = every.select("vec_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return own.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))


def _linked(rows: DataFrame, threshold: float, radius: int, crowd: int, m: int | None) -> DataFrame:
    """(k, n_links, component_id) of rows (k, vec_id, label, v) of one dimension."""
    spark = rows.sparkSession
    x = sample_matrix(rows)
    fitted, enough = fit_codes(x / np.linalg.norm(x, axis=1, keepdims=True), threshold, radius)
    if m is None and not enough:
        m = 0
    codes = spark.sparkContext.broadcast(fitted)
    # a class: equal vectors of a label; its least row has its least id, as keys ascend with ids
    least = F.min(F.struct("k", "vec_id"))
    classes = rows.groupBy("label", "v").agg(least.alias("least"), F.count(F.lit(1)).alias("size")) \
        .select(F.col("least.k").alias("id"), F.col("least.vec_id").alias("vec_id"), "label", "size", "v")
    classes = land(classes.select("id", "vec_id", "label", "size", "v").mapInArrow(
        _encode(codes), f"id long, vec_id long, label long, size long, v {classes.schema['v'].dataType.simpleString()}, code array<long>"), "codes")
    found = land(class_links(classes.drop("vec_id"), len(fitted), threshold, radius, crowd, m), "links")
    counts = found.filter("id is not null").groupBy("id").agg(F.sum("n").alias("n"))
    comps = connected_components(found.filter("a is not null").select("a", "b"))
    # components are named by their least key: back to its id
    named = comps.join(classes.select(F.col("id").alias("component"), F.col("vec_id").alias("component_id")), "component").select("node", "component_id")
    result = classes.join(counts, "id", "left").join(named, classes["id"] == named["node"], "left") \
        .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return rows.join(result, ["label", "v"]).select("k", "n_links", "component_id")


def op6_vector_dedup(spark, sf_dir: str) -> DataFrame:
    return vector_dedup(table(spark, sf_dir, "embeddings"))


OP6_SQL = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM e),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {THRESHOLD}),
r AS (SELECT vec_id, vec_id AS near FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.near),
c AS (SELECT vec_id, min(near) AS component_id FROM r GROUP BY 1),
d AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT c.vec_id, CAST(coalesce(d.n_links, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN d USING (vec_id)
"""
