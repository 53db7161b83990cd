"""Approximate nearest neighbours by multi-index hashing.

Vectors get learned rotated binary codes of CODE_BITS bits, cut into substrings
of 8 bits. Rows are dealt into blocks; each block indexes every substring (key
-> rows). A query probes, per substring, all keys within radius s = 0, 1, ... of
its own: by the pigeonhole principle that retrieves every code within
m * (s + 1) - 1 bits (m substrings). It stops at the first s whose ball holds
enough codes, keeps those within the smallest sufficient Hamming radius, and
reranks them by inner product in double precision on the original vectors.

Queries meet every block (a stated query set against all rows, in blocks): a
task holds one block and streams queries past it. Per query and block only the
best `k` leave the task. Codes are of directions; the rows of a block have norms
within a factor of NORM_STEP of each other, so that in a block the order by
angle is nearly that by inner product. Neither blocks nor balls depend on the
cluster, and the same share of every block is reranked.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .binary_codes import Codes, by_dimension, keyed_vectors, matrix, sample_matrix, usable
from .common import land, table

CODE_WORDS = 4           # 256 bits
BLOCK = 8_192            # most rows indexed by one task at a time
LEAST = 128              # codes that a ball must hold in each block
SHARE = 16               # and one in so many of the block's rows
NORM_STEP = 1.1
NORM_CLASSES = 64        # the last takes all smaller norms
QUERIES = 32             # queries probed together
FOUND = ["own", "query_id", "k", "vec_id", "score"]     # row keys beside ids


class Index:
    """One block: codes, and per 8-bit substring its keys and each row's key."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray):
        self.keys, self.ids, self.x, self.codes = keys, ids, x, codes
        self.subs = []
        for col in codes.view(np.uint8).reshape(len(ids), -1).T:
            keys, row_key = np.unique(col, return_inverse=True)
            self.subs.append((keys, row_key))

    def balls(self, codes: np.ndarray, need: int) -> Iterator[np.ndarray]:
        """For each query code the rows of the smallest Hamming ball that holds
        at least `need` rows (all rows, if fewer)."""
        n, m = len(self.ids), len(self.subs)
        need = min(need, n)
        reach = np.full((len(codes), n), 255, np.uint8)   # radius at which probing finds the row
        for (keys, row_key), mine in zip(self.subs, codes.view(np.uint8).reshape(len(codes), -1).T):
            near = np.bitwise_count(keys[None, :] ^ mine[:, None])
            np.minimum(reach, near[:, row_key], out=reach)
        ham = np.full((len(codes), n), 1 << 14, np.int16)
        todo = np.arange(len(codes))
        for s in range(9):
            q, r = np.nonzero(reach[todo] == s)
            ham[todo[q], r] = np.bitwise_count(self.codes[r] ^ codes[todo[q]]).sum(axis=1, dtype=np.int16)
            todo = todo[(ham[todo] <= m * (s + 1) - 1).sum(axis=1) < need]
            if not len(todo):
                break
        for row in ham:
            radius = np.partition(row, need - 1)[need - 1]
            yield np.flatnonzero(row <= radius)


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _search(codes_b, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, index, held, at = codes_b.value, None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            block, kind, key, ids = (b.column(c).to_numpy() for c in ("block", "kind", "k", "vec_id"))
            x = matrix(b.column("v"))
            edges = np.r_[0, np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1, len(ids)]
            for lo, hi in zip(edges, edges[1:]):
                if block[lo] != at:
                    at, index, held = block[lo], None, []
                if kind[lo] == 0:
                    held.append((key[lo:hi], ids[lo:hi], x[lo:hi]))
                    continue
                if index is None:
                    if not held:
                        continue
                    keys, rows, own = (np.concatenate([h[i] for h in held]) for i in range(3))
                    index, held = Index(keys, rows, own, codes.encode(_directions(own))), [(None, None, None)]
                for s in range(lo, hi, QUERIES):
                    e = min(hi, s + QUERIES)
                    yield _answers(index, key[s:e], ids[s:e], x[s:e], codes.encode(_directions(x[s:e])), k)
    return run


def _answers(index: Index, keys: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, k: int) -> pa.RecordBatch:
    out: list[tuple[np.ndarray, ...]] = []
    need = max(LEAST, 4 * k, -(-len(index.ids) // SHARE))
    for own, q, v, rows in zip(keys, ids, x, index.balls(codes, need)):
        rows = rows[index.keys[rows] != own]
        score = index.x[rows] @ v
        best = np.lexsort((index.keys[rows], index.ids[rows], -score))[:k]
        out.append((np.full(len(best), own), np.full(len(best), q), index.keys[rows][best], index.ids[rows][best], score[best]))
    cols = [np.concatenate([o[i] for o in out]) for i in range(5)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], FOUND)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of every vector
    whose id is divisible by `every`, by inner product, ties to the smaller id.

    Vectors that are null, zero, not finite or without id take no part; vectors of
    another dimension are no candidates. Rows that repeat an id are rows of their
    own, as candidates and as queries. Fewer candidates than `k` give fewer rows;
    extra columns are ignored; an empty table gives an empty result.
    """
    rows = land(usable(keyed_vectors(vectors)), "vectors")
    found = [_nearest(part, k, every, block) for _, part in by_dimension(rows)]
    if not found:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    return functools.reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, k: int, every: int, block: int) -> DataFrame:
    """:func:`nearest` over vectors of one dimension, of which there are some."""
    spark = rows.sparkSession
    # scaled by the largest component first: squares of finite doubles may overflow
    most = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    size = F.log(most) + 0.5 * F.log(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x.cast("double") / most) * (x.cast("double") / most)))
    rows = land(rows.withColumn("size", size), "norms")
    top = rows.agg(F.max("size")).first()[0]
    codes = spark.sparkContext.broadcast(Codes(_directions(sample_matrix(rows)), CODE_WORDS))
    rows = rows.withColumn("norm", F.least(F.lit(NORM_CLASSES - 1), F.floor((F.lit(top) - F.col("size")) / float(np.log(NORM_STEP)) + 1e-6)).cast("int"))
    dealt_to, blocks = [], 0       # by norm class: first block, number of blocks
    sizes = {r["norm"]: r["count"] for r in rows.groupBy("norm").count().collect()}      # at most NORM_CLASSES
    for c in range(NORM_CLASSES):
        own = -(-sizes.get(c, 0) // block)
        dealt_to.append(F.struct(F.lit(blocks).alias("first"), F.lit(max(1, own)).alias("own")))
        blocks += own
    to = F.array(*dealt_to)[F.col("norm")]
    data = rows.select((to["first"] + F.pmod(F.xxhash64("k"), to["own"])).cast("int").alias("block"), F.lit(0).alias("kind"), "k", "vec_id", "v")
    queries = rows.filter(F.col("vec_id") % every == 0) \
        .select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "k", "vec_id", "v")
    dealt = data.unionByName(queries).repartitionById(blocks, "block").sortWithinPartitions("block", "kind")
    found = dealt.mapInArrow(_search(codes, k), "own long, query_id long, k long, vec_id long, score double")
    order = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "k")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
