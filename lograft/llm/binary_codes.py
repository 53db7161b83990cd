"""Binary codes by iterative quantisation, and which vectors take part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed_rows

SAMPLE = 10_000      # vectors a rotation is learned from
ROUNDS = 30
SEED = 11


def usable(vectors: DataFrame, *more: str) -> DataFrame:
    """(k, vec_id, *more, v) of the rows of (k, vec_id, embedding, *more) that take
    part: with an id, the vector not null, not zero, all components finite."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = F.col("embedding").cast("array<float>" if kind == "array<float>" else "array<double>")
    return vectors.select("k", "vec_id", *more, v.alias("v")).filter(
        "vec_id is not null and v is not null and forall(v, x -> x is not null and abs(x) < double('infinity')) and exists(v, x -> x != 0)")


def keyed_vectors(vectors: DataFrame, *more: str) -> DataFrame:
    """(k, vec_id, embedding, *more): `k` tells rows apart that repeat an id and
    ascends with it (see keyed_rows); clean ids are their own keys."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", *more)
    return keyed_rows(rows, "vec_id", "embedding").withColumnRenamed("__k", "k")


def by_dimension(rows: DataFrame) -> list[tuple[int, DataFrame]]:
    """`rows` by number of components: only vectors of one dimension have an
    inner product. A model's output has one; each further one is a run of its own."""
    dims = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    return [(d, rows.filter(F.size("v") == d) if len(dims) > 1 else rows) for d in dims]


def matrix(col: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix in double precision."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(col), -1)


def sample_matrix(rows: DataFrame, n: int = SAMPLE) -> np.ndarray:
    """At most `n` vectors (smallest id hash first)."""
    got = rows.orderBy(F.xxhash64("k"), "k").limit(n).toArrow()
    return matrix(got.column("v").combine_chunks()) if got.num_rows else np.zeros((0, 1))


def leaders(x: np.ndarray, cosine: float) -> np.ndarray:
    """Of unit vectors those that are not within `cosine` of an earlier one kept."""
    kept = np.empty((0, x.shape[1]))
    for s in range(0, len(x), 256):
        b = x[s:s + 256]
        b = b[~(b @ kept.T >= cosine).any(axis=1)] if len(kept) else b
        near, mine = b @ b.T >= cosine, []
        for i in range(len(b)):
            if not near[i, mine].any():
                mine.append(i)
        kept = np.concatenate([kept, b[mine]])
    return kept


def quiet_cuts(lead: np.ndarray, every: np.ndarray, width: float) -> np.ndarray:
    """A cut per column near the median of `lead`, moved to where fewest of
    `every` are within `width` if that halves their number."""
    n = len(lead)
    out, reach = np.median(lead, axis=0), min(0.5, 0.1 + 1 / np.sqrt(n))
    low = np.quantile(lead, 0.5 - reach, axis=0) - 4 * width / n
    high = np.quantile(lead, 0.5 + reach, axis=0) + 4 * width / n
    for j, col in enumerate(np.sort(every, axis=0).T):
        at = np.r_[out[j], np.linspace(low[j], high[j], 65)]
        dense = np.searchsorted(col, at + width) - np.searchsorted(col, at - width)
        best = np.lexsort((abs(at - out[j]), dense))[0]
        if 2 * dense[best] <= dense[0]:
            out[j] = at[best]
    return out


class Codes:
    """`words` * 64 bits a vector. Each learned rotation of the leading principal
    directions gives at most 64 balanced bits; several are stacked. With `every`
    the cuts keep clear of where those rows crowd (see quiet_cuts)."""

    def __init__(self, x: np.ndarray, words: int = 1, rounds: int = ROUNDS, seed: int = SEED, every: np.ndarray | None = None, width: float = 0.0):
        rng = np.random.default_rng(seed)
        self.words = words
        self.mean = x.mean(axis=0)
        c = x - self.mean
        _, _, vt = np.linalg.svd(c.T @ c)
        m = min(64, x.shape[1])
        p = vt[:m].T
        v = c @ p
        cols = []
        while sum(a.shape[1] for a in cols) < 64 * words:
            r, _ = np.linalg.qr(rng.normal(size=(m, m)))
            for _ in range(rounds):
                b = np.where(v @ r > 0, 1.0, -1.0)
                u, _, wt = np.linalg.svd(b.T @ v)
                r = wt.T @ u.T
            cols.append(p @ r)
        self.project = np.concatenate(cols, axis=1)[:, :64 * words]
        if every is None:
            self.cut = np.median(c @ self.project, axis=0)     # balanced bits
        else:
            self.cut = quiet_cuts(c @ self.project, (every - self.mean) @ self.project, width)

    def encode(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.project > self.cut
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")
