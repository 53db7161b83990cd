"""Helpers shared by the corpus operators: keys, partition counts, bounded
membership filters, landing, and connected components by alternating stars."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..sinks.files import drop, land

__all__ = ["drop", "land", "lean", "table", "parts", "spread", "keyed_rows", "ordered_keys", "column_arrays", "byte_rows",
           "bitmap", "membership", "may_hold", "keep_members", "connected_components", "row_key", "pick_rows",
           "Remembered", "SPACE", "byte_slices", "spaced"]

# ASCII white space as the contracts write it: [\x20\x09-\x0D]
SPACE = r"\x20\x09-\x0D"
# A membership filter never holds more bits than this (2 MB as words), so its
# broadcast is bounded at every input size. Beyond the bound it only lets more
# rows through; an exact join always follows.
FILTER_BITS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts(spark: SparkSession, rows: int = 0, per: int = 400_000) -> int:
    """Partition count for a keyed exchange whose tasks hold their rows in
    memory: the session's setting, or more when `rows` would exceed `per` each."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per))


BATCH_BYTES = 8 << 20     # of an Arrow batch of texts


def spread(df: DataFrame) -> DataFrame:
    """Prepare a frame for row-parallel Python work: at least the cluster's
    parallelism (large inputs come with enough splits and stay as they are), and
    Arrow batches bounded in bytes, however long the texts are."""
    conf = df.sparkSession.conf
    if _size(conf.get(_BATCH, "64m")) > BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _size(text: str) -> int:
    n = text.strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(n[-1:], 0)
    return int(float(n[:-1] if unit else n) * (1 << unit))


def lean(run: Callable) -> Callable:
    """A task function that gives memory back when its task ends. Workers are
    reused by later stages, and freed blocks would otherwise stay with them."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):     # no glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)
    return task


def keyed_rows(df: DataFrame, id_col: str, body_col: str) -> DataFrame:
    """`df` with `__k`, a unique long in (id, body) order.

    Clean ids (no null, no repeat: one narrow aggregate tells) are their own
    keys. Otherwise rows are range-sorted by (id, body), nulls last, and
    numbered; equal rows get different keys.
    """
    key = F.col(f"`{id_col}`").cast("long")
    n, ids = df.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if n == ids:
        return df.withColumn("__k", key)
    order = [F.asc_nulls_last(f"`{id_col}`"), F.asc_nulls_last(f"`{body_col}`")]
    ranged = df.repartitionByRange(parts(df.sparkSession), *order).sortWithinPartitions(*order)
    return land(ranged.withColumn("__k", F.monotonically_increasing_id()), "keyed")


def ordered_keys(df: DataFrame, id_col: str, body_col: str) -> DataFrame:
    """Rows as (k, id, body) under the keys of :func:`keyed_rows`."""
    return keyed_rows(df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{body_col}`").alias("body")), "id", "body") \
        .select(F.col("__k").alias("k"), "id", "body")


def column_arrays(batches: Iterable[pa.RecordBatch], names: list[str]) -> dict[str, np.ndarray] | None:
    """Numeric columns of all batches of a partition (whose size the partition
    count bounds) as arrays."""
    got = [[b.column(n).to_numpy(zero_copy_only=False) for n in names] for b in batches if b.num_rows]
    if not got:
        return None
    return {n: np.concatenate([g[i] for g in got]) for i, n in enumerate(names)}


def byte_rows(batches: Iterable[pa.RecordBatch], body: str, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """The slices of :func:`byte_slices`, each with its `body` as a list of bytes."""
    for s in byte_slices(batches, body, limit):
        yield s, s.column(body).to_pylist()


def byte_slices(batches: Iterable[pa.RecordBatch], body: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with at most about `limit` bytes of the text or binary
    column `body` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(body)
        sizes = np.diff(np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + b.num_rows + 1])
        group = np.cumsum(sizes) // limit
        cut = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cut, cut[1:]):
            yield b.slice(lo, hi - lo)


def spaced(texts: pa.Array, signs: bytes) -> pa.Array:
    """Texts (none null) with every one of the ASCII `signs` turned into a space."""
    n = len(texts)
    if not n:
        return texts
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = bytes(memoryview(data)[at[0]:at[-1]]) if data is not None else b""
    return pa.StringArray.from_buffers(n, pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(raw.translate(bytes.maketrans(signs, b" " * len(signs)))))


def membership(df: DataFrame, col: str) -> tuple[int, np.ndarray]:
    """A bitmap of hashed `col` values (longs): (bits, words)."""
    return bitmap(df, F.xxhash64(F.col(col).cast("long")))


def bitmap(df: DataFrame, hashed, limit: int = FILTER_BITS) -> tuple[int, np.ndarray]:
    """A bitmap of a hash: (bits, words of 32). Its size follows the number of
    rows up to `limit`; built by partial aggregation."""
    n = max(1, df.count())
    bits = min(limit, 1 << max(10, (8 * n - 1).bit_length()))
    slot = F.pmod(hashed, F.lit(bits))
    words = (df.select(slot.alias("s")).groupBy(F.shiftright("s", 5).cast("int").alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(s % 32 as int)))").alias("b")).toPandas())
    out = np.zeros(bits // 32, np.uint32)
    out[words["w"].to_numpy(int)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return bits, out


def may_hold(df: DataFrame, col: str, member: tuple[int, np.ndarray]):
    """Condition: the row's key may be in the filter (no false negatives)."""
    bits, words = member
    held = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def may(slot):
        import pandas as pd

        s = slot.to_numpy()
        return pd.Series((held.value[s >> 5] >> (s & 31).astype(np.uint32)) & 1 == 1)

    return may(F.pmod(F.xxhash64(F.col(col).cast("long")), F.lit(bits)))


def keep_members(df: DataFrame, col: str, member: tuple[int, np.ndarray]) -> DataFrame:
    return df.filter(may_hold(df, col, member))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list:
    """(id, th) of a row of documents: its id and its text's hash."""
    return [F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th")]


def pick_rows(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of `docs` whose (id, th) is in `keys` ("left_semi") or not
    ("left_anti"), null ids included; columns come back unchanged. Few keys
    (checked) are broadcast and the texts stay where they are."""
    on = ["__none", "__id", "__th"]
    name = lambda id_, th: [id_.isNull().alias(on[0]), F.coalesce(id_, F.lit(0).cast("long")).alias(on[1]), th.alias(on[2])]
    k = keys.select(*name(F.col("id"), F.col("th")))
    tagged = docs.select("*", *name(F.col("doc_id").cast("long"), F.xxhash64(F.col("text"))))
    return lookup_join(tagged, k, on, how).select(*[F.col(f"`{c}`") for c in docs.columns])


class Remembered:
    """Results by key (text to bytes) that a task keeps between batches, within
    about `limit` bytes beside what the current batch adds: keys in use move to
    the young generation, the old one goes when the young has half of that."""

    ENTRY = 200     # bytes of two objects' heads and a place in a dict

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}
        self.size = self.counted = 0

    def turn(self) -> dict:
        """Start a batch; returns the young generation."""
        for k, v in itertools.islice(self.young.items(), self.counted, None):
            self.size += len(k) + len(v) + self.ENTRY
        self.counted = len(self.young)
        if self.size > self.limit // 2:
            self.old, self.young, self.size, self.counted = self.young, {}, 0, 0
        return self.young

    def missing(self, keys) -> list:
        """Keys that are not held; held ones are moved to the young generation."""
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                got = old.get(k)
                if got is None:
                    out.append(k)
                else:
                    young[k] = got
        return out


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of each batch by the stars of its components."""
    for b in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ru, rv = find(u), find(v)
            if ru != rv:
                parent[max(ru, rv)] = min(ru, rv)
        out = [(x, find(x)) for x in list(parent)]
        out = [(x, r) for x, r in out if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([r for _, r in out], pa.int64())], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a long, b long): component
    is the smallest node reachable.

    Batches are first contracted to stars locally; then large-star and
    small-star steps alternate until the edge set is stable. Each step is
    two aggregates and joins keyed by node (hubs pre-aggregate to one minimum;
    AQE splits a hub's join partition), landed in the shared folder, so no
    group is collected and a lost executor costs one step.
    """
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b").mapInArrow(_stars, "a long, b long")
    e = land(e.distinct(), "cc")
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        # large-star edges point down (a > b)
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b") \
            .unionByName(floor.select("a", F.col("m").alias("b"))).distinct()
        e = land(small, "cc")
    # stable: every node but a root has one edge, to its root
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
