"""Suffix-array dedup: bytes covered by a long string seen earlier are removed.

A byte goes when a string of `length` bytes that covers it also starts earlier
(smaller key, or same document and earlier start); overlaps count and strings
are judged on the input.

Method. Every window of `length` bytes names one suffix inside it: the one
whose leading `GRAM` bytes have the smallest hash (leftmost on ties). That
choice depends on the window's content alone, so equal windows name equal
suffixes and nothing is lost by sorting only the named ones (about one in 35).
Consecutive windows with the same suffix form one entry.

1. Sampled splitters over (leading bytes, content, document, start) deal the
   entries into ranges. A splitter may fall inside one key, so a passage that
   a third of all documents share is spread over many buckets.
2. Each bucket sorts locally by multikey quicksort. Equal entries but the
   first are repeats. Entries that share the leading bytes but not the content
   are left to step 4, and the first and last group of each bucket to step 3.
3. Comparison across boundaries: those edge groups meet by their key.
4. Entries alike only in part ship their bytes and are compared window by
   window under a 128-bit hash; groups over `hot` entries do so through a
   partially aggregated minimum per window, so no group meets in one task.
5. Repeated windows per document join its text once; digests follow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, column_arrays, drop, keep_members, keyed_rows, land, lean, may_hold, membership, ordered_keys, parts, spread, table

LENGTH = 100
GRAM = 24
SLICE = 1 << 19            # bytes that one numpy pass works on
SAMPLE_BYTES = 8_000_000   # expected text in the splitter sample
HOT = 20_000               # entries of one leading key compared in one task
_TOP = np.uint64(0x8000000000000000)
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_MUL = [np.uint64(int(x) | 1) for x in _rng.integers(1 << 62, 1 << 63, 8)]


def _gram_hash(b: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each position (8 + 16 by doubling)."""
    h, n = _BYTE[b], 1
    eight = None
    for m in _MUL[:4]:
        h = h[:-n] * m + h[n:]
        n *= 2
        if n == 8:
            eight = h
    h = h[:len(b) - GRAM + 1] * _MUL[5] + eight[16:16 + len(b) - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= _MUL[6]
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while n * 2 <= w:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    r = w - n
    return np.minimum(v[:len(v) - r], v[r:]) if r else v


def _entries(keys: list[int], bodies: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(w0, w1, k, start, n) of the named suffixes: w0 = 5 leading bytes and 24
    bits of the gram's hash, w1 = hash of all bytes the entry's windows cover,
    n windows from `start`. Texts longer than SLICE are cut into overlapping
    pieces, so memory stays bounded."""
    pieces = []   # (key, body, first byte, end)
    for k, body in zip(keys, bodies):
        for s in range(0, len(body) - length + 1, SLICE):
            pieces.append((k, body, s, min(len(body), s + SLICE + length - 1)))
    i = 0
    while i < len(pieces):
        j, size = i, 0
        while j < len(pieces) and (j == i or size + pieces[j][3] - pieces[j][2] <= SLICE):
            size += pieces[j][3] - pieces[j][2]
            j += 1
        group, i = pieces[i:j], j
        buf = b"".join(body[s:e] for _, body, s, e in group)
        b = np.frombuffer(buf, np.uint8)
        sizes = np.array([e - s for _, _, s, e in group])
        at = np.cumsum(sizes) - sizes
        h = _gram_hash(b)
        v = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        best = (_sliding_min(v, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        wins = sizes - length + 1
        piece = np.repeat(np.arange(len(group)), wins)
        start = np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins) + np.repeat(at, wins)
        best = best[start]
        new = np.r_[True, (best[1:] != best[:-1]) | (piece[1:] != piece[:-1])]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(best)])
        a, s0, p = best[first], start[first], piece[first]
        lead = np.zeros(len(a), np.uint64)
        for x in range(5):
            lead = (lead << np.uint64(8)) | b[a + x].astype(np.uint64)
        w0 = (lead << np.uint64(24)) | (h[a] >> np.uint64(40))
        digest = xxhash.xxh3_64_intdigest
        w1 = np.fromiter((digest(buf[x:y]) for x, y in zip(s0.tolist(), (s0 + n + length - 1).tolist())), np.uint64, len(a))
        key = np.array([g[0] for g in group], np.int64)[p]
        offset = np.array([g[2] for g in group], np.int64)[p]
        yield w0, w1, key, s0 - at[p] + offset, n


def _composite(w0, w1, k, pk) -> np.ndarray:
    """The four words as fixed byte strings that compare like the tuple."""
    words = np.stack([w0, w1, k.astype(np.int64).view(np.uint64) ^ _TOP, pk.astype(np.uint64)], axis=1).astype(">u8")
    return np.ascontiguousarray(words).view("S32").ravel()


def _packed(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start and number of windows (under 256) in one long, in start order."""
    return (start << 8) | n


def multikey_order(words: list[np.ndarray], small: int = 4096) -> np.ndarray:
    """Order of rows by their words: multikey quicksort. Three-way partitions on
    the word at the current depth; only rows equal there go one word deeper."""
    order = np.arange(len(words[0]))
    todo = [(0, len(order), 0)]
    while todo:
        lo, hi, d = todo.pop()
        if hi - lo < 2 or d == len(words):
            continue
        at = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = at[np.lexsort(tuple(w[at] for w in reversed(words[d:])))]
            continue
        v = words[d][at]
        few = np.sort(v[:: max(1, len(v) // 31)])
        pivot = few[len(few) // 2]
        below, above = v < pivot, v > pivot
        same = ~(below | above)
        x, y = lo + int(below.sum()), lo + int(below.sum() + same.sum())
        order[lo:hi] = np.concatenate([at[below], at[same], at[above]])
        todo += [(lo, x, d), (x, y, d + 1), (y, hi, d)]
    return order


def _batch(names: list[str], cols: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)


def _map_entries(length: int, splitters):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = splitters.value if splitters is not None else None
        for b, bodies in byte_rows(batches, "body"):
            for w0, w1, k, s, n in _entries(b.column("k").to_pylist(), bodies, length):
                pk = _packed(s, n)
                cols = [w0.view(np.int64), w1.view(np.int64), k, pk]
                bucket = np.zeros(len(k), np.int32) if cuts is None else np.searchsorted(cuts, _composite(w0, w1, k, pk), side="right").astype(np.int32)
                yield _batch(["w0", "w1", "k", "pk", "bucket"], [*cols, bucket])
    return lean(run)


def _sort_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: repeat; 1: first of its content, alike in part; 2: in the first
    or last group of the bucket (compared across boundaries)."""
    got = column_arrays(batches, ["w0", "w1", "k", "pk"])
    if got is None:
        return
    w0, w1 = got["w0"].view(np.uint64), got["w1"].view(np.uint64)
    o = multikey_order([w0, w1, got["k"], got["pk"]])
    w0, w1, k, pk = w0[o], w1[o], got["k"][o], got["pk"][o]
    group = np.r_[True, w0[1:] != w0[:-1]]
    lead = group | np.r_[True, w1[1:] != w1[:-1]]
    gid = np.cumsum(group) - 1
    classes = np.bincount(gid, weights=lead).astype(np.int64)
    edge = ((gid == 0) | (gid == gid[-1])) & lead
    kind = np.full(len(k), -1, np.int8)
    kind[~lead] = 0
    kind[lead & (classes[gid] > 1)] = 1
    kind[edge] = 2
    out = np.flatnonzero(kind >= 0)
    for x in range(0, len(out), 200_000):
        at = out[x:x + 200_000]
        yield _batch(["w0", "w1", "k", "pk", "kind"], [w0[at].view(np.int64), w1[at].view(np.int64), k[at], pk[at], kind[at].astype(np.int32)])


def _contexts(length: int):
    """The bytes of each entry in a document's list."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, bodies in byte_rows(batches, "body"):
            w0s, ks, ps, out = [], [], [], []
            for k, body, items in zip(b.column("k").to_pylist(), bodies, b.column("items").to_pylist()):
                for it in items:
                    s, n = it["pk"] >> 8, it["pk"] & 255
                    w0s.append(it["w0"])
                    ks.append(k)
                    ps.append(s)
                    out.append(body[s:s + n + length - 1])
            yield pa.RecordBatch.from_arrays([pa.array(w0s, pa.int64()), pa.array(ks, pa.int64()), pa.array(ps, pa.int64()), pa.array(out, pa.binary())], ["w0", "k", "s", "part"])
    return lean(run)


def _windows(b: pa.RecordBatch, length: int):
    """(hash as two words, k, start) of every window of the shipped bytes."""
    bodies = b.column("part").to_pylist()
    digest = xxhash.xxh3_128_digest
    wins = np.array([len(x) - length + 1 for x in bodies])
    h = np.frombuffer(b"".join(digest(x[i:i + length]) for x, n in zip(bodies, wins.tolist()) for i in range(n)), ">u8").reshape(-1, 2).astype(np.uint64)
    k = np.repeat(b.column("k").to_numpy(), wins)
    s = np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins) + np.repeat(b.column("s").to_numpy(), wins)
    return h[:, 0], h[:, 1], k, s


def _runs(k: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Repeated starts as (k, pk) runs of at most 255."""
    if not len(k):
        return
    o = np.lexsort((s, k))
    k, s = k[o], s[o]
    new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1] + 1)]
    i = np.arange(len(k))
    lead = np.maximum.accumulate(np.where(new, i, 0))
    first = np.flatnonzero((i - lead) % 255 == 0)
    n = np.diff(np.r_[first, len(k)])
    yield _batch(["k", "pk"], [k[first], _packed(s[first], n)])


def _compare_windows(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_windows(b.slice(x, 2000), length) for b in batches for x in range(0, b.num_rows, 2000)]
        if not got:
            return
        h0, h1, k, s = (np.concatenate(x) for x in zip(*got))
        o = np.lexsort((s, k, h1, h0))
        again = np.r_[False, (h0[o][1:] == h0[o][:-1]) & (h1[o][1:] == h1[o][:-1])]
        yield from _runs(k[o][again], s[o][again])
    return lean(run)


def _emit_windows(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(0, b.num_rows, 2000):
                h0, h1, k, s = _windows(b.slice(x, 2000), length)
                yield _batch(["h0", "h1", "k", "s"], [h0.view(np.int64), h1.view(np.int64), k, s])
    return lean(run)


def _join_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from _runs(b.column("k").to_numpy(), b.column("s").to_numpy())


def repeats(keyed: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(k, items): for each document (k long, body binary, never null) with
    repeats, the runs of window starts whose window also starts earlier, each
    as start << 8 | windows. Landed; what it was made from is dropped."""
    found, parts_ = _repeated_runs(keyed, length, hot)
    lists = land(found.groupBy("k").agg(F.collect_list("pk").alias("items")), "repeats")
    for p in parts_:
        drop(p)
    return lists


def _repeated_runs(keyed: DataFrame, length: int, hot: int) -> tuple[DataFrame, list[DataFrame]]:
    """(k, pk) runs, and the landed tables they are read from."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spark = keyed.sparkSession
    names, schema = ["w0", "w1", "k", "pk"], "w0 long, w1 long, k long, pk long, bucket int"
    rows, size = keyed.agg(F.count(F.lit(1)), F.sum(F.length("body"))).first()
    n = parts(spark, int((size or 0) // 30), 400_000)
    sample = keyed.sample(min(1.0, SAMPLE_BYTES / max(1, size or 0)), seed=7).mapInArrow(_map_entries(length, None), schema).select(names).toPandas()
    cuts = np.sort(_composite(sample["w0"].to_numpy().view(np.uint64), sample["w1"].to_numpy().view(np.uint64), sample["k"].to_numpy(), sample["pk"].to_numpy())) if len(sample) else np.empty(0, "S32")
    cuts = cuts[np.linspace(0, len(cuts), n + 1)[1:-1].astype(int)] if len(cuts) >= n else cuts
    splitters = spark.sparkContext.broadcast(cuts)
    buckets = keyed.mapInArrow(_map_entries(length, splitters), schema).repartitionById(n, "bucket").select(names)
    sorted_ = land(buckets.mapInArrow(lean(_sort_bucket), "w0 long, w1 long, k long, pk long, kind int"), "suffixes")
    # across boundaries
    edge = sorted_.filter("kind = 2").select(names)
    firsts = edge.groupBy("w0", "w1").agg(F.min(F.struct("k", "pk")).alias("first"))
    classes = firsts.groupBy("w0").agg(F.count(F.lit(1)).alias("classes"))
    edge = edge.join(firsts, ["w0", "w1"]).join(classes, "w0") \
        .select("w0", "k", "pk", ((F.col("first.k") == F.col("k")) & (F.col("first.pk") == F.col("pk"))).alias("is_first"), "classes")
    plain = sorted_.select("w0", "k", "pk", "kind")
    judged = land(plain.filter("kind < 2").unionByName(
        edge.filter("not is_first or classes > 1").select("w0", "k", "pk", F.when(F.col("is_first"), 1).otherwise(0).alias("kind"))), "judged")
    drop(sorted_)
    same = judged.filter("kind = 0").select("k", "pk")
    part = judged.filter("kind = 1").select("w0", "k", "pk")
    n_part = part.count()
    if not n_part:
        return same, [judged]
    lists = part.groupBy("k").agg(F.collect_list(F.struct("w0", "pk")).alias("items"))
    held = keep_members(keyed.select("k", "body"), "k", membership(part.select("k").distinct(), "k"))
    shipped = held.join(lists, "k").mapInArrow(_contexts(length), "w0 long, k long, s long, part binary")
    crowded = part.groupBy("w0").count().filter(F.col("count") > hot).select("w0")
    n = parts(spark, n_part, 10_000)
    if crowded.isEmpty():
        alike = land(shipped.repartition(n, "w0").mapInArrow(_compare_windows(length), "k long, pk long"), "alike")
        return same.unionByName(alike), [judged, alike]
    shipped = land(shipped, "shipped")
    alike = shipped.join(crowded, "w0", "left_anti").repartition(n, "w0").mapInArrow(_compare_windows(length), "k long, pk long")
    wins = shipped.join(crowded, "w0", "left_semi").mapInArrow(_emit_windows(length), "h0 long, h1 long, k long, s long")
    first = wins.groupBy("h0", "h1").agg(F.min(F.struct("k", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = wins.join(first, ["h0", "h1"]).filter("k != first.k or s != first.s").select("k", "s").mapInArrow(_join_runs, "k long, pk long")
    alike = land(alike.unionByName(again), "alike")
    return same.unionByName(alike), [judged, shipped, alike]


def _spans(items: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows of (start, n) runs."""
    out: list[list[int]] = []
    for it in sorted(items):
        s, e = it >> 8, (it >> 8) + (it & 255) + length - 1
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _cut(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for s, e in spans:
        kept.append(body[at:s])
        at = e
    return b"".join([*kept, body[at:]])


def _remove(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, bodies in byte_rows(batches, "body"):
            ns, spans_, kept = [], [], []
            for body, items in zip(bodies, b.column("items").to_pylist()):
                spans = _spans(items, length)
                ns.append(sum(e - s for s, e in spans))
                spans_.append([{"s": s, "e": e} for s, e in spans])
                kept.append(_cut(body, spans))
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(ns, pa.int64()), pa.array(spans_, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(kept, pa.binary())], ["k", "n_removed", "spans", "kept"])
    return lean(run)


def removed_bytes(keyed: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(k, n_removed, spans, kept) of the documents that lose bytes: spans are
    the maximal removed [s, e) runs, kept the remaining bytes."""
    lists = repeats(keyed, length, hot)
    held = keep_members(keyed.select("k", "body"), "k", membership(lists.select("k"), "k"))
    return held.join(lists, "k").mapInArrow(_remove(length), "k long, n_removed long, spans array<struct<s:long,e:long>>, kept binary")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: (k, id, n_bytes, n_removed, n_spans, kept_sha256).

    Null text counts as empty; texts under `length` bytes lose nothing. Rows
    that repeat an id, or have none, are documents of their own, ordered by
    (id, text), nulls last. Extra columns are ignored; an empty table gives an
    empty result.
    """
    keyed = ordered_keys(docs, id_col, text_col).select("k", "id", F.coalesce(F.col("body").cast("binary"), F.lit(b"")).alias("body"))
    keyed = spread(keyed)
    cut = removed_bytes(keyed, length).select("k", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("sha"))
    whole = keyed.select("k", "id", F.length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("own"))
    return whole.join(cut, "k", "left").select(
        "k", "id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))


def dedup_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """`docs` with repeated strings cut out of the text, columns unchanged.

    A cut inside a UTF-8 character drops its broken bytes; `n_chars`, if there
    is one, follows the text. Documents of which nothing but white space is
    left are dropped (what they held is kept elsewhere); documents that lose
    nothing pass as they are, without a shuffle.
    """
    rows = keyed_rows(docs, id_col, text_col)
    body = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    lists = repeats(spread(rows.select(F.col("__k").alias("k"), body.alias("body"))), length) \
        .select(F.col("k").alias("__lk"), F.col("items").alias("__items"))
    may = may_hold(rows, "__k", membership(lists, "__lk"))

    @F.pandas_udf("string")
    def kept(text, items):
        import pandas as pd

        return pd.Series([_cut(t.encode(), _spans(i, length)).decode("utf-8", "ignore") if i is not None else t for t, i in zip(text, items)], dtype=object)

    cut = rows.filter(may).join(lists, F.col("__k") == F.col("__lk"), "left").withColumn("__kept", kept(F.col(f"`{text_col}`"), F.col("__items")))
    cut = cut.filter(F.col("__items").isNull() | F.col("__kept").rlike(r"[^\x20\x09-\x0D]"))
    fields = []
    for c in docs.columns:
        if c == text_col:
            fields.append(F.col("__kept").alias(c))
        elif c == "n_chars":
            fields.append(F.when(F.col("__items").isNull(), F.col("n_chars")).otherwise(F.char_length("__kept")).cast(docs.schema[c].dataType).alias(c))
        else:
            fields.append(F.col(f"`{c}`"))
    return rows.filter(~may).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(cut.select(*fields))


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
