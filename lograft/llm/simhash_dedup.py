"""SimHash near-dedup by pigeonhole blocks.

1. Each text becomes a 64-bit fingerprint: a bit is set when over half of its
   shingle hashes have it set (whole texts, one pass, no shuffle).
2. Documents with equal fingerprints collapse to one representative (partial
   aggregation), so a group of copies of any size is one row afterwards.
3. Pigeonhole: with `max_bits` = d and m = d + 3 blocks, two fingerprints within
   d bits agree on at least 3 blocks. Each representative is keyed by every
   choice of 3 blocks (about 32 of 64 bits); only rows with an equal key meet.
4. Inside a key the distance of candidates is verified and only a spanning
   forest of the links leaves the task, never all pairs. A key with more than
   `crowd` rows is dealt into chunks and every pair of chunks is compared in a
   task of its own.
5. Components of the links by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import byte_rows, column_arrays, connected_components, land, lean, parts, pick_rows, spread, table

SEED = 42
SHINGLE = 3
MAX_BITS = 3
CROWD = 8192
AGREE = 3          # blocks that a key is made of


def fingerprint(body: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text. A-Z are lower-cased; words are runs of
    anything but ASCII white space; shorter texts are one shingle; none: zero."""
    words = (body or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, n = [b" ".join(words)], 1
        line, starts, ends = words[0], [0], [len(words[0])]
    else:
        line = b" ".join(words)
        ends = list(accumulate([len(w) + 1 for w in words]))
        starts = [0, *ends[:len(words) - shingle]]
        ends = [e - 1 for e in ends[shingle - 1:]]
        n = len(ends)
    digest, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for x in range(0, n, 1 << 16):  # bounded for very long texts
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[x:x + (1 << 16)], ends[x:x + (1 << 16)])], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, bodies in byte_rows(batches, "body"):
            fp = np.array([fingerprint(x, shingle) for x in bodies], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(fp)], ["id", "th", "fp"])
    return lean(run)


def _masks(max_bits: int) -> list[int]:
    """Bit masks of every choice of AGREE blocks of max_bits + AGREE, signed."""
    m = max_bits + AGREE
    edges = [round(64 * i / m) for i in range(m + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(blocks[i] for i in pick) for pick in combinations(range(m), AGREE)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def _forest(fp: np.ndarray, rep: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the rows of one key: breadth first,
    each reached row is compared with the rows not yet reached."""
    edges = []
    left = np.arange(len(fp))
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= max_bits
            if near.any():
                hit = left[near]
                left = left[~near]
                edges += [(int(rep[at]), int(x)) for x in rep[hit]]
                todo.extend(hit.tolist())
    return edges


def _link(max_bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c", "key", "i", "j", "fp", "rep"]
        got = column_arrays(batches, names)
        if got is None:
            return
        o = np.lexsort((got["rep"], got["j"], got["i"], got["key"], got["c"]))
        c, key, i, j, fp, rep = (got[n][o] for n in names)
        fp = fp.view(np.uint64)
        new = np.r_[True, (c[1:] != c[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        at = np.flatnonzero(new)
        end = np.r_[at[1:], len(c)]
        out: list[tuple[int, int]] = []
        for s, e in zip(at[end - at > 1].tolist(), end[end - at > 1].tolist()):
            out += _forest(fp[s:e], rep[s:e], max_bits)
            if len(out) > 100_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)
    return lean(run)


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])


def link_fingerprints(reps: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Spanning links (a, b) among representatives (rep long, fp long)."""
    masks = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(m).cast("long").alias("m")) for c, m in enumerate(_masks(max_bits))])
    keyed = reps.withColumn("t", F.explode(masks)).select(F.col("t.c").alias("c"), F.col("fp").bitwiseAND(F.col("t.m")).alias("key"), "fp", "rep")
    full = keyed.groupBy("c", "key").count().filter(F.col("count") > crowd) \
        .select("c", "key", F.ceil(F.col("count") / crowd).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    # chunk x meets every chunk y once: as (x, y) and as (y, x)
    pairs = F.expr("transform(sequence(0, chunks - 1), y -> struct(least(x, y) as i, greatest(x, y) as j))")
    crowded = lookup_join(keyed, full, ["c", "key"], "inner").withColumn("x", mine).withColumn("p", F.explode(pairs)) \
        .select("c", "key", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "fp", "rep")
    rest = lookup_join(keyed, full, ["c", "key"], "left_anti").select("c", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "rep")
    n = parts(reps.sparkSession, reps.count() * len(_masks(max_bits)))
    return rest.unionByName(crowded).repartition(n, "c", "key", "i", "j").mapInArrow(_link(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, th, fp, component): th is the text's hash, component the smallest id
    that links of at most `max_bits` differing bits reach.

    Null and empty texts have fingerprint zero and link like any other. Rows
    that repeat an id share their links. Rows without an id get a fingerprint
    and no component. Extra columns are ignored.
    """
    rows = spread(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th"),
                              F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("body")))
    prints = land(rows.mapInArrow(_fingerprints(shingle), "id long, th long, fp long"), "fingerprints")
    reps = land(prints.filter("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    # an id with several texts has several fingerprints: its rows link too
    same = prints.filter("id is not null").groupBy("id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high")
    again = prints.join(same.select("id"), "id").join(reps, "fp").groupBy("id").agg(F.collect_set("rep").alias("reps")) \
        .select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).filter("a != b")
    links = link_fingerprints(reps, max_bits).unionByName(again)
    comps = connected_components(links)
    classes = reps.join(comps, reps["rep"] == comps["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return prints.join(classes, "fp", "left").select("id", "th", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one document of each group: the smallest doc_id. Rows without
    an id stay. Where that id is repeated, one of its rows stays (the smallest
    text hash)."""
    found = near_duplicates(docs, shingle=shingle, max_bits=max_bits)
    kept = found.filter("id is null or id = component")
    first = kept.groupBy("id").agg(F.min("th").alias("th"), F.count(F.lit(1)).alias("n")).filter("id is not null")
    out = pick_rows(docs, land(kept.filter("id is null").select("id", "th").unionByName(first.select("id", "th")), "kept"))
    if first.filter("n > 1").isEmpty():
        return out
    with_id, without = out.filter("doc_id is not null"), out.filter("doc_id is null")
    return with_id.dropDuplicates(["doc_id"]).unionByName(without)


def op9_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
