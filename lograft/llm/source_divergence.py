"""Source divergence audit by chunk factorization.

How far the word use of each source lies from every other source of its
language, and from the language as a whole.

1. White-space chunks are counted per document: how many documents of a
   language hold each, summed within a slice, within a task, then by key.
2. Every globally distinct chunk is cut into terms once, and its terms are
   joined back to the chunk's counts. A term's documents number at least those of
   its most frequent chunk and at most the sum over its chunks.
3. The documents are read again for the chunks of terms that can reach the
   threshold (a filter of bounded size first, an exact join then); occurrences
   are summed per source. Where the bounds of a term leave it open, its chunks
   come with their document, and distinct documents are counted: exact, and far
   fewer rows than all chunks of all documents.
4. Divergence sums over pairs of sources run block by block: sources in blocks
   of BLOCK, terms in buckets of about BUCKET rows. A task holds one block pair
   of one bucket as a matrix and returns one partial sum a pair of sources.
   Terms that neither source has share one value, so they are not visited.

All arithmetic is exact: counts and sums are longs, shares are found in
38-digit decimals.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import bitmap, byte_slices, land, lean, spaced, spread, table

MIN_DOCS = 10        # documents of a language a kept term is in
TOP = 10             # terms reported per source
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = b"\t\n\x0b\x0c\r"
SLICE = 24 << 20     # bytes of text whose chunks are counted together, about
BLOCK = 128          # sources compared in one matrix
BUCKET = 200_000     # rows of a bucket of terms, about
TERMS = 2_000        # terms of a matrix
FILTER_BITS = 1 << 27   # at most, of each filter of chunks (16 MB)
SEED = 42            # fixed value: seed of Spark's xxhash64


def _chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, number of the chunk) of every chunk, and the distinct chunks."""
    rows = pc.split_pattern(spaced(texts, SPACES), " ")
    words = rows.flatten().dictionary_encode()
    per = pc.list_value_length(rows).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(texts)), per), words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined, or cut, to about SLICE bytes of text."""
    held, size = [], 0
    for b in byte_slices(batches, "text", SLICE):
        held.append(b)
        size += b.column("text").nbytes
        if size >= SLICE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each row's value, and the distinct values."""
    d = column.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, chunk, docs) of each slice."""
    for b in _slices(batches):
        row, code, chunks = _chunks(b.column("text"))
        lang, langs = _codes(b.column("lang"))
        row, code = np.divmod(np.unique(row * len(chunks) + code), len(chunks))
        keys, docs = np.unique(lang[row] * len(chunks) + code, return_counts=True)
        lang, code = np.divmod(keys, len(chunks))
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang)), chunks.take(pa.array(code)), pa.array(docs)], ["lang", "chunk", "docs"])


def _slots(chunks: pa.Array) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(c.encode(), SEED) for c in chunks.to_numpy(zero_copy_only=False)), np.uint64, len(chunks))


def _held(slots: np.ndarray, member: tuple[int, np.ndarray]) -> np.ndarray:
    bits, words = member
    s = slots & np.uint64(bits - 1)
    return ((words[(s >> np.uint64(5)).astype(np.int64)] >> (s & np.uint64(31)).astype(np.uint32)) & 1).astype(bool)


def _look(filters):
    """(row, lang, chunk, at: source and n of each source) of the chunks that may
    be in one of two filters: those of the first summed over the slice's documents
    (row null), those of the second for each document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            row, code, chunks = _chunks(b.column("text"))
            (lang, langs), (source, sources) = _codes(b.column("lang")), _codes(b.column("source"))
            slots = _slots(chunks)
            sure, open_ = (_held(slots, f) for f in filters.value)
            some = sure[code] & ~open_[code]
            keys, n = np.unique((lang[row[some]] * len(chunks) + code[some]) * len(sources) + source[row[some]], return_counts=True)
            keys, s = np.divmod(keys, max(1, len(sources)))
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else keys
            at, c = np.divmod(keys[first], max(1, len(chunks)))
            yield _hits(pa.nulls(len(first), pa.int64()), langs.take(pa.array(at)), chunks.take(pa.array(c)), np.r_[first, len(keys)], sources.take(pa.array(s)), n)
            some = open_[code]
            keys, n = np.unique(row[some] * len(chunks) + code[some], return_counts=True)
            at, c = np.divmod(keys, max(1, len(chunks)))
            at, c = pa.array(at), pa.array(c)
            yield _hits(b.column("row").take(at), b.column("lang").take(at), chunks.take(c), np.arange(len(n) + 1), b.column("source").take(at), n)
    return lean(run)


def _hits(row: pa.Array, lang: pa.Array, chunk: pa.Array, ends: np.ndarray, source: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    at = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([source, pa.array(n.astype(np.int64))], ["source", "n"]))
    return pa.RecordBatch.from_arrays([row, lang, chunk, at], ["row", "lang", "chunk", "at"])


def _occurrences(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n) of the terms in at least `min_docs` documents of
    the language."""
    spark = docs.sparkSession
    # slices are summed already, so a hot chunk has a row a slice and language; one exchange serves both sums
    per = docs.select("lang", "text").mapInArrow(lean(_count), "lang string, chunk string, docs long") \
        .repartition("chunk").groupBy("chunk", "lang").agg(F.sum("docs").alias("docs"))
    once = per.groupBy("chunk").agg(F.collect_list(F.struct("lang", "docs")).alias("at")) \
        .withColumn("terms", F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), 0)).filter(F.size("terms") > 0)
    of = land(once.select("chunk", "terms", F.explode("at").alias("at")).select("at.lang", "chunk", "at.docs", "terms"), "chunk-terms")
    bounds = of.select("lang", "docs", F.explode(F.array_distinct("terms")).alias("term")).groupBy("lang", "term").agg(F.max("docs").alias("low"), F.sum("docs").alias("high"))
    bounds = land(bounds.filter(F.col("high") >= min_docs).select("lang", "term", (F.col("low") >= min_docs).alias("sure")), "term-bounds")
    # the chunks of those terms, each term with its number in the chunk
    wanted = lookup_join(of.select("lang", "chunk", F.explode("terms").alias("term")), bounds, ["lang", "term"], "inner")
    wanted = land(wanted.groupBy("lang", "chunk", "term", "sure").agg(F.count(F.lit(1)).alias("m")), "wanted-chunks")
    hashed = F.xxhash64("chunk")
    filters = spark.sparkContext.broadcast((bitmap(wanted.filter("sure"), hashed, FILTER_BITS), bitmap(wanted.filter("not sure"), hashed, FILTER_BITS)))
    seen = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_look(filters), "row long, lang string, chunk string, at array<struct<source string, n long>>")
    hits = lookup_join(seen, wanted, ["lang", "chunk"], "inner").select("lang", "term", "sure", F.when(~F.col("sure"), F.col("row")).alias("row"), "m", F.inline("at"))
    found = land(hits.groupBy("lang", "source", "term", "sure", "row").agg(F.sum(F.col("n") * F.col("m")).alias("n")), "term-counts")
    # by (lang, term), which the window of the caller needs too
    total = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    kept = found.filter("not sure").select("lang", "term", "row").distinct().groupBy("lang", "term").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= min_docs)
    sure = bounds.filter("sure").select("lang", "term")
    return lookup_join(total, sure.unionByName(kept.select("lang", "term")), ["lang", "term"], "left_semi")


def _share(n: str, total: str, terms: str) -> F.Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exact for any long: in longs
    while the product fits one, else in decimals."""
    return F.expr(f"1 + if({n} < 9000000000, (1000000000 * ({n} + 2)) div ({total} + 2 * {terms}), "
                  f"(cast(1000000000 as decimal(10,0)) * cast({n} + 2 as decimal(19,0))) div cast({total} + 2 * {terms} as decimal(20,0)))")


def _gap(p: str, q: str) -> F.Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(table: pa.Table) -> pa.Table:
    """One block pair (i, j) of one bucket: for its sources a < b the sum over
    the bucket's terms of their gap beyond that of two absent terms. The rows
    `term is null` carry what a source has where a term is absent."""
    term = table.column("term").combine_chunks()
    absent = term.is_null().to_numpy(zero_copy_only=False)
    idx, p, side = (table.column(c).to_numpy() for c in ("idx", "p", "side"))
    names, zero = idx[absent], p[absent]
    order = np.lexsort((names, side[absent]))
    names, zero, side0 = names[order], zero[order], side[absent][order]
    at = np.searchsorted(names, idx)          # blocks follow each other, so names ascend
    code = term.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")[absent.sum():]
    code, at, p = code[order], at[order], p[order]
    n = int(code[-1]) + 1 if len(code) else 0
    same = not (side0 == 1).any()
    left = np.arange(len(names)) if same else np.flatnonzero(side0 == 0)
    right = left if same else np.flatnonzero(side0 == 1)
    base = _gaps(zero[left][:, None], zero[right][None, :])
    total = np.zeros(base.shape, np.int64)
    for x in range(0, n, TERMS):
        lo, hi = np.searchsorted(code, [x, x + TERMS])
        m = np.repeat(zero[:, None], min(TERMS, n - x), axis=1)
        m[at[lo:hi], code[lo:hi] - x] = p[lo:hi]
        for k, a in enumerate(left):
            first = k + 1 if same else 0
            total[k, first:] += (_gaps(m[a], m[right[first:]]) - base[k, first:, None]).sum(axis=1)
    k, r = np.triu_indices(len(left), 1) if same else np.indices(base.shape).reshape(2, -1)
    return pa.table({"lang": table.column("lang").take(pa.array(np.zeros(len(k), np.int64))), "a": names[left[k]], "b": names[right[r]], "more": total[k, r]})


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source).

    Part `pair` has every other source of the language by divergence, part `term`
    the `top` terms that the source uses more than its language does. Null text,
    lang and source count as ''; repeated rows are documents of their own; equal
    values rank by the item's UTF-8 bytes; a language without kept terms has
    pairs of value 0 and no terms; an empty table gives no rows. Extra columns
    are ignored.
    """
    spark = docs.sparkSession
    texts = spread(docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]))
    used = land(_occurrences(texts, min_docs).withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang", "term"))), "kept-terms")

    # one row a language, one a (lang, source)
    langs = used.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.sum("n").alias("t_lang"), F.count(F.lit(1)).alias("rows"))
    groups = texts.select("lang", "source").distinct() \
        .join(used.groupBy("lang", "source").agg(F.sum("n").alias("t")), ["lang", "source"], "left") \
        .join(langs, "lang", "left").fillna(0, ["t", "t_lang", "v", "rows"])
    order = Window.partitionBy("lang").orderBy("source")
    groups = groups.withColumn("idx", F.row_number().over(order).cast("long") - 1) \
        .withColumn("p0", F.when(F.col("v") > 0, _share("0L", "t", "v"))) \
        .withColumn("blocks", F.expr(f"(max(idx) over (partition by lang)) div {block} + 1")) \
        .withColumn("buckets", F.expr(f"cast(rows div {bucket} + 1 as int)")).withColumn("meets", F.expr(_meets(block)))
    groups = land(groups, "source-groups")

    rated = lookup_join(used, groups, ["lang", "source"], "inner") \
        .withColumn("p", _share("n", "t", "v")).withColumn("q", _share("n_lang", "t_lang", "v"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    words = rated.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value")) \
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    pairs = _pairs(rated, groups, block)
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    return ranked.unionByName(words)


def _meets(block: int) -> str:
    """A source of block k takes part in the block pairs (i, j), i <= j, one of
    which is k; side 1 is j's."""
    mine = f"idx div {block}"
    return f"transform(sequence(0L, blocks - 1), x -> struct(least(x, {mine}) as i, greatest(x, {mine}) as j, if(x < {mine}, 1, 0) as side))"


def _pairs(rated: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(lang, source, part, item, value) of all ordered pairs of sources."""
    cols = ["lang", "idx", "term", "p", "bucket", "m.i", "m.j", "m.side"]
    some = groups.filter("v > 0").withColumn("m", F.explode("meets"))
    present = rated.withColumn("bucket", F.expr("pmod(xxhash64(term), buckets)")).withColumn("m", F.explode("meets")).select(*cols)
    absent = some.withColumn("bucket", F.explode(F.expr("sequence(0L, buckets - 1L)"))).select("lang", "idx", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), *cols[4:])
    sums = present.unionByName(absent).groupBy("lang", "i", "j", "bucket").applyInArrow(_pair_sums, "lang string, a long, b long, more long") \
        .groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    one = groups.select("lang", F.col("idx").alias("a"), F.col("source").alias("sa"), F.col("p0").alias("pa"), "v")
    two = groups.select("lang", F.col("idx").alias("b"), F.col("source").alias("sb"), F.col("p0").alias("pb"))
    # the rows of the report: every pair of sources is asked for
    both = one.join(two, "lang").filter("a < b").join(sums, ["lang", "a", "b"], "left")
    both = both.select("lang", "sa", "sb", F.expr("if(v = 0, 0L, v * (((pa - pb) * (pa - pb)) div (pa + pb)) + coalesce(more, 0L))").alias("value"))
    return both.select("lang", F.explode(F.array(F.struct(F.col("sa").alias("source"), F.col("sb").alias("item")), F.struct(F.col("sb").alias("source"), F.col("sa").alias("item")))).alias("s"), "value") \
        .select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
occ AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
cnt AS (SELECT o.lang, o.source, o.term, count(*)::HUGEINT AS n FROM occ o SEMI JOIN kept k ON o.lang = k.lang AND o.term = k.term GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
vocab AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
tot AS (SELECT lang, source, sum(n) AS t FROM cnt GROUP BY ALL),
tot_lang AS (SELECT lang, sum(n) AS t FROM cnt GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(t.t, 0) + 2 * v.v) AS p
      FROM grp g JOIN kept k ON g.lang = k.lang JOIN vocab v ON v.lang = g.lang
      LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source),
q AS (SELECT c.lang, c.term, 1 + (1000000000 * (sum(c.n) + 2)) // (any_value(t.t) + 2 * any_value(v.v)) AS q
      FROM cnt c JOIN tot_lang t ON t.lang = c.lang JOIN vocab v ON v.lang = c.lang GROUP BY c.lang, c.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(x.value, 0) AS value
          FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pair x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source),
words AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS value
          FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
every AS (SELECT * FROM pairs UNION ALL SELECT * FROM words),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
