"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share the words of the corpus by weight, none above `cap` times its
own size (the excess is reshared). A source's target is met by complete epochs
first; the rest is a weighted sample without replacement: each document draws
an exponential key divided by its quality weight, documents are taken in key
order, and the prefix sum of their words stops at the rest of the target.

The prefix sum never sorts a source in one task: keys fall into about the root
of a source's documents buckets, buckets are summed (partial aggregates) and
accumulated, and only the bucket in which the budget ends is sorted row by row.
Buckets are cut where equal shares of the source's documents are expected, given
how many of them have which quality, so a source of poor documents has no larger
buckets than a source of good ones.
Only narrow rows move; everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import keyed_rows, land, parts, spread, table

WORD = r"[^\x20\x09-\x0D]+"
SIGNS = r"[$%&#*|@0-9]+"     # runs that lower a document's quality weight
CAP = 3
SEED = "mix-1"
LEAST_WEIGHT = 0.05
LEVELS = 20              # steps of quality that are counted per source


def _sources(rows: DataFrame, cap: int) -> DataFrame:
    """(no_source, source, source_size, docs, weight, target) of every source."""
    spark = rows.sparkSession
    order = ["no_source", "source"]          # UTF-8 order is code point order; null last
    sums = rows.groupBy(*order).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranged = sums.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    got = land(ranged.withColumn("at", F.monotonically_increasing_id()), "sources")
    # global rank: rows of the partitions before (one number a partition) + position
    part = F.shiftright("at", 33).cast("int")
    before, offsets = 0, {}
    for r in sorted(got.groupBy(part.alias("p")).count().collect()):
        offsets[r["p"]], before = before, before + r["count"]
    base = F.lit(0)
    if offsets:
        base = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), part)
    rank = base + F.col("at").bitwiseAND((1 << 33) - 1)
    got = got.select(*order, "source_size", "docs", (F.lit(1) + rank % 3).cast("double").alias("weight"))
    # share * weight, stopped at cap * size: raise the share until no more sources stop
    total = got.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        stops = F.col("weight") * share > cap * F.col("source_size")
        held, open_ = got.agg(F.sum(F.when(stops, cap * F.col("source_size")).otherwise(0)), F.sum(F.when(stops, 0.0).otherwise(F.col("weight")))).first()
        if not open_:
            break
        new = (total - held) / open_
        if new <= share:
            break
        share = new
    return got.withColumn("target", F.least(F.col("weight") * F.lit(float(share)), (cap * F.col("source_size")).cast("double")))


def _level_counts(rows: DataFrame) -> DataFrame:
    """(no_source, source, levels): per source at most LEVELS + 1 structs of a mean
    quality and the documents that have about that."""
    each = rows.groupBy("no_source", "source", F.ceil(F.col("quality") * LEVELS).alias("level")).agg(F.avg("quality").alias("q"), F.count(F.lit(1)).alias("n"))
    return each.groupBy("no_source", "source").agg(F.sort_array(F.collect_list(F.struct("level", "q", "n"))).alias("levels"))


def _bucket():
    """Bucket of a key: the share of the source's documents expected before it
    (a key of quality q is before x with 1 - exp(-qx)), which rises with the key."""
    before = F.aggregate("levels", F.lit(0.0), lambda a, v: a + v["n"] * (1 - F.exp(-F.col("key") * v["q"])))
    return F.floor(F.col("buckets") * (before / F.col("docs"))).cast("long")


def mix(docs: DataFrame, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """(k, doc_id, size, source_size, target, taken) of every row.

    Size counts words (null text: 0). `taken` is the words the mix takes:
    `size` times the epochs, once more if the document is in the fractional
    part; the document on which the budget ends is taken if at least half of it
    fits. Documents without words are never taken. Null sources form one
    source, last in order. Rows without an id draw their key by their text. Rows that repeat an id are documents of their own;
    reruns agree. An empty table gives an empty mix.
    """
    rows = keyed_rows(docs, "doc_id", "text")
    return mix_keyed(rows, cap, seed)


def mix_keyed(rows: DataFrame, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """:func:`mix` of rows that carry their key as `__k`."""
    src, text = F.col("source").cast("string"), F.col("text")
    no_id = F.concat(F.lit("none:"), F.coalesce(F.md5("text"), F.lit("")))
    hexa = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("long").cast("string"), no_id))), 1, 13)
    narrow = land(spread(rows.select(
        F.col("__k").alias("k"), F.col("doc_id").cast("long").alias("doc_id"), src.isNull().alias("no_source"), F.coalesce(src, F.lit("")).alias("source"), "text", hexa.alias("hexa")))
        .select("k", "doc_id", "no_source", "source", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                F.coalesce(F.regexp_count(text, F.lit(SIGNS)), F.lit(0)).alias("signs"), ((F.conv("hexa", 16, 10).cast("double") + 0.5) / float(1 << 52)).alias("u")), "mix-rows")
    quality = F.greatest(F.lit(LEAST_WEIGHT), 1 - F.col("signs") / F.greatest("size", F.lit(1)))
    narrow = narrow.withColumn("quality", quality)
    sources = land(lookup_join(_sources(narrow, cap), _level_counts(narrow), ["no_source", "source"]), "targets")
    plan = sources.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")) \
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")) \
        .withColumn("buckets", F.ceil(F.sqrt("docs")).cast("long"))
    keyed = lookup_join(narrow, plan.drop("weight"), ["no_source", "source"]) \
        .withColumn("key", -F.log("u") / F.col("quality")) \
        .withColumn("bucket", _bucket()).drop("levels", "quality")
    sums = keyed.groupBy("no_source", "source", "bucket").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    before = Window.partitionBy("no_source", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cuts = sums.withColumn("done", F.coalesce(F.sum("words").over(before), F.lit(0))).filter("done <= budget and done + words > budget") \
        .select("no_source", "source", F.col("bucket").alias("cut"), (F.col("budget") - F.col("done")).alias("room"))
    keyed = lookup_join(keyed, land(cuts, "cuts"), ["no_source", "source"])
    # no cut: the whole source fits into the budget, which only an empty one does
    inside = Window.partitionBy("no_source", "source").orderBy("key", "doc_id", "k").rowsBetween(Window.unboundedPreceding, -1)
    last = keyed.filter("bucket = cut").withColumn("sum", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .withColumn("once", (F.col("sum") + F.col("size") / 2 <= F.col("room")).cast("long"))
    rest = keyed.filter("cut is null or bucket != cut").withColumn("once", F.coalesce((F.col("bucket") < F.col("cut")).cast("long"), F.lit(0).cast("long")))
    cols = ["k", "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("once"))).alias("taken")]
    return rest.select(*cols).unionByName(last.select(*cols))


def apply_mix(docs: DataFrame, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """`docs` as the mix takes them: each document as often as it is taken, one
    row a time; columns unchanged."""
    rows = keyed_rows(docs, "doc_id", "text")
    taken = mix_keyed(rows, cap, seed).filter("taken > 0").select(F.col("k").alias("__mk"), (F.col("taken") / F.col("size")).cast("int").alias("__times"))
    out = rows.join(taken, F.col("__k") == F.col("__mk")).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         coalesce(len(regexp_extract_all(text, '[$%&#*|@0-9]+')), 0) AS signs,
         (CAST(('0x' || substr(md5('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY {CAP} * source_size / weight, source NULLS LAST) AS j FROM w),
p AS (SELECT j, (SELECT sum(source_size) FROM s) - coalesce(sum({CAP} * source_size) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_words,
             sum(weight) OVER (ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight, {CAP} * source_size / weight AS ratio FROM r),
l AS (SELECT open_words / open_weight AS share FROM p WHERE open_words / open_weight <= ratio ORDER BY j LIMIT 1),
t AS (SELECT source, source_size, least(weight * share, ({CAP} * source_size)::DOUBLE) AS target FROM w, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
x AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / greatest({LEAST_WEIGHT}, 1 - signs / greatest(size, 1)), doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (epochs + CASE WHEN before <= budget AND before + size / 2 <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""
