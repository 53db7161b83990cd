"""Language ID by Bayesian evidence fusion.

Each row brings up to four kinds of evidence: its text, a declared markup
language, the address suffix and its host. For each language l

    log p(l | row) = T * log p(text | l) + log p(declared | l)
                     + log p(suffix | l) + log p(l | host) + const

Text likelihoods are hashed byte trigrams (tempered by T, since neighbouring
trigrams repeat each other). All other tables are grouped aggregates over all
rows of the text posterior: p(declared | l) and p(suffix | l) are shrunk
towards their overall shares; p(l | host) is shrunk towards its site (last two
labels) and that towards the whole corpus, with the row's own part taken out.
Missing evidence says nothing. An extra class `und` explains bytes evenly, so
texts of no known language, or without letters, are rejected.

The trigram tables are fitted on at most TRAIN_ROWS labelled rows a language,
so that a rare language has its table however large the corpus is. A label is a
language if it has a code's form (two or three letters) and MIN_SUPPORT labelled
rows, so that the model stays small on labels with slips.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import byte_rows, land, lean, pick_rows, row_key, spread, table

TRAIN_ROWS = 8_000       # of each language
MIN_SUPPORT = 5          # labelled rows that make a label a language
SLOTS = 1 << 16
TEMPER = 0.2
SHRINK = 20.0            # rows that a parent level weighs
UND = "und"
UND_PRIOR = 1e-3
ACCEPT = 0.5             # least posterior of an accepted language
_SPACES = (0x202020 * 0x9E3779B1 & 0xFFFFFFFF) >> 16

_BYTE = np.arange(256, dtype=np.uint8)
_BYTE[:128] = [c | 32 if chr(c).isalpha() else 32 for c in range(128)]


def trigram_slots(buf: bytes) -> np.ndarray:
    """Slot of the three bytes from each position; letters in lower case, other
    ASCII as spaces."""
    b = _BYTE[np.frombuffer(buf, np.uint8)].astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint16)
    three = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((three * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _pad(body: bytes) -> bytes:
    return b" " + body + b" "


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for b, bodies in byte_rows(batches, "body"):
        for body, lang in zip(bodies, b.column("lang").to_pylist()):
            c = np.bincount(trigram_slots(_pad(body)), minlength=SLOTS)
            total[lang] = total[lang] + c if lang in total else c
    for lang, c in total.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], ["lang", "slot", "n"])


class TextModel:
    """log p(trigram | language), one column a language, `und` last."""

    def __init__(self, langs: list[str], table_: np.ndarray):
        self.langs, self.table = langs, table_

    def scores(self, bodies: list[bytes]) -> np.ndarray:
        """Summed log likelihood of each text (rows) in each language."""
        out = np.zeros((len(bodies), len(self.langs)))
        padded = [_pad(x) for x in bodies]
        step = max(1 << 14, (1 << 22) // max(1, len(self.langs)))   # bounded for long texts
        slots = [trigram_slots(x) for x in padded]
        i = 0
        while i < len(slots):
            j, size = i, 0
            while j < len(slots) and (j == i or size + len(slots[j]) <= step):
                size += len(slots[j])
                j += 1
            if j - i == 1:
                for x in range(0, len(slots[i]), step):
                    out[i] += self.table[slots[i][x:x + step]].sum(axis=0, dtype=np.float64)
            else:
                sizes = np.array([len(s) for s in slots[i:j]])
                full = np.flatnonzero(sizes)
                if len(full):
                    ll = self.table[np.concatenate(slots[i:j])]
                    out[i + full] = np.add.reduceat(ll, (np.cumsum(sizes) - sizes)[full], axis=0, dtype=np.float64)
            i = j
        return out


def _sample(rows: DataFrame, n: int) -> DataFrame:
    """(id, lang) of at most `n` ids a language, those with the smallest hash."""
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().filter(F.col("count") >= MIN_SUPPORT).collect()}
    own = rows.filter(F.col("lang").isin(list(counts))).select("id", "lang", F.xxhash64("id").alias("h"))
    # twice as many as needed by hash alone, so that little is ranked
    large = {lang: int(-2.0**63 + 2.0**64 * 2 * n / c) for lang, c in counts.items() if c > 4 * n + 1000}
    if large:
        upto = F.create_map(*[F.lit(x) for item in large.items() for x in item])
        own = own.filter(F.col("h") <= F.coalesce(upto[F.col("lang")], F.lit(2**63 - 1)))
    order = Window.partitionBy("lang").orderBy("h", "id")
    return own.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("id", "lang", F.lit(True).alias("chosen"))


def fit_text_model(docs: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Trigram tables from a bounded sample of each language's labelled rows. Languages are the
    primary subtags of the labels, of two or three letters and with MIN_SUPPORT rows; rows
    without id, label or text take no part."""
    code = F.lower(F.regexp_extract(F.col(f"`{lang_col}`"), r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), code.alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("body")) \
        .filter(f"id is not null and lang != '' and lang != '{UND}' and body is not null")
    some = land(_sample(rows, train_rows), "chosen")
    got = lookup_join(rows, some, ["id", "lang"]).filter("chosen").select("lang", "body").mapInArrow(_counts, "lang string, slot int, n long") \
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()      # at most SLOTS rows a language
    langs = sorted(set(got["lang"]))
    out = np.full((SLOTS, len(langs) + 1), -np.log(SLOTS), np.float32)
    for i, lang in enumerate(langs):
        mine = got[got["lang"] == lang]
        c = np.full(SLOTS, 0.01)
        c[mine["slot"].to_numpy()] += mine["n"].to_numpy()
        out[:, i] = np.log(c / c.sum())
    out[_SPACES] = 0.0
    return TextModel([*langs, UND], out)


def _likelihoods(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b, bodies in byte_rows(batches, "body", 1 << 20):
            ll = TEMPER * m.scores(bodies)
            p = np.exp(ll + np.log([1 - UND_PRIOR] * (len(m.langs) - 1) + [UND_PRIOR]) - ll.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            letters = [any(x > 127 or 65 <= (x & 223) <= 90 for x in body[:4096]) or any(x > 127 or 65 <= (x & 223) <= 90 for x in body[4096:]) for body in bodies]
            keep = [i for i, n in enumerate(b.schema.names) if n != "body"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(letters), pa.array(list(ll), pa.list_(pa.float64())), pa.array(list(p), pa.list_(pa.float64()))],
                                             [*(b.schema.names[i] for i in keep), "letters", "ll", "p"])
    return lean(run)


def _sums(rows: DataFrame, key: list[str], name: str, n: int) -> DataFrame:
    """Per key: array of summed text posteriors, one partial sum a task."""
    return rows.filter(" and ".join(f"{k} is not null" for k in key)).groupBy(*key) \
        .agg(F.array(*[F.sum(F.col("p")[i]) for i in range(n)]).alias(name))


def _join_sums(rows: DataFrame, sums: DataFrame, key: str) -> DataFrame:
    """`rows` with the sums of their key. Where the sums outgrow a broadcast, rows
    without a key go to as many partitions as the others, not to one."""
    spread_out = F.concat(F.lit("none:"), F.pmod(F.xxhash64("ll"), F.lit(4096)).cast("string"))
    tagged = rows.withColumn("__key", F.coalesce(F.concat(F.lit("key:"), F.col(key)), spread_out))
    return lookup_join(tagged, sums.select(F.concat(F.lit("key:"), F.col(key)).alias("__key"), *[c for c in sums.columns if c != key]), "__key").drop("__key")


def fuse(evidence: DataFrame, model: TextModel) -> DataFrame:
    """Evidence rows (any columns plus body binary, declared, suffix, host, site)
    -> the other columns plus language, posterior, text_language, accepted."""
    spark = evidence.sparkSession
    n = len(model.langs)
    own = [c for c in evidence.columns if c != "body"]
    types = {f.name: f.dataType.simpleString() for f in evidence.schema}
    schema = ", ".join([f"`{c}` {types[c]}" for c in own] + ["letters boolean", "ll array<double>", "p array<double>"])
    held = spark.sparkContext.broadcast(model)
    rows = landed = land(spread(evidence).mapInArrow(_likelihoods(held), schema), "likelihoods")
    total = rows.agg(*[F.sum(F.col("p")[i]) for i in range(n)]).first()
    total = np.array([x or 0.0 for x in total])
    overall = F.array(*[F.lit(float(x)) for x in (total + 1) / (total.sum() + n)])
    langs_n = F.array(*[F.lit(float(x)) for x in total])
    shrink = F.lit(SHRINK)
    for key, name in (("declared", "d"), ("suffix", "s")):
        rows = _join_sums(rows, land(_sums(landed, [key], name, n), "sums"), key)
        share = F.aggregate(name, F.lit(0.0), lambda a, x: a + x) / float(max(total.sum(), 1e-9))
        # p(value | l), shrunk towards the value's overall share
        like = F.transform(name, lambda x, i: F.log((x + shrink * share + 1e-9) / (langs_n[i] + shrink)))
        rows = rows.withColumn(name, like)
    rows = _join_sums(rows, land(_sums(landed, ["site"], "w", n), "sums"), "site")
    rows = _join_sums(rows, land(_sums(landed, ["host"], "h", n), "sums"), "host")

    def level(name, parent):
        """Counts without the row itself, shrunk towards the level above."""
        less = F.transform(name, lambda x, i: F.greatest(x - F.col("p")[i], F.lit(0.0)))
        size = F.aggregate(less, F.lit(0.0), lambda a, x: a + x)
        return F.when(F.col(name).isNull(), parent).otherwise(F.transform(less, lambda x, i: (x + shrink * parent[i]) / (size + shrink)))

    rows = rows.withColumn("w", level("w", overall))
    rows = rows.withColumn("h", level("h", F.col("w")))
    zero = F.lit(0.0)
    score = F.transform("ll", lambda x, i: x + F.coalesce(F.col("d")[i], zero) + F.coalesce(F.col("s")[i], zero) + F.log(F.col("h")[i] + 1e-12))
    rows = rows.withColumn("score", score)
    best = F.array_max("score")
    names = F.array(*[F.lit(x) for x in model.langs])
    rows = rows.withColumn("best", F.array_position("score", best).cast("int")) \
        .withColumn("posterior", 1 / F.aggregate("score", zero, lambda a, x: a + F.exp(x - best)))
    lang = F.when(F.col("letters"), F.element_at(names, F.col("best"))).otherwise(F.lit(UND))
    text = F.when(F.col("letters"), F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))).otherwise(F.lit(UND))
    keep = [c for c in own if c not in ("declared", "suffix", "host", "site")]
    return rows.select(*keep, "declared", lang.alias("language"), F.round("posterior", 6).alias("posterior"), text.alias("text_language"),
                       ((lang != UND) & (F.col("posterior") >= ACCEPT)).alias("accepted"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents: text, and the source as host."""
    none = F.lit(None).cast("string")
    return docs.select(*row_key(), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"),
                       none.alias("declared"), none.alias("suffix"), F.col("source").cast("string").alias("host"), none.alias("site"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages: visible text, declared markup language, address suffix, host."""
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    null = lambda c: F.when(c != "", c)
    declared = null(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)))
    host = null(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)))
    return pages.select(F.col("page_id").cast("long").alias("id"), text.cast("binary").alias("body"), declared.alias("declared"), host.alias("host")) \
        .withColumn("suffix", null(F.regexp_extract("host", r"\.([a-z][a-z0-9-]*)\.?$", 1))) \
        .withColumn("site", null(F.regexp_extract("host", r"([^.]+\.[^.]+)\.?$", 1)))


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, th, declared, language, posterior, text_language, accepted) of every
    document, th being its text's hash. Null and empty texts, and texts without
    letters, are `und` and rejected. Rows that repeat share one answer; null
    sources bring no host evidence. Extra columns are ignored."""
    return fuse(document_evidence(docs), fit_text_model(docs, train_rows))


def keep_identified(docs: DataFrame) -> DataFrame:
    """`docs` without the documents that language ID rejects."""
    return pick_rows(docs, land(identify(docs).filter("not accepted").select("id", "th"), "rejected"), "left_anti")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents (doc_id) and all web pages (page_id) in one fusion, so that
    every kind of evidence is in use."""
    docs = table(spark, sf_dir, "documents")
    none = F.lit(None).cast("long")
    rows = document_evidence(docs).select(F.col("id").alias("doc_id"), none.alias("page_id"), "body", "declared", "suffix", "host", "site") \
        .unionByName(page_evidence(table(spark, sf_dir, "pages")).select(none.alias("doc_id"), F.col("id").alias("page_id"), "body", "declared", "suffix", "host", "site"))
    return fuse(rows, fit_text_model(docs))
