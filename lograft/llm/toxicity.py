"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, drops marks and zero-width characters, maps homoglyphs
(Cyrillic, Greek, full width) and digit or sign substitutions to one letter
each, and turns everything else into spaces. Look-alikes of l (i, 1, !, |)
share one class.

The lexicon is learned from labelled rows: word beginnings, and whole words of
under MIN_LEN letters, whose documents are
toxic far more often than not, weighted by their log odds. Exception phrases
are learned too: a longer word or a word pair that holds an entry but is not
itself evidence cancels it. The score of a text is its summed weight divided by
the root of its length in words, scaled so that the cut that separates the
labelled rows best is 0.5.

Labels are learned from at most TRAIN_ROWS labelled rows (smallest hash of the
id first) outside the held-out fold, up to half of them for the rarer label; near copies among them (equal sketch)
count once, so words of a much-copied text are not mistaken for evidence.
Scoring is map-only: one pass over whole texts.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, land, spread, table

TRAIN_ROWS = 20_000
MIN_DOCS = 8          # toxic documents that must hold an entry: a quarter of them, 2 to MIN_DOCS
MIN_WEIGHT = 2.5      # log odds of an entry
MIN_LEN, MAX_LEN = 4, 16
MAX_ENTRIES = 5_000
MIN_CLEAN = 3         # clean documents that make an exception phrase
FOLDS = 5

# Look-alike letters, in code point order of the letter they stand for.
HOMOGLYPHS = {"а": "a", "α": "a", "в": "b", "β": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ε": "e", "ё": "e", "ɡ": "g", "һ": "h", "н": "h",
              "і": "i", "ι": "i", "ı": "i", "ӏ": "i", "ј": "j", "к": "k", "κ": "k", "м": "m", "п": "n", "η": "n", "о": "o", "ο": "o", "σ": "o",
              "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "τ": "t", "υ": "u", "ν": "v", "ѵ": "v", "ԝ": "w", "ω": "w", "х": "x", "χ": "x",
              "у": "y", "γ": "y", "ʏ": "y", "ζ": "z"}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"}


def _fold_table() -> dict[int, str | None]:
    """Built by rule over the planes that hold Latin, Greek, Cyrillic, general
    punctuation and full-width forms; other characters stay."""
    out: dict[int, str | None] = {}
    for cp in [*range(0x530), *range(0x1D00, 0x3040), *range(0xFE00, 0xFE10), *range(0xFEFF, 0xFFF0)]:
        ch = chr(cp)
        low = unicodedata.normalize("NFKD", ch).lower()
        base = "".join(x for x in unicodedata.normalize("NFKD", low) if not unicodedata.combining(x))
        kind = unicodedata.category(ch)
        if kind == "Cf" or kind.startswith("M"):
            out[cp] = None
            continue
        got = "".join(SUBSTITUTES.get(h := HOMOGLYPHS.get(x, x), h) for x in base)
        out[cp] = got if got and all(x.isalnum() for x in got) else " "
    return out


_FOLD = _fold_table()


def fold(text: str) -> str:
    """Folded text with a space before every word."""
    return " " + text.translate(_FOLD)


def _sketch(text: str) -> int:
    """Smallest hash of the text's runs of five words: near copies mostly share it."""
    w = text.split()
    return min((xxhash.xxh3_64_intdigest(" ".join(w[i:i + 5])) for i in range(max(1, len(w) - 4))), default=0) >> 1


def support(n_pos: int) -> int:
    """Toxic documents that must hold an entry, of `n_pos` learned from."""
    return max(2, min(MIN_DOCS, -(-n_pos // 4)))


def _heads(word: str) -> list[str]:
    """Beginnings of a word; a short word is whole, with the space behind it."""
    return [word[:n] for n in range(MIN_LEN, min(len(word), MAX_LEN) + 1)] if len(word) >= MIN_LEN else [word + " "]


def _vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per beginning of their words, by label, counted per slice."""
    for b, bodies in byte_rows(batches, "body", 16 << 20):
        hits: tuple[Counter, Counter] = (Counter(), Counter())
        for body, toxic in zip(bodies, b.column("toxic").to_pylist()):
            heads = {h for w in set(fold(body.decode()).split()) for h in _heads(w)}
            hits[toxic].update(heads)
        heads = list(hits[0].keys() | hits[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array([hits[1][h] for h in heads], pa.int64()), pa.array([hits[0][h] for h in heads], pa.int64())], ["head", "pos", "neg"])


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, bodies in byte_rows(batches, "body"):
        sk = [_sketch(fold(x.decode())) for x in bodies]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("toxic"), pa.array(sk, pa.int64()), b.column("body")], ["id", "toxic", "sketch", "body"])


class Lexicon:
    """Entries (word beginnings with weights), exception phrases and the scale."""

    def __init__(self, entries: dict[str, float], exceptions: list[str], scale: float = 1.0):
        self.entries, self.exceptions, self.scale = entries, exceptions, scale
        self._auto = None

    def __getstate__(self):
        return self.entries, self.exceptions, self.scale

    def __setstate__(self, state):
        self.__init__(*state)

    def automaton(self):
        if self._auto is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for e, w in self.entries.items():
                a.add_word(" " + e, (len(e) + 1, w))
            for e in self.exceptions:
                a.add_word(f" {e} ", (len(e) + 2, None))
            a.make_automaton()
            self._auto = a
        return self._auto

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of entries no exception phrase covers."""
        if not self.entries:
            return []
        found, excused = [], []
        for end, (n, w) in self.automaton().iter(folded):
            (excused if w is None else found).append((end - n + 1, end + 1, w))
        if excused:
            found = [f for f in found if not any(s <= f[0] and f[1] <= e for s, e, _ in excused)]
        return found

    def density(self, text: str) -> float:
        folded = fold(text) + " "
        found = self.hits(folded)
        return sum(w for _, _, w in found) / sqrt(1 + len(folded.split())) if found else 0.0

    def score(self, text: str) -> float:
        d = self.density(text)
        return d / (d + self.scale) if d else 0.0


def choose_entries(rows: list[tuple[str, int, int]], n_pos: int, n_neg: int) -> dict[str, float]:
    """From (head, toxic, clean documents): heads with enough weight; of nested
    heads the shortest, lengthened while one longer head holds nearly as many."""
    good = {h: (p, log((p + 0.5) / (n_pos + 1)) - log((n + 0.5) / (n_neg + 1))) for h, p, n in rows}
    good = {h: x for h, x in good.items() if x[0] >= support(n_pos) and x[1] >= MIN_WEIGHT}
    best: dict[str, str] = {}      # longer heads by their parent
    for h in good:
        if len(h) > MIN_LEN and (h[:-1] not in best or good[h][0] > good[best[h[:-1]]][0]):
            best[h[:-1]] = h
    out: dict[str, float] = {}
    for h in sorted(good, key=lambda x: (len(x), x)):
        if any(h[:n] in out or h[:n] in good for n in range(MIN_LEN, len(h))):
            continue
        while h in best and good[best[h]][0] >= 0.95 * good[h][0]:
            h = best[h]
        out[h] = good[h][1]
    return out


def _phrases(lex):
    """Longer words and word pairs around hits, by label."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, bodies in byte_rows(batches, "body", 16 << 20):
            hits: tuple[Counter, Counter] = (Counter(), Counter())
            for body, toxic in zip(bodies, b.column("toxic").to_pylist()):
                f = fold(body.decode()) + " "
                mine = set()
                for s, _, _ in lex.value.hits(f):
                    w, *rest = f[s:s + 200].split(None, 2)
                    before = f[max(0, s - 100):s].split()
                    mine |= {w, *([f"{w} {rest[0]}"] if rest else []), *([f"{before[-1]} {w}"] if before else [])}
                hits[toxic].update(mine - lex.value.entries.keys())
            names = list(hits[0].keys() | hits[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([hits[1][h] for h in names], pa.int64()), pa.array([hits[0][h] for h in names], pa.int64())], ["phrase", "pos", "neg"])
    return run


def _densities(lex):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, bodies in byte_rows(batches, "body"):
            yield pa.RecordBatch.from_arrays([pa.array([lex.value.density(x.decode()) for x in bodies], pa.float64()), b.column("toxic")], ["d", "toxic"])
    return run


def best_cut(d: np.ndarray, toxic: np.ndarray, weights: tuple[float, float] = (1.0, 1.0)) -> float:
    """The cut with the best F1, a clean and a toxic row standing for as many as
    `weights` says; halfway between neighbouring values (on a
    ratio scale), the lowest on ties."""
    v = np.unique(d)
    if not toxic.any() or v[-1] <= 0:
        return 1.0
    cuts = np.r_[v[1] / 2 if len(v) > 1 and v[0] == 0 else v[0] / 2, np.sqrt(v[:-1] * v[1:])[v[:-1] > 0]]
    o = np.sort(d[toxic == 1])
    c = np.sort(d[toxic == 0])
    tp, fp = len(o) - np.searchsorted(o, cuts), len(c) - np.searchsorted(c, cuts)
    tp, fp, pos = tp * weights[1], fp * weights[0], len(o) * weights[1]
    return float(cuts[np.argmax(2 * tp / np.maximum(1, tp + fp + pos))])


def held_out(col) -> F.Column:
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def shares(clean: int, toxic: int, n: int) -> tuple[int, int]:
    """How many clean and toxic of the labelled rows make a sample of `n`: half
    each, and what one label does not fill goes to the other."""
    t = min(toxic, max(n // 2, n - clean))
    return min(clean, n - t), t


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Lexicon:
    """Learn a lexicon; the driver only gets entries and a bounded sample's
    scores. No usable label gives an empty lexicon (all scores 0)."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter("id is not null and toxic in (0, 1)").filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = land(known, "known")
    have = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    take = shares(have.get(0, 0), have.get(1, 0), train_rows)
    some = known.filter("toxic = 0").orderBy(F.xxhash64("id"), "id").limit(take[0]) \
        .unionByName(known.filter("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(take[1]))     # bounds what is broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("body")).filter("body is not null")
    train = texts.join(F.broadcast(some), "id").select("id", "toxic", "body") \
        .mapInArrow(_sketches, "id long, toxic int, sketch long, body binary")
    train = land(train, "labelled")
    one = train.groupBy("sketch", "toxic").agg(F.min("id").alias("id"))
    train = train.join(F.broadcast(one.select("id").distinct()), "id", "left_semi")   # at most train_rows ids
    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    weight = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    heads = train.mapInArrow(_vocabulary, "head string, pos long, neg long").groupBy("head").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")) \
        .filter((F.col("pos") >= support(n_pos)) & (weight >= MIN_WEIGHT)).orderBy(F.desc("pos"), "head").limit(20 * MAX_ENTRIES)
    entries = choose_entries([tuple(r) for r in heads.collect()], n_pos, n_neg)
    entries = dict(sorted(entries.items(), key=lambda x: -x[1])[:MAX_ENTRIES])
    lex = spark.sparkContext.broadcast(Lexicon(entries, []))
    phrases = train.mapInArrow(_phrases(lex), "phrase string, pos long, neg long").groupBy("phrase").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")) \
        .filter((F.col("neg") >= MIN_CLEAN) & (weight <= 0)).orderBy(F.desc("neg"), "phrase").limit(MAX_ENTRIES)
    lex = Lexicon(entries, [r["phrase"] for r in phrases.collect()])
    held = spark.sparkContext.broadcast(lex)
    d = train.select("body", "toxic").mapInArrow(_densities(held), "d double, toxic int").toPandas()   # at most train_rows
    lex.scale = best_cut(d["d"].to_numpy(), d["toxic"].to_numpy(), tuple(have.get(i, 0) / max(1, take[i]) for i in (0, 1))) if len(d) else 1.0
    return lex


def _score(lex):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, bodies in byte_rows(batches, "body"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([lex.value.score(x.decode()) for x in bodies], pa.float64())], ["doc_id", "score"])
    return run


def score_texts(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts score 0."""
    lex = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("body"))
    return spread(rows).mapInArrow(_score(lex), "doc_id long, score double")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lex = learn(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, lex).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
