"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is escaped as the model's normaliser does (identity rule: a mark before
the text and in place of each space), then cut before every mark, since no
piece holds a mark after another character. Words are also cut at
other places no piece spans (line ends, a letter before a closing sign). The
distinct segments of a slice of documents are sorted, which is the depth-first order of their trie:
walking it, each word keeps the forward states of the prefix it shares with
the word before and extends only the rest.

The forward state of a prefix is its best last piece and score. In a unigram
model any piece may follow any other and scores add up. In a BPE model a
transition is allowed only where encoding the two pieces' joined text gives
just these two pieces; then every prefix has exactly one allowed state, and
the path is what the merges give, id for id (tests compare with the library).

The operator is map-only: no shuffle, no skew; words that repeat are remembered
within a task up to a fixed number.
"""

from __future__ import annotations

import heapq
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, byte_rows, lean, spread, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
REMEMBER = 40 << 20    # bytes of words that a task remembers; segments without a mark: a quarter
PAIRS = 300_000        # pairs of pieces that a task remembers
SLICE = 2 << 20        # bytes of text encoded together
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, USER, BYTE, UNIGRAM, BPE = 1, 2, 4, 6, 1, 2   # fixed values of the model file format

_models: dict[str, Model] = {}


def _int32(ids: list[int]) -> bytes:
    return array("i", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<i4").tobytes()


class Model:
    """Pieces of a model file with the tables the passes need."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        norm = m.normalizer_spec
        if norm.name != "identity" or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only models with the identity normaliser and a leading mark are supported")
        if m.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.bpe = m.trainer_spec.model_type == BPE
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (NORMAL, USER)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with inner marks are not supported")
        self.scores = [p.score for p in m.pieces]
        self.pieces = [p.piece for p in m.pieces]
        self.longest = max(map(len, self.ids))
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.unk = next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN)
        self.unk_score = min(self.scores[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.raw = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode() if p.type in (NORMAL, USER) else b"" for p in m.pieces]
        self.raw[self.unk] = m.trainer_spec.unk_surface.encode()
        # merge order, and for each reachable piece the two it was merged from
        order = sorted(self.ids, key=lambda p: -self.scores[self.ids[p]])
        self.rank = {p: i for i, p in enumerate(order) if len(p) > 1}
        self.halves: dict[str, tuple[str, str]] = {}
        self.whole = {p: i for p, i in self.ids.items() if len(p) == 1 or not self.bpe or self.merge(p) == [p]}
        self.reach: dict[str, int] = {}
        for p in self.whole:
            if len(p) > 2:
                self.reach[p[-3:]] = max(self.reach.get(p[-3:], 2), len(p))
        self.pairs: dict[int, bool] = {}
        self.words, self.bare = Remembered(REMEMBER), Remembered(REMEMBER // 4)
        inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.tails = frozenset(c for c in ".,;:!?" if not any(q[1] == c and q[0].isalpha() for q in inside))
        self.lines = not any("\n" in p for p in self.ids)

    def merge(self, text: str) -> list[str]:
        """BPE by its definition: join the best-scored adjacent pair, leftmost
        on ties, until none is a piece. Used on short strings only (pairs of
        pieces, runs of marks)."""
        part = list(text)
        before, after = list(range(-1, len(part) - 1)), [*range(1, len(part)), -1]
        todo: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (p := part[i] + part[j]) in self.ids:
                heapq.heappush(todo, (-self.scores[self.ids[p]], i, p))

        for i in range(len(part) - 1):
            offer(i)
        while todo:
            _, i, p = heapq.heappop(todo)
            j = after[i]
            if not part[i] or j < 0 or part[i] + part[j] != p:
                continue
            if p == text:
                self.halves[p] = (part[i], part[j])
            part[i], part[j] = p, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p]

    def stable(self, a: str, b: str) -> bool:
        """Does encoding a + b give just these two pieces? Undo the merges that
        formed them at the border, latest first: the pieces then facing each
        other must not have merged before that moment. On equal rank the merge
        further left comes first."""
        rank, halves, limit = self.rank, self.halves, 1 << 60
        while True:
            r = rank.get(a + b)
            if r is not None and r < limit:
                return False
            ra, rb = rank.get(a, -1) if len(a) > 1 else -1, rank.get(b, -1) if len(b) > 1 else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, halves[a][1]
            else:
                limit, b = rb + 1, halves[b][0]

    def segment(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word (sorted), as little-endian int32. An unknown character
        is its bytes' pieces, or the unknown piece."""
        last = ""
        start: list[int] = [0]       # forward state of every prefix of the last word:
        state: list = [-1]           # where its last piece starts, and that piece (BPE) or its score
        step = self._extend_bpe if self.bpe else self._extend_unigram
        if not self.bpe:
            state[0] = 0.0
        for w in words:
            n, keep = len(w), 0
            top = min(n, len(last))
            while keep < top and w[keep] == last[keep]:
                keep += 1
            del start[keep + 1:], state[keep + 1:]
            step(w, keep, start, state)
            last, out, i = w, [], n
            while i:
                j = start[i]
                piece = state[i] if self.bpe else self.whole.get(w[j:i], -1)
                if piece >= 0:
                    out.append(piece)
                else:
                    out += self._unknown(w[j:i])[::-1]
                i = j
            out.reverse()
            yield _int32(out)

    def _unknown(self, char: str) -> list[int]:
        return [self.bytes[x] for x in char.encode()] if self.bytes else [self.unk]

    def _extend_bpe(self, w: str, keep: int, start: list[int], state: list[int]) -> None:
        """The one allowed last piece of each further prefix; the longest fits
        most often. Pieces are tried only up to the length any piece with the
        same last three characters has."""
        whole, reach, pairs = self.whole, self.reach, self.pairs
        if len(pairs) > PAIRS:
            pairs.clear()
        for i in range(keep + 1, len(w) + 1):
            for j in range(max(0, i - (reach.get(w[i - 3:i], 2) if i > 2 else 2)), i):
                piece = whole.get(w[j:i])
                if piece is None:
                    continue
                before = state[j]
                if before >= 0:      # neither the word's start nor an unknown character
                    key = before << 20 | piece
                    ok = pairs.get(key)
                    if ok is None:
                        ok = pairs[key] = self.stable(w[start[j]:j], w[j:i])
                    if not ok:
                        continue
                start.append(j)
                state.append(piece)
                break
            else:
                start.append(i - 1)
                state.append(-1)

    def _extend_unigram(self, w: str, keep: int, start: list[int], state: list[float]) -> None:
        for i in range(keep + 1, len(w) + 1):
            best, at = state[i - 1] + self.unk_score, i - 1
            for j in range(max(0, i - self.longest), i):
                piece = self.whole.get(w[j:i])
                if piece is not None and state[j] + self.scores[piece] > best:
                    best, at = state[j] + self.scores[piece], j
            start.append(at)
            state.append(best)

    def to_ids(self, pieces: list[str]) -> bytes:
        return _int32([i for p in pieces for i in ([self.ids[p]] if p in self.ids else self._unknown(p))])

    def cuts(self, word: str) -> list[str]:
        """A marked word cut where no piece can reach across: at line ends, and
        between a letter and a closing sign."""
        if word[-1] not in self.tails and "\n" not in word:
            return [MARK + word]
        out = []
        for i, part in enumerate((MARK + word).split("\n") if self.lines else [MARK + word]):
            if i:
                out.append("\n")
            if len(part) > 2 and part[-1] in self.tails and part[-2].isalpha():
                out += [part[:-1], part[-1]]
            elif part:
                out.append(part)
        return out

    def unit(self, marks: int, word: str) -> bytes:
        """A run of several marks and the word after it. Scores of merges inside
        the word precede those of runs, so the word's own mark leaves the run
        unless the word left it alone."""
        if not word:
            return self.to_ids(self.merge(MARK * marks)) if self.bpe else next(self.segment([MARK * marks]))
        own = self.words.young[word]
        lone = np.array([self.ids[MARK]], "<i4").tobytes()
        if own.startswith(lone):
            return self.unit(marks, "") + own[4:]
        return self.unit(marks - 1, "") + own

    def _learn(self, new: list[str]) -> None:
        """Encode words that are not held: cut, segment what is new in sorted
        order, join."""
        words, bare = self.words.young, self.bare.turn()
        new = [(w, self.cuts(w)) for w in new]
        marked = self.words.missing({c[1:] for _, cuts in new for c in cuts if c[0] == MARK})
        plain = self.bare.missing({c for _, cuts in new for c in cuts if c[0] != MARK})
        need = sorted([MARK + w for w in marked] + plain)
        for s, ids in zip(need, self.segment(need)):
            if s[0] == MARK:
                words[s[1:]] = ids
            else:
                bare[s] = ids
        for w, cuts in new:
            if len(cuts) > 1:
                words[w] = b"".join([words[c[1:]] if c[0] == MARK else bare[c] for c in cuts])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of whole texts as little-endian int32. Words are found and
        numbered by Arrow; Python only sees distinct ones."""
        rows = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
        flat = rows.flatten().dictionary_encode()
        code, distinct = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        words = self.words.turn()
        self._learn(self.words.missing(w for w in distinct if w))
        held = [words[w] if w else b"" for w in distinct]
        ids = np.frombuffer(b"".join(held), "<i4")
        size = np.fromiter(map(len, held), np.int64, len(held)) // 4
        at, n = np.cumsum(size) - size, size[code]
        end = np.cumsum(n)
        raw = ids[np.repeat(at[code] - (end - n), n) + np.arange(end[-1] if len(end) else 0)].tobytes()
        count = pc.list_value_length(rows).to_numpy(zero_copy_only=False)
        ends = np.r_[0, end][np.cumsum(count)] * 4
        out = [raw[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
        empty = np.flatnonzero(np.array([not w for w in distinct], bool)[code]) if "" in distinct else []
        for i in np.unique(np.searchsorted(np.cumsum(count), empty, side="right")):   # texts with runs of spaces
            out[i] = self._spaced(texts[i].as_py())
        return out

    def _spaced(self, text: str) -> bytes:
        if not text:
            return b""
        got, marks = [], 0
        for w in text.replace(MARK, " ").split(" "):
            marks += 1
            if w:
                got.append(self.words.young[w] if marks == 1 else self.unit(marks, w))
                marks = 0
        return b"".join(got) + (self.unit(marks, "") if marks else b"")

    def forget(self) -> None:
        """Drop what a task has remembered."""
        self.words, self.bare, self.pairs = Remembered(REMEMBER), Remembered(REMEMBER // 4), {}

    def decode(self, ids: bytes) -> str:
        """Text of ids: pieces joined, marks as spaces, without the leading one."""
        raw = self.raw
        out = b"".join([raw[i] for i in np.frombuffer(ids, "<i4").tolist()]).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _encode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b, _ in byte_rows(batches, "body", SLICE):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(m.encode(b.column("body").cast(pa.string())), pa.binary())], ["doc_id", "ids"])
        m.forget()
    return lean(run)


def _decode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([m.decode(x) for x in b.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])
    return lean(run)


def _digest(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b, bodies in byte_rows(batches, "body", SLICE):
            ids = m.encode(b.column("body").cast(pa.string()))
            same = [m.decode(i).encode() == t for i, t in zip(ids, bodies)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(same)], ["doc_id", "n_pieces", "ids_crc32", "round_trip"])
        m.forget()
    return lean(run)


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return spread(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("body")))


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian int32 binary, one row per input row.
    Null and empty texts have no ids; extra columns are ignored."""
    return _bodies(docs, id_col, text_col).mapInArrow(_encode(path), "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of encoded rows."""
    return encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(_decode(path), "doc_id long, text string")


def piece_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, round_trip): both directions in one pass.
    round_trip is false only for texts that hold the mark character itself,
    which decodes to a space."""
    return _bodies(docs, id_col, text_col).mapInArrow(_digest(path), "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")


def op8_piece_viterbi(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
