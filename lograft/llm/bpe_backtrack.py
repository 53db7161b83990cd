"""BPE encoding and decoding without merging: backtracking over longest tokens.

A token sequence is what the merges give if and only if every adjacent pair of
tokens is compatible, that is, encoding the two tokens' joined text gives just
these two. So a word is encoded left to right:

1. One Aho-Corasick pass over all new words gives the longest token at every
   place.
2. At a place the longest token is tried, then its next shorter prefixes, until
   one is compatible with the token before it and does not end at a dead place.
3. Where none is, the place is dead and the token before it gives way to its
   next shorter prefix. A place dies once, so the work is linear in the word.

Compatibility is looked up in a table of pairs that fills as pairs occur. It is
found by undoing the merges of both tokens at their border, latest first: no
pair that faces each other on the way may have merged earlier.

Decoding is one gather through an offset table: the bytes of all tokens in a
row and where each begins. The library's normaliser and splitter cut a text into
words; the model's merges are never run. The operator is map-only.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, byte_slices, lean, spread, table
from .word_chunks import chunk_ids, load

TOKENIZER = "word_bpe_49k.json"
REMEMBER = 24 << 20   # bytes of white-space chunks, and of words, that a task remembers
PAIRS = 200_000       # pairs of tokens that a task remembers
SLICE = 2 << 20       # bytes of text encoded together
RUN = 1 << 18         # ids decoded together
END = "\n"            # stands for the end-of-word suffix; not in the byte alphabet

ASCII_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9]+")
PLAIN = re.compile(r"[!-~]*")     # visible ASCII: lower case is all the normaliser does

_models: dict[str, BacktrackBpe] = {}


class BacktrackBpe:
    """Tables of a tokenizer file and the words encoded so far."""

    def __init__(self, path: str):
        import ahocorasick

        spec, tok = load(path)
        m, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.normalise, self.split = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
        self.letters = Letters(lambda x: self.split(self.normalise(x)))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        vocab: dict[str, int] = m["vocab"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.kind = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)

        form = {t: t[:-len(suffix)] + END if t.endswith(suffix) and t not in self.special else t for t in vocab}
        self.rank, self.halves, self.merged = [-1] * size, [None] * size, {}
        for r, pair in enumerate(m["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            t = vocab[a + b]
            if self.rank[t] >= 0:
                raise ValueError("a token with two merges is not supported")
            self.rank[t], self.halves[t], self.merged[vocab[a] << 20 | vocab[b]] = r, (vocab[a], vocab[b]), r
        # a token counts if its own text encodes to it: its halves do, and do not fall to an earlier merge
        good = [False] * size
        base = {form[t]: i for t, i in vocab.items() if self.rank[i] < 0 and t not in self.special and len(form[t].rstrip(END)) == 1}
        for i in base.values():
            good[i] = True
        for t, i in sorted(vocab.items(), key=lambda x: self.rank[x[1]]):
            if self.halves[i] is not None:
                a, b = self.halves[i]
                good[i] = good[a] and good[b] and self._stable(a, b, self.rank[i])
        tokens = {form[t]: i for t, i in vocab.items() if good[i]}
        self.length, self.shorter = [0] * size, [-1] * size
        self.longest = ahocorasick.Automaton()
        for t, i in tokens.items():
            self.length[i] = len(t)
            cut = len(t) - 1 - t.endswith(END)
            while cut > 0 and t[:cut] not in tokens:
                cut -= 1
            if cut > 0:
                self.shorter[i] = tokens[t[:cut]]
            self.longest.add_word(t, (i, len(t) - 1))
        self.longest.make_automaton()

        names = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            names[i] = t
        self.text = OffsetTable([t.encode() + b" " for t in names])
        self.digits = OffsetTable([b"%d " % i for i in range(size)])
        self.forget()

    def forget(self) -> None:
        """Drop what a task has remembered."""
        self.chunks, self.words, self.pairs = Remembered(REMEMBER), Remembered(REMEMBER), {}

    def _stable(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Does nothing merge across the border of `a` and `b` with a rank below
        `limit`, or before the merges that made them? Of equal ranks the merge
        further left comes first."""
        rank, halves, merged = self.rank, self.halves, self.merged
        while True:
            r = merged.get(a << 20 | b)
            if r is not None and r < limit:
                return False
            left, right = rank[a], rank[b]
            if left > right:
                limit, a = left, halves[a][1]
            elif right >= 0:
                limit, b = right + 1, halves[b][0]
            else:
                return True

    def _encode_words(self, words: list[str]) -> None:
        """Remember the ids of words in the byte alphabet."""
        found, pairs, length, shorter, kind = self.words.young, self.pairs, self.length, self.shorter, self.kind.char
        if len(pairs) > PAIRS:
            pairs.clear()
        row = END.join(words) + END
        longest = [-1] * (len(row) + 1)
        for last, (token, more) in self.longest.iter(row):    # ends ascend: the longest comes last
            longest[last - more] = token
        at = 0
        for w in words:
            end, out, dead, pos = at + len(w) + 1, [], {at + len(w)}, at
            token = longest[at]
            while pos < end:
                if token < 0:                    # nothing fits here: the token before is too long
                    dead.add(pos)
                    before = out.pop()
                    pos -= length[before]
                    token = shorter[before]
                    continue
                after = pos + length[token]
                ok = after not in dead
                if ok and out:
                    key = out[-1] << 20 | token
                    ok = pairs.get(key)
                    if ok is None:
                        ok = pairs[key] = self._stable(out[-1], token)
                if ok:
                    out.append(token)
                    pos, token = after, longest[after]
                else:
                    token = shorter[token]
            found[w] = array(kind, out).tobytes()
            at = end

    def _cut(self, chunk: str) -> list[str | int]:
        """Words of a chunk in the byte alphabet; special strings as their ids."""
        if chunk.isascii() and chunk.isalpha():     # in lower case already
            return [chunk]
        if chunk.isalpha():
            word = chunk.translate(self.letters)
            if "\0" not in word:
                return [word]
        elif PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return ASCII_WORDS.findall(chunk)
        out: list[str | int] = []
        for part in self.specials.split(chunk):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [w for w, _ in self.split(self.normalise(part))]
        return out

    def held(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of the distinct `chunks`."""
        young, words = self.chunks.turn(), self.words.turn()
        new = [(c, self._cut(c)) for c in self.chunks.missing(chunks)]
        missing = self.words.missing({w for _, cut in new for w in cut if isinstance(w, str)})
        if missing:
            self._encode_words(missing)
        for c, cut in new:
            if len(cut) == 1 and isinstance(cut[0], str):
                young[c] = words[cut[0]]
            else:
                young[c] = b"".join([words[w] if isinstance(w, str) else array(self.kind.char, [w]).tobytes() for w in cut])
        return [young[c] for c in chunks]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        return chunk_ids(texts, self.held, self.kind)

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode gives: tokens joined by one space."""
        return self.text.gather(ids)[0][:-1].decode("utf-8", "replace")


class Letters(dict):
    """A letter's lower case in the byte alphabet, or NUL where it is not one
    word by itself, or may compose with the letter after it (Hangul parts)."""

    def __init__(self, words: Callable[[str], list]):
        super().__init__()
        self.words = words

    def __missing__(self, code: int) -> str:
        got = [] if 0x1100 <= code <= 0x11ff else self.words(chr(code))
        both = self.words(f"a{chr(code)}a") if got else []
        self[code] = got[0][0] if len(got) == len(both) == 1 else "\0"
        return self[code]


class OffsetTable:
    """Byte strings in one row; decoding copies slices of it by id."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], np.int32)
        self.start = np.cumsum(self.size, dtype=np.int32) - self.size
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def gather(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(strings of the ids in a row, where each ends)."""
        n = self.size[ids]
        end = np.cumsum(n, dtype=np.int64)
        total = int(end[-1]) if len(end) else 0
        at = np.repeat((self.start[ids] - (end - n)).astype(np.int64), n)
        return self.bytes[at + np.arange(total)].tobytes(), end

    def digests(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """SHA-256 of each document's strings, without the last one's closing
        space; `sizes` ids belong to each. Ids are copied in runs, so memory
        does not grow with a document."""
        ends = np.cumsum(sizes)
        hashes = [hashlib.sha256() for _ in sizes]
        doc = 0
        for x in range(0, len(ids), RUN):
            raw, end = self.gather(ids[x:x + RUN])
            low = 0
            while doc < len(ends) and low < len(raw):
                stop = int(ends[doc]) - x
                high = int(end[min(stop, len(end)) - 1]) if stop > 0 else 0
                done = stop <= len(end)
                hashes[doc].update(memoryview(raw)[low:max(low, high - (done and high > low))])
                low = max(low, high)
                if not done:
                    break
                doc += 1
        return [h.hexdigest() for h in hashes]


def model(path: str) -> BacktrackBpe:
    if path not in _models:
        _models[path] = BacktrackBpe(path)
    return _models[path]


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return spread(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("body")))


def _encode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in byte_slices(batches, "body", SLICE):
            ids, n = m.encode(b.column("body"))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists], ["doc_id", "ids"])
        m.forget()
    return lean(run)


def _decode(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            texts = [m.decode(np.array(x or [], np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return lean(run)


def _digest(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in byte_slices(batches, "body", SLICE):
            ids, n = m.encode(b.column("body"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(m.digits.digests(ids, n)), pa.array(m.text.digests(ids, n))],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        m.forget()
    return lean(run)


def encode_bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>), one row per input row, repeated rows and null
    ids included. Null and empty texts have no ids; extra columns are ignored; an
    empty table gives an empty one."""
    return _bodies(docs, id_col, text_col).mapInArrow(_encode(path), "doc_id long, ids array<int>")


def decode_bpe(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of encoded rows, special tokens kept; null or empty ids
    give the empty text."""
    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(_decode(path), "doc_id long, text string")


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): both directions in one
    pass, one row per input row under the rules of :func:`encode_bpe`."""
    return _bodies(docs, id_col, text_col).mapInArrow(_digest(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_bpe_backtrack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
