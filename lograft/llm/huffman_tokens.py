"""Token-ID output: canonical length-limited Huffman files of token ids.

1. Texts are encoded once, in parallel, and the ids landed.
2. Ids are counted globally (per-batch counts, summed by Spark; one row per
   vocabulary entry reaches the driver, never more).
3. Package-merge gives code lengths of at most MAX_LEN bits; codes are
   canonical, so a file carries one length per id and nothing else.
4. Rows are range-partitioned by key; each task writes one file of independent
   blocks with a bit-offset checkpoint every CHECKPOINT ids.
5. Reading decodes every checkpoint's run in lock step through one table.

File layout (little endian): magic, then lengths of the three parts that
follow as u64; code lengths (zlib, u8 per id); document table (zlib: count,
id i64 each, id-present u8 each, ids per document i64); block index (zlib:
tokens, bits and offset of each block, u64 each, then checkpoints u32);
payload. Bits run from the most significant.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import Remembered, byte_rows, byte_slices, land, ordered_keys, parts, spread, table
from .shared_files import committed, read_bytes
from .word_chunks import PLAIN_LETTERS, chunk_ids, load

MAGIC = b"HUFFTOK1"
MAX_LEN = 18
BLOCK = 1 << 16
CHECKPOINT = 256
FILE_TOKENS = 8_000_000
CACHE = 96 << 20    # bytes of white-space chunks and their ids that a worker remembers
SLICE = 8 << 20     # bytes of text encoded together
END_ID = 2
TOKENIZER = "word_bpe_49k.json"

SEPARATOR = "\x01"  # a sign of one id; chunks that hold it are encoded alone


class ChunkEncoder:
    """Ids of texts through the ids of their white-space chunks, as the library
    gives them. The tokenizer drops white space and never merges across it, so a
    text's ids are those of its chunks in a row; chunks are remembered."""

    def __init__(self, path: str, limit: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec, self.tokenizer = load(path)
        self.chunks = Remembered(limit)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = int(self.kind[-1])
        sep = self._ids(SEPARATOR)
        if len(sep) != 1:
            raise ValueError("the separator needs an id of its own")
        self.sep = sep[0]
        vocab, suffix = self.tokenizer.get_vocab(), spec["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _many(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _encode(self, chunks: list[str]) -> None:
        """Encode many chunks in few calls. Plain letters are one word to the
        tokenizer, so their ids are cut after each id that ends a word. Others
        are joined by a separator that has an id of its own."""
        alone, plain, mixed = [], [], []
        for c in chunks:
            (plain if PLAIN_LETTERS.fullmatch(c) else alone if SEPARATOR in c or len(c) > 1000 else mixed).append(c)
        for x in range(0, len(plain), 10_000):
            group = plain[x:x + 10_000]
            ids = self._many(" ".join(group))
            cut = (np.flatnonzero(self.ends[ids]) + 1) * self.width
            if len(cut) != len(group):
                raise ValueError("a run of letters is not one word")
            raw = ids.tobytes()
            self.chunks.young.update(zip(group, [raw[i:j] for i, j in zip([0, *cut[:-1].tolist()], cut.tolist())]))
        for x in range(0, len(mixed), 10_000):
            group = mixed[x:x + 10_000]
            ids = self._many(f" {SEPARATOR} ".join(group))
            cut = np.flatnonzero(ids == self.sep) * self.width
            raw = ids.tobytes()
            if len(cut) != len(group) - 1:
                raise ValueError("separator occurs inside a chunk")
            self.chunks.young.update(zip(group, [raw[i:j] for i, j in zip([0, *(cut + self.width).tolist()], [*cut.tolist(), len(raw)])]))
        for c in alone:
            self.chunks.young[c] = np.array(self._ids(c), self.kind).tobytes()

    def _held(self, words: list[str]) -> list[bytes]:
        """Ids of each of the distinct `words`."""
        young = self.chunks.turn()
        self._encode(self.chunks.missing(words))
        return [young[c] for c in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        return chunk_ids(texts, self._held, self.kind)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _encode(path: str, end_id: int | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        end = b"" if end_id is None else np.array([end_id], e.kind).tobytes()
        for b in byte_slices(batches, "body", SLICE):
            ids, n = e.encode(b.column("body"))
            raw, cut = ids.tobytes(), np.r_[0, np.cumsum(n)] * e.width
            rows = [raw[x:y] + end for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("id"), pa.array([len(x) // e.width for x in rows], pa.int64()), pa.array(rows, pa.binary())], ["k", "id", "n", "ids"])
    return run


def _count(kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for _, ids in byte_rows(batches, "ids"):
            c = np.bincount(np.frombuffer(b"".join(ids), kind))
            if len(c) > len(total):
                c[:len(total)] += total
                total = c
            else:
                total[:len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["sym", "n"])
    return run


def code_lengths(counts: np.ndarray, limit: int = MAX_LEN) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (package-merge); 0 for ids
    that do not occur."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError("limit too small for the number of ids")
    used = used[np.argsort(counts[used], kind="stable")]
    base = counts[used].astype(np.int64)
    levels, packages = [], np.empty(0, np.int64)
    for _ in range(limit):
        merged = np.concatenate([base, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(base))
        merged = merged[order]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    active = 2 * len(base) - 2
    for own in reversed(levels):
        c = int(own[:active].sum())
        out[used[:c]] += 1
        active = 2 * (active - c)
    return out


def canonical(lengths: np.ndarray, limit: int = MAX_LEN) -> tuple[np.ndarray, np.ndarray]:
    """Codes (per id) and the decoding table: for each `limit` leading bits,
    id << 8 | length. Codes ascend by (length, id)."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    ln = lengths[order].astype(np.int64)
    span = np.int64(1) << (limit - ln)
    start = np.cumsum(span) - span
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = (start >> (limit - ln)).astype(np.uint64)
    look = np.zeros(1 << limit, np.int64)
    look[:span.sum()] = np.repeat((order.astype(np.int64) << 8) | ln, span)
    return codes, look


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """One block: (bytes, bit offset of every CHECKPOINT-th id, bits)."""
    ln = lengths[ids].astype(np.int64)
    end = np.cumsum(ln)
    at = end - ln
    bits = int(end[-1])
    word, room = at >> 6, 64 - (at & 63)
    c = codes[ids]
    over = np.maximum(ln - room, 0)
    head = np.where(over > 0, c >> over.astype(np.uint64), c << np.maximum(room - ln, 0).astype(np.uint64))
    out = np.zeros((bits >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out[word[first]] = np.add.reduceat(head, first)
    cross = np.flatnonzero(over)
    out[word[cross] + 1] += c[cross] << (64 - over[cross]).astype(np.uint64)
    return out.astype(">u8").tobytes()[:-(-bits // 8)], at[::CHECKPOINT].astype(np.uint32), bits


def unpack(payload: bytes, offsets: np.ndarray, sizes: np.ndarray, look: np.ndarray, limit: int = MAX_LEN) -> np.ndarray:
    """Ids of runs that begin at the given bit offsets and hold `sizes` ids;
    all runs advance together, one table look-up an id."""
    b = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    four = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    at = offsets.astype(np.int64)
    shift = np.uint32(32 - limit)
    for step in range(out.shape[1]):
        bits = (four[at >> 3] << (at & 7).astype(np.uint32)) >> shift
        hit = look[bits]
        out[:, step] = hit >> 8
        at = np.minimum(at + (hit & 255), (len(payload) + 4) * 8)
    return out[np.arange(out.shape[1]) < sizes[:, None]]


def _write(folder: str, kind: str, lengths_b):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = lengths_b.value
        codes, _ = canonical(lengths)
        part = TaskContext.get().partitionId()
        doc, have, n, index, checks, blocks, held, held_n = [], [], [], [], [], [], [], 0
        size = 0

        def flush(every: bool) -> None:
            nonlocal held, held_n, size
            ids = np.concatenate(held) if held else np.empty(0, kind)
            full = len(ids) if every else len(ids) // BLOCK * BLOCK
            for x in range(0, full, BLOCK):
                some = ids[x:min(full, x + BLOCK)]
                data, marks, bits = pack(some, codes, lengths)
                index.append((len(some), bits, size))
                checks.append(marks)
                blocks.append(data)
                size += len(data)
            held, held_n = ([ids[full:]] if full < len(ids) else []), len(ids) - full

        for b, ids in byte_rows(batches, "ids"):
            doc += b.column("id").fill_null(0).to_pylist()
            have += b.column("id").is_valid().to_pylist()
            n += b.column("n").to_pylist()
            some = np.frombuffer(b"".join(ids), kind)
            held.append(some)
            held_n += len(some)
            if held_n >= 16 * BLOCK:
                flush(False)
        flush(True)
        if not doc:
            return
        docs = np.int64(len(doc)).tobytes() + np.array(doc, "<i8").tobytes() + np.array(have, np.uint8).tobytes() + np.array(n, "<i8").tobytes()
        marks = np.int64(len(index)).tobytes() + np.array(index, "<u8").tobytes() + (np.concatenate(checks).astype("<u4").tobytes() if checks else b"")
        head = [zlib.compress(x, 6) for x in (lengths.tobytes(), docs, marks)]
        with committed(folder, f"part-{part:06d}.tok") as (out, name):
            out.write(MAGIC + np.array([len(x) for x in head], "<u8").tobytes())
            for x in [*head, *blocks]:
                out.write(x)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(doc)], pa.int64()), pa.array([sum(n)], pa.int64())], ["part", "name", "n_docs", "n_tokens"])
    return run


def read_file(data: bytes, group: int = 32) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of every document of a file, in file order; `group`
    blocks are decoded together."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    a, b, c = np.frombuffer(data[8:32], "<u8").tolist()
    lengths = np.frombuffer(zlib.decompress(data[32:32 + a]), np.uint8)
    docs = zlib.decompress(data[32 + a:32 + a + b])
    marks = zlib.decompress(data[32 + a + b:32 + a + b + c])
    base = 32 + a + b + c
    n_docs = int(np.frombuffer(docs[:8], "<i8")[0])
    ids = np.frombuffer(docs[8:8 + 8 * n_docs], "<i8").tolist()
    have = np.frombuffer(docs[8 + 8 * n_docs:8 + 9 * n_docs], np.uint8).tolist()
    sizes = np.frombuffer(docs[8 + 9 * n_docs:], "<i8").tolist()
    n_blocks = int(np.frombuffer(marks[:8], "<i8")[0])
    index = np.frombuffer(marks[8:8 + 24 * n_blocks], "<u8").astype(np.int64).reshape(-1, 3)
    checks = np.frombuffer(marks[8 + 24 * n_blocks:], "<u4").astype(np.int64)
    _, look = canonical(lengths)
    per = -(-index[:, 0] // CHECKPOINT) if n_blocks else np.empty(0, np.int64)
    first = np.cumsum(per) - per

    def tokens() -> Iterator[np.ndarray]:
        for x in range(0, n_blocks, group):
            some = index[x:x + group]
            lo, hi = int(some[0, 2]), int(some[-1, 2] + -(-some[-1, 1] // 8))
            offs = np.concatenate([checks[f:f + p] + (o - lo) * 8 for f, p, o in zip(first[x:x + group], per[x:x + group], some[:, 2])])
            size = np.concatenate([np.minimum(CHECKPOINT, t - CHECKPOINT * np.arange(p)) for t, p in zip(some[:, 0], per[x:x + group])])
            yield unpack(data[base + lo:base + hi], offs, size, look)

    source, held = tokens(), np.empty(0, np.int64)
    at = 0
    for i, h, n in zip(ids, have, sizes):
        if len(held) - at < n:
            got, short = [held[at:]], n - (len(held) - at)
            while short > 0:
                got.append(next(source))
                short -= len(got[-1])
            held, at = np.concatenate(got), 0
        yield (i if h else None), held[at:at + n]
        at += n


def _read(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, start in zip(b.column("name").to_pylist(), b.column("start").to_pylist()):
                rows = []
                for i, ids in read_file(read_bytes(folder, name)):
                    rows.append((i, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                    start += len(ids)
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Encode whole texts and write them as files in ascending id order under
    `folder`. Returns the manifest (part, name, n_docs, n_tokens, start), landed;
    only files it names count.

    Null text counts as empty. Rows that repeat an id follow each other in text
    order, rows without id come last. An empty table writes no file.
    """
    spark = docs.sparkSession
    keyed = ordered_keys(docs, id_col, text_col).select("k", "id", F.coalesce(F.col("body").cast("string"), F.lit("")).alias("body"))
    kind = encoder(tokenizer_path).kind
    path = scratch_path(spark, "token-ids")
    spread(keyed).mapInArrow(_encode(tokenizer_path, end_id), "k long, id long, n long, ids binary") \
        .write.option("compression", "zstd").parquet(path)
    ids = spark.read.parquet(path)
    counts = ids.select("ids").mapInArrow(_count(kind), "sym long, n long").groupBy("sym").agg(F.sum("n").alias("n")).toPandas()
    dense = np.zeros(int(counts["sym"].max()) + 1 if len(counts) else 1, np.int64)
    dense[counts["sym"].to_numpy(int)] = counts["n"].to_numpy(int)
    lengths = spark.sparkContext.broadcast(code_lengths(dense))
    files = parts(spark, int(dense.sum()), FILE_TOKENS)
    written = ids.repartitionByRange(files, "k").sortWithinPartitions("k") \
        .mapInArrow(_write(folder, kind, lengths), "part int, name string, n_docs long, n_tokens long")
    written = land(written, "token-files")
    # one row a file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return land(written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))), "token-files")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files."""
    n = max(1, manifest.agg(F.max("part")).first()[0] or 0) + 1
    return manifest.repartitionById(n, "part").mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_huffman_tokens(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-output")
    manifest = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), folder)
    return read_tokens(manifest, folder)
