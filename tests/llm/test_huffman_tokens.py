import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lograft.llm import huffman_tokens as H

PATH = public_tokenizers.path(H.TOKENIZER)


def test_code_lengths_optimal_and_limited():
    r = np.random.default_rng(0)
    counts = r.integers(1, 1000, 300)
    heap = [(int(c), 0) for c in counts]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 0))
    free = H.code_lengths(counts, 30)
    assert (free * counts).sum() == cost
    fib = np.array([1, 1] + [0] * 40)
    for i in range(2, 42):
        fib[i] = fib[i - 1] + fib[i - 2]
    for limit in (6, 8, 18):
        ln = H.code_lengths(fib, limit)
        assert ln.max() <= limit and sum(2.0 ** -int(x) for x in ln) == 1
    assert H.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0] and not H.code_lengths(np.zeros(3, int)).any()


@pytest.mark.parametrize("n", [1, 255, 256, 257, 70_000])
def test_block_round_trip(n):
    r = np.random.default_rng(n)
    ids = (r.zipf(1.3, n) % 5000).astype("<u2")
    ln = H.code_lengths(np.bincount(ids))
    codes, look = H.canonical(ln)
    data, marks, bits = H.pack(ids, codes, ln)
    sizes = np.minimum(H.CHECKPOINT, n - H.CHECKPOINT * np.arange(len(marks)))
    assert bits == ln[ids].astype(int).sum() and (H.unpack(data, marks, sizes, look) == ids).all()


def expected(rows):
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    return out


def run(spark, df):
    from lograft.session import scratch_path

    folder = scratch_path(spark, "tok")
    return [tuple(r) for r in H.read_tokens(H.write_tokens(df, PATH, folder), folder).orderBy("start", "n_tokens").collect()]


def test_files_match_the_library(spark):
    texts = ["Hello  World's\n\t it'S  é É x<|endoftext|>y <|startoftext|>  z\x1cq", "", None, " ", "̈a ̈b", "naïve Ünïcode ½ 12345 don't -- ok", "x" * 5000, "İstanbul İ", "x" * 3000 + "y" * 3000, "<|ENDOFTEXT|> <|endoftext|>", "H\u0331 h\u0331 A\u030a", "  lead and trail  \n", "ΣΑΣ Σ", "a\x01b \x01 c \x01\x01", "it's. 's. don't, é́, a.b. ... x.. ,y", "Ａ 中文字 \U0001f600\U0001f600 a\x0bb\x0cc\x85d"]
    texts += [f"word{i} repeat " * (i % 50) for i in range(120)]
    rows = [((i * 7) % 1000, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(spark, df) == expected(rows)


def test_dirty_ids_and_empty(spark):
    rows = [(3, "b"), (3, "a"), (3, "a"), (None, "z"), (1, None)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, n string")
    assert run(spark, df) == expected(rows)
    assert run(spark, df.limit(0)) == []


def test_cache_generations():
    t, e = Tokenizer.from_file(PATH), H.ChunkEncoder(PATH, limit=40)
    for i in range(30):
        text = " ".join(f"word{(i * j) % 17}, x{j % (i + 2)}." for j in range(20))
        assert e.encode(pa.array([text]))[0].tolist() == t.encode(text, add_special_tokens=False).ids
        assert len(e.chunks.young) < 100


def same_ids(texts):
    e, t = H.ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    for x in range(0, len(texts), 2000):
        some = texts[x:x + 2000]
        ids, n = e.encode(pa.array(some, pa.string()))
        cut = np.r_[0, np.cumsum(n)]
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == [g.ids for g in t.encode_batch(some, add_special_tokens=False)]


def test_letters_that_are_more_than_letters_in_lower_case():
    """Every letter of the lower planes before signs, controls and letters."""
    letters = [chr(c) for c in range(0x80, 0x3100) if chr(c).isalpha()]
    same_ids([f"{c}{s} x{c}{s} {c}" for c in letters for s in (".", "!", "\x01", "́")])


def test_ids_equal_the_library_on_random_texts():
    r = random.Random(8)
    some = ["a", "The", "İ", "क़", "ড়", "é", "é", "ᄀ", "ᅡ", "Σ", "1", "½", "'s", "'", "<|endoftext|>", "<|", " ", "\n", "　", "\x0b", "\x01", "\x00", ".", "!?", ",", "漢", "😀"]
    same_ids(["".join(r.choice(some) for _ in range(r.randrange(20))) for _ in range(10_000)])


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        H.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_text_longer_than_a_slice(spark):
    rows = [(2, "short one"), (1, "Straße, İ! " * 1_000_000), (3, None)]
    assert len(rows[1][1].encode()) > H.SLICE
    assert run(spark, spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)
