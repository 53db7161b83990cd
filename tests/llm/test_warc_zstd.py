import hashlib
import io
import random

import zstandard

from lograft.llm import warc_zstd as W
from lograft.session import scratch_path


def pages(n=120):
    r = random.Random(1)
    body = lambda k: "<html lang='en'><p>" + " ".join(r.choice(["the", "é", "of", "th"]) for _ in range(k)) + "</p></html>"
    same, small = body(900), "<p>small</p>"
    rows = [(i, f"http://h{i % 4}.example.org/{i} x", r.choice([same, small, body(r.randint(0, 3000)), "", None])) for i in range(n)]
    return rows + [(500, None, "z" * 1000), (501, "", "z" * 1000), (502, "u", "y" * 999), (503, "u", "y" * 999), (500, "u", "z" * 1000), (None, "u", same), (504, "u", "a\r\n\r\nWARC/1.1\r\n" * 200)]


def expected(rows):
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h] = max(best.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        rev = len(b) >= 1000 and best[h] != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if rev else "response", best[h] if rev else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*x, "n") for x in rows], "page_id long, url string, html string, digest string").repartition(3)
    folder = scratch_path(spark, "warc")
    manifest = W.write_warc(df, folder)
    got = sorted((tuple(r) for r in W.read_warc(manifest, folder).collect()), key=str)
    assert got == expected(rows)
    empty = W.write_warc(df.limit(0), folder)
    assert W.read_warc(empty, folder).count() == 0


def test_archive_layout(monkeypatch):
    recs = [W.record(i, "http://x.org", (f"<p>{i} common words here</p>" * 40).encode(), "00" * 20, None) for i in range(60)]
    out = io.BytesIO()
    W.write_archive(out, iter(recs), recs)
    data = out.getvalue()
    size = int.from_bytes(data[4:8], "little")
    assert data[:4] == W.DICT_MAGIC.to_bytes(4, "little") and data[8:12] == b"\x37\xa4\x30\xec"
    # each record is a frame of its own that the embedded dictionary opens
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    rest, n = data[8 + size:], 0
    while rest:
        o = d.decompressobj()
        assert o.decompress(rest) == recs[n]
        rest, n = o.unused_data, n + 1
    assert n == 60
    assert [b for _, b in W.read_archive(io.BytesIO(data))] == [r.partition(b"\r\n\r\n")[2][:-4] for r in recs]
    tiny = io.BytesIO()
    W.write_archive(tiny, iter(recs[:1]), recs[:1])
    assert len(list(W.read_archive(io.BytesIO(tiny.getvalue())))) == 1


def test_large_and_few_pages_have_a_dictionary(spark, monkeypatch):
    r = random.Random(9)
    words = ["<div class='row'>", "</div>", "the", "of", "page", "é"] + [f"w{i}" for i in range(300)]
    large = [(i, f"http://h.org/{i}", " ".join(r.choice(words) for _ in range(40_000))) for i in range(12)]
    assert min(len(h) for _, _, h in large) > 150_000
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 400_000)       # roll over inside a task
    for rows in (large, [(1, None, "x")], [(1, None, None)]):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
        folder = scratch_path(spark, "warc")
        manifest = W.write_warc(df, folder)
        names = [x["name"] for x in manifest.collect() if x["name"]]
        assert len(names) >= (4 if len(rows) > 1 else 1)
        for name in names:
            with open(f"{folder.removeprefix('file:')}/{name}", "rb") as f:
                data = f.read()
            size = int.from_bytes(data[4:8], "little")
            assert data[:4] == W.DICT_MAGIC.to_bytes(4, "little") and size > 0
            if len(rows) > 1:
                assert data[8:12] == b"\x37\xa4\x30\xec"       # trained, also of large pages
        assert sorted((tuple(x) for x in W.read_warc(manifest, folder).collect()), key=str) == expected(rows)


def test_pieces_come_from_all_records():
    recs = [bytes([65 + i]) * 500_000 for i in range(20)]
    pieces = W.dictionary_pieces(recs)
    assert {p[:1] for p in pieces} == {r[:1] for r in recs} and sum(map(len, pieces)) <= W.SAMPLE_BYTES + W.PIECE_BYTES
    noise = random.Random(2).randbytes(600)
    assert W.build_dictionary([noise]).as_bytes() == noise
