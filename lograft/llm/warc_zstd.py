"""WARC archives of web pages, compressed record by record with a dictionary.

An archive (.warc.zst) starts with a skippable frame that holds a Zstandard
dictionary built from its own records; each record is a frame of its own. The
dictionary is trained on pieces taken evenly from the records that a task reads
ahead (AHEAD_BYTES; large records give several pieces); where these are too few or
too alike to train on, the pieces themselves are the dictionary's content.
Records with equal payloads of at least `min_bytes` are stored once: the one
with the largest page id is the response, the others are revisits of it.

Each task writes the archives of its input split; nothing is shuffled but the
digests that repeat (and the pages against them, if those outgrow a broadcast).
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..session import scratch_path
from .common import byte_rows, land, spread, table
from .shared_files import committed, resolve

MIN_BYTES = 1000
DICT_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20          # pieces that the dictionary is trained on
PIECE_BYTES = 4 << 10
AHEAD_BYTES = 16 << 20          # records that the pieces are taken from
ARCHIVE_BYTES = 256 << 20       # payload after which a task starts a new archive
LEVEL = 3
DICT_MAGIC = 0x184D2A5D         # fixed value: skippable frame of a .warc.zst dictionary
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"   # fixed value of the WARC format
DATE = "2024-01-01T00:00:00Z"


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A response record, or a revisit (HTTP header only) if `refers_to` is set."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = "".join(url.split()) if url else "about:blank"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _urn(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary_pieces(records: list[bytes]) -> list[bytes]:
    """Pieces of the records, evenly spread, of about SAMPLE_BYTES together; the
    first starts the first record."""
    pieces = [r[i:i + PIECE_BYTES] for r in records for i in range(0, len(r), PIECE_BYTES)]
    return pieces[::max(1, -(-sum(map(len, pieces)) // SAMPLE_BYTES))]


def build_dictionary(pieces: list[bytes], size: int = DICT_BYTES):
    """A dictionary trained on the pieces; of too little to train on (under 8
    pieces or 8 KB, or pieces without repeats) their bytes."""
    import zstandard

    total = sum(map(len, pieces))
    if len(pieces) >= 8 and total >= 8 * 1024:
        try:
            return zstandard.train_dictionary(min(size, total // 8), pieces, k=256, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(pieces)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(out, records: Iterable[bytes], ahead: list[bytes]) -> None:
    """Write an archive; `ahead` are records of it (at least one) to build the
    dictionary from."""
    import zstandard

    d = build_dictionary(dictionary_pieces(ahead))
    raw = d.as_bytes()
    out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=True, write_content_size=True)
    for r in records:
        out.write(packer.compress(r))


def read_archive(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of every record of an open archive, a frame at a time."""
    import zstandard

    head = f.read(8)
    if not head:
        return
    d, held = None, head
    magic, size = struct.unpack("<II", head)
    if magic == DICT_MAGIC:
        d, held = zstandard.ZstdCompressionDict(f.read(size)), b""
    opener = zstandard.ZstdDecompressor(dict_data=d) if d is not None else zstandard.ZstdDecompressor()
    while held or (held := f.read(1 << 20)):
        frame, got = opener.decompressobj(), []
        while True:
            got.append(frame.decompress(held))
            if frame.eof:
                held = frame.unused_data
                break
            held = f.read(1 << 20)
            if not held:
                raise ValueError("truncated record")
        top, _, rest = b"".join(got).partition(b"\r\n\r\n")
        lines = top.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        if len(rest) != n + 4:
            raise ValueError("record length does not match its header")
        yield fields, rest[:n]


def _write(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, counts = TaskContext.get().partitionId(), [], []

        def records() -> Iterator[bytes]:
            for b, bodies in byte_rows(batches, "body"):
                cols = [b.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
                for page, url, digest, refers, body in zip(*cols, bodies):
                    yield record(page, url, body, digest, refers)

        source = records()
        more = next(source, None)
        while more is not None:
            first, size = deque([more]), len(more)
            for more in source:
                first.append(more)
                size += len(more)
                if size >= AHEAD_BYTES:
                    break
            total, n = 0, 0

            def some(first=first) -> Iterator[bytes]:
                nonlocal total, n
                while first:
                    r = first.popleft()
                    total, n = total + len(r), n + 1
                    yield r
                for r in source:
                    total, n = total + len(r), n + 1
                    yield r
                    if total >= ARCHIVE_BYTES:
                        return

            with committed(folder, f"pages-{part:06d}.warc.zst") as (out, name):
                write_archive(out, some(), list(first))
            names.append(name)
            counts.append(n)
            more = next(source, None)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["name", "n_records"])
    return run


def _page(urn: str | None) -> int | None:
    value = urn.rpartition(":")[2].rstrip(">") if urn else "none"
    return None if value == "none" else int(value)


def _read(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        system, root = resolve(folder)
        for b in batches:
            for name in b.column("name").to_pylist():
                rows = []
                with system.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for fields, block in read_archive(f):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind = fields["WARC-Type"]
                        stated = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        if kind == "response":
                            size, real = len(payload), hashlib.sha1(payload).hexdigest()
                            if real != stated:
                                raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                        rows.append((_page(fields["WARC-Record-ID"]), size, stated, kind, _page(fields.get("WARC-Refers-To"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names)
    return run


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, body, digest, refers_to) of every page; refers_to is set
    for revisits. Null html counts as empty. Of rows that repeat an id and its
    payload, all with the largest id are responses; rows without id never are
    the one that others refer to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("body")) \
        .withColumn("digest", F.sha1("body"))
    large = F.length("body") >= min_bytes
    kept = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "kept")
    out = lookup_join(spread(rows), land(kept, "repeated"), "digest")
    other = large & F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return out.select("page_id", "url", "body", "digest", F.when(other, F.col("kept")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write archives under `folder`; returns the manifest (name, n_records),
    landed. Only archives it names count. An empty table gives none; extra
    columns are ignored."""
    return land(plan_records(pages, min_bytes).mapInArrow(_write(folder), "name string, n_records long"), "archives")


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every
    record; response payloads are checked against their digests."""
    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(_read(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op5_warc_zstd(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    return read_warc(write_warc(table(spark, sf_dir, "pages"), folder), folder)


OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, lower(sha1(html)) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS kept, count(*) AS n FROM d WHERE payload_bytes >= {MIN_BYTES} GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN k.n > 1 AND d.page_id <> k.kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.n > 1 AND d.page_id <> k.kept THEN k.kept END AS refers_to
FROM d LEFT JOIN k ON d.payload_digest = k.payload_digest AND d.payload_bytes >= {MIN_BYTES}
"""
