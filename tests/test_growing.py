import os
import random
import tempfile
from pathlib import Path

import pytest

from lograft.sources import growing as G


def drain(spark, glob, base, most=1000, size=64 << 20):
    """One run of a stream that ends when it is up to date; all rows so far."""
    q = G.read_growing(spark, glob, most, size).writeStream.format("parquet").option("path", f"{base}/out") \
        .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    if not os.path.exists(f"{base}/out"):
        return []
    return sorted(r.value for r in spark.read.parquet(f"{base}/out").collect())


def add(path, text):
    with open(path, "ab") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_appended_lines_arrive_once(spark):
    """Appends, a restart between them, rotation, an unfinished and an over-long line."""
    base = tempfile.mkdtemp(prefix="lograft-grow-")
    os.mkdir(f"{base}/in")
    log = f"{base}/in/app.log"
    glob = f"{base}/in/app.log*"
    add(log, "one\ntwo\nthr")
    assert drain(spark, glob, base) == ["one", "two"]
    add(log, "ee\r\n")
    add(f"{base}/in/other.txt", "not matched\n")
    assert drain(spark, glob, base) == ["one", "three", "two"]
    assert drain(spark, glob, base) == ["one", "three", "two"]          # nothing new
    add(log, "last of the old\n" + "x" * 5000)                          # an open line that is too long
    os.rename(log, log + ".1")                                          # rotated, and written on for a while
    add(log, "first of the new\n")
    want = ["first of the new", "last of the old", "one", "three", "two"]
    assert drain(spark, glob, base) == want
    add(log + ".1", "y" * 5000 + "\nlate\n")
    add(log, "again\n")
    want = sorted([*want, "late", "again"])
    assert drain(spark, glob, base) == want
    os.rename(log + ".1", log + ".2")                                   # rotated twice
    os.rename(log, log + ".1")
    add(log, "newest\n")
    want = sorted([*want, "newest"])
    assert drain(spark, glob, base) == want
    with open(log, "w") as f:                                           # truncated in place
        f.write("anew\n")
    want = sorted([*want, "anew"])
    assert drain(spark, glob, base) == want
    assert drain(spark, glob, base) == want


def plan(glob, start, most, size):
    r = G.GrowingReader({"path": glob, "maxlinebytes": str(most), "rangebytes": str(size)})
    end = r.latestOffset()
    rows = []
    for p in r.partitions(start, end):
        for b in r.read(p):
            rows += list(zip(b.column("at").to_pylist(), b.column("value").to_pylist()))
    return end, rows


@pytest.mark.parametrize("size,chunk", [(1, 7), (13, 5), (50, 3), (10**6, 1 << 20)])
def test_ranges_and_chunks_of_any_size(monkeypatch, size, chunk):
    """Every line once, with its place, however a range is cut into partitions."""
    monkeypatch.setattr(G, "CHUNK", chunk)
    r = random.Random(size)
    folder = tempfile.mkdtemp(prefix="lograft-grow-")
    path, start, got, written = f"{folder}/a.log", {}, [], b""
    for _ in range(12):
        for _ in range(r.randrange(4)):
            written += (f"id{len(written)} " + "z" * r.choice([0, 1, 5, 30, 41, 60, 200]) + r.choice(["\n", "\n", ""])).encode()
        Path(path).write_bytes(written)
        end, rows = plan(f"{folder}/*.log", start, 40, size)
        assert rows == plan(f"{folder}/*.log", start, 40, size)[1]        # a replayed batch has the same rows
        got += rows
        start = end or start
    want, at = [], 0
    for line in written.split(b"\n")[:-1]:
        if len(line) <= 40:
            want.append((at, line.decode()))
        at += len(line) + 1
    assert got == want


def test_long_line_is_never_held(monkeypatch):
    """30 MB without a line end: at most the limit and a chunk are in memory."""
    path = f"{tempfile.mkdtemp(prefix='lograft-grow-')}/a.log"
    add(path, b"a\n" + b"x" * (30 << 20) + b"\nb\n")
    held = []

    class Watch:
        def __init__(self, f):
            self.f = f

        def seek(self, n):
            self.f.seek(n)

        def read(self, n):
            held.append(n)
            return self.f.read(n)

    with open(path, "rb") as f:
        got = [x for _, x in G.lines(Watch(f), 0, 1 << 40, os.path.getsize(path), 10 << 20, False)]
    assert got == [b"a", b"b"] and max(held) <= G.CHUNK


def test_rotation_between_plan_and_read():
    folder = tempfile.mkdtemp(prefix="lograft-grow-")
    add(f"{folder}/a.log", "one\ntwo\n")
    r = G.GrowingReader({"path": f"{folder}/a.log*"})
    parts = r.partitions({}, r.latestOffset())
    os.rename(f"{folder}/a.log", f"{folder}/a.log.1")
    add(f"{folder}/a.log", "three\n")
    assert [b.column("value").to_pylist() for p in parts for b in r.read(p)] == [["one", "two"]]
