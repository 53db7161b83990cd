import random

import pytest
from pyspark.sql import functions as F

from lograft.operators.flatten import flatten_metrics
from lograft.operators.recombine import recombine_lines
from lograft.sources.textlogs import parse_docker


def brute(rows):
    out, cur = [], {}
    for f, n, t in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0], r[1], r[2] or "")):
        cur.setdefault(f, []).append(t or "")
        if (t or "").endswith("\n"):
            out.append((f, "".join(cur.pop(f))))
    out += [(f, "".join(p)) for f, p in cur.items()] + [(f, t) for f, n, t in rows if n is None]
    return sorted(out, key=str)


def messages(df, **kw):
    return sorted(((r.f, r.message) for r in recombine_lines(df, "f", "n", "log", **kw).collect()), key=str)


def test_recombine_matches_brute_force(spark):
    rows = [("a", 1, "hel"), ("a", 2, "lo\n"), ("a", 3, "x\n"), ("a", 10, "tail"), ("a", 11, " end"),
            ("b", 5, "one"), ("b", 7, " two\n"), ("b", 9, "3\n"), ("b", 9, "2"), ("b", None, "not a record"), ("c", None, "two\n"), ("c", 4, None), ("c", 5, "z\n")]
    r = random.Random(1)
    rows += [("d", r.randrange(10**6), r.choice(["p", "q", "r\n"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "f string, n long, log string")
    for width in (1, 2, 100, 10**9):
        assert messages(df, chunk_width=width) == brute(rows)
    assert messages(df.limit(0)) == []


def test_unterminated_file_comes_out_in_pieces(spark):
    rows = [("a", i, f"part{i:03d};") for i in range(95)]
    df = spark.createDataFrame(rows, "f string, n long, log string")
    got = sorted(recombine_lines(df, "f", "n", "log", chunk_width=20, max_parts=7, max_bytes=100).collect(), key=lambda r: r.piece)
    assert len(got) > 5 and [r.piece for r in got] == list(range(len(got)))
    assert "".join(r.message for r in got) == "".join(t for _, _, t in rows) and sum(r.parts for r in got) == 95


def test_nanosecond_order(spark):
    t = "2024-01-01T00:00:00.000000{:03d}Z"
    lines = [("a", f'{{"log":"{x}","stream":"stdout","time":"{t.format(n)}"}}') for n, x in [(2, "b"), (1, "z"), (3, "c\\n"), (999, "next\\n")]]
    p = parse_docker(spark.createDataFrame(lines, "f string, value string"))
    assert messages(p) == [("a", "next\n"), ("a", "zbc\n")]


def test_flatten_collision_raises(spark):
    df = spark.createDataFrame([({"string": {"account.user_id_sha256": "x"}},)], "metrics map<string,map<string,string>>")
    with pytest.raises(ValueError):
        flatten_metrics(df, {"string": ["account.user_id_sha256", "account.user.id_sha256"]})
    out = flatten_metrics(df, {"string": ["account.user_id_sha256"]}).first()
    assert out.account_user_id_sha256 == "x"
