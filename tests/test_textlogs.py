import re
from datetime import datetime

from pyspark.sql import functions as F

from lograft.sources import textlogs as TL

LINES = [
    ("apache", '192.168.0.1 - frank [10/Oct/2000:13:55:36 -0700] "GET /a b.gif HTTP/1.0" 200 2326 "http://x/" "Agent/1.0"'),
    ("apache2", '192.168.0.1 - - [10/Oct/2000:13:55:36 -0700] "GET /a.gif HTTP/1.0" 200 2326'),
    ("apache_error", "[Wed Oct 11 14:32:52 2000] [error] [client 127.0.0.1] client denied by server configuration"),
    ("apache_error", "[Wed Oct 11 14:32:52 2000] [error] [pid 12] no client here"),
    ("nginx", '10.0.0.1 example.com - [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.1" 404 0 "-" "curl/8"'),
    ("syslog", "<34>Jan  5 12:00:01 myhost sshd[42]: Accepted password"),
    ("json", '{"time": "10/Oct/2000:13:55:36 -0700", "k": 1}'),
    ("apache", "not a log line"),
]


def test_formats(spark):
    df = spark.createDataFrame(LINES, "format string, value string")
    p = TL.parse_by_format(F.col("value"), F.col("format"), year=F.lit(2024))
    rows = df.select(p.alias("p")).collect()
    a = rows[0].p
    assert (a.host, a.user, a.method, a.path, a.code, a.size, a.agent) == \
        ("192.168.0.1", "frank", "GET", "/a b.gif", "200", "2326", "Agent/1.0")
    assert a.ts == datetime(2000, 10, 10, 20, 55, 36)
    assert rows[1].p.path == "/a.gif" and rows[1].p.referer is None
    assert (rows[2].p.level, rows[2].p.client, rows[2].p.message) == \
        ("error", "127.0.0.1", "client denied by server configuration")
    assert rows[3].p.client is None and rows[3].p.pid == "12"
    assert (rows[4].p.remote, rows[4].p.host, rows[4].p.code) == ("10.0.0.1", "example.com", "404")
    s = rows[5].p
    assert (s.pri, s.host, s.ident, s.pid, s.message) == ("34", "myhost", "sshd", "42", "Accepted password")
    assert s.ts == datetime(2024, 1, 5, 12, 0, 1)
    assert rows[6].p.ts == datetime(2000, 10, 10, 20, 55, 36)
    assert rows[7].p.host is None and rows[7].p.ts is None


def test_no_content_shifts_a_field(spark):
    """Control characters anywhere: every field as the pattern itself gives it."""
    signs = ["\x01", "\x02", "\x03", "\x04", "\x02\x03", "\x02\x04", "\x01\x03", "\x02\x03\x02", "\x02\x03\x02\x01", "\x00", "$1", "\\1", "\x07"]
    rows = []
    for s in signs:
        rows += [("apache", f'h{s}h - u{s} [10/Oct/2000:13:55:36 -0700] "GET /a{s}b HTTP/1.0" 200 23{s} "r{s}r" "{s}A{s}"', s),
                 ("nginx", f'r{s} h{s} u{s} [t{s}] "G{s} /{s}{s} x" {s}4 {s} "{s}" "a{s}"', s),
                 ("apache_error", f"[Wed t{s}] [l{s}] [pid 1{s}] [client c{s}] m{s}{s}m", s),
                 ("syslog", f"<34>Jan 5 {s}12 host{s} id{s}[42]: message{s}", s),
                 ("apache", f"{s}no match{s}", s)]
    got = spark.createDataFrame(rows, "format string, value string, s string") \
        .select("format", "value", TL.parse_by_format(F.col("value"), F.col("format"), year=F.lit(2024)).alias("p")).collect()
    for r in got:
        pattern, groups = TL.FORMATS[r.format]
        m = re.match(pattern.replace("(?<", "(?P<"), r.value, re.DOTALL)
        for name in TL.FIELDS:
            want = (m.group(groups[name]) or None) if m and name in groups else None
            assert r.p[name] == want, (r.format, r.value, name)
