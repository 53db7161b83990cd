"""Text log formats -> typed columns.

Each regex format is a pattern plus the group number of every named field. A
line is matched once: the match is rewritten to its fields, separated, and split
(an absent optional group is empty, hence NULL). The separator is escaped in the
line first, so no content can shift a field. All formats return one struct
type (the union of their fields), so a per-record choice of parser picks the
pattern, not the struct. Unmatched lines are kept, with NULL fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.ip import let

# The parser patterns of the log agent configuration.
APACHE = r'^(?<host>[^ ]*) [^ ]* (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)?" (?<code>[^ ]*) (?<size>[^ ]*)(?: "(?<referer>[^\"]*)" "(?<agent>[^\"]*)")?$'
APACHE2 = r'^(?<host>[^ ]*) [^ ]* (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^ ]*) +\S*)?" (?<code>[^ ]*) (?<size>[^ ]*)(?: "(?<referer>[^\"]*)" "(?<agent>[^\"]*)")?$'
APACHE_ERROR = r'^\[[^ ]* (?<time>[^\]]*)\] \[(?<level>[^\]]*)\](?: \[pid (?<pid>[^\]]*)\])?( \[client (?<client>[^\]]*)\])? (?<message>.*)$'
NGINX = r'^(?<remote>[^ ]*) (?<host>[^ ]*) (?<user>[^ ]*) \[(?<time>[^\]]*)\] "(?<method>\S+)(?: +(?<path>[^\"]*?)(?: +\S*)?)?" (?<code>[^ ]*) (?<size>[^ ]*)(?: "(?<referer>[^\"]*)" "(?<agent>[^\"]*)")?$'
SYSLOG = r'^\<(?<pri>[0-9]+)\>(?<time>[^ ]* {1,2}[^ ]* [^ ]*) (?<host>[^ ]*) (?<ident>[a-zA-Z0-9_\/\.\-]*)(?:\[(?<pid>[0-9]+)\])?(?:[^\:]*\:)? *(?<message>.*)$'
# End of fixed values.

# Group numbers of the named fields, counting every capturing group.
FORMATS: dict[str, tuple[str, dict[str, int]]] = {
    "apache": (APACHE, {"host": 1, "user": 2, "time": 3, "method": 4, "path": 5,
                        "code": 6, "size": 7, "referer": 8, "agent": 9}),
    "apache2": (APACHE2, {"host": 1, "user": 2, "time": 3, "method": 4, "path": 5,
                          "code": 6, "size": 7, "referer": 8, "agent": 9}),
    "apache_error": (APACHE_ERROR, {"time": 1, "level": 2, "pid": 3, "client": 5, "message": 6}),
    "nginx": (NGINX, {"remote": 1, "host": 2, "user": 3, "time": 4, "method": 5, "path": 6,
                      "code": 7, "size": 8, "referer": 9, "agent": 10}),
    "syslog": (SYSLOG, {"pri": 1, "time": 2, "host": 3, "ident": 4, "pid": 5, "message": 6}),
}
CLF_TIME_FORMATS = {"apache", "apache2", "nginx", "json"}
FIELDS = ["remote", "host", "user", "time", "method", "path", "code", "size", "referer",
          "agent", "level", "pid", "client", "pri", "ident", "message"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A matched line is rewritten once to its fields in FIELDS order, each after a
# separator; an unmatched one comes back as it is and lacks the marker. In the
# line, separator and escape sign become two signs; no pattern names any of them,
# and no escaped line holds the separator or the marker.
_SEP, _ESC, _MARK = "\x01", "\x02", "\x02\x03\x02"
_AS_ESC, _AS_SEP = "\x02\x03", "\x02\x04"


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_ESC), F.lit(_AS_ESC)), F.lit(_SEP), F.lit(_AS_SEP))


def _plain(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_AS_SEP), F.lit(_SEP)), F.lit(_AS_ESC), F.lit(_ESC))


def _rewritten(line: Column, fmt: str) -> Column:
    pattern, groups = FORMATS[fmt]
    return F.regexp_replace(_escaped(line), F.lit(pattern), F.lit(_MARK + "".join(_SEP + (f"${groups[n]}" if n in groups else "") for n in FIELDS)))


def _json_object(line: Column) -> Column:
    v = F.try_parse_json(line)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def _fields(rewritten: Column, fmt: Column, year: Column | None, record: Column) -> Column:
    """Struct of all FIELDS + `ts` + `record` from a rewritten line; the split is
    bound once."""
    def on_parts(p):
        ok = F.element_at(p, 1) == _MARK
        value = {n: F.when(ok, F.nullif(_plain(F.get(p, F.lit(i))), F.lit(""))) for i, n in enumerate(FIELDS, 1)}
        t = value["time"]
        ts = F.when(fmt.isin(*sorted(CLF_TIME_FORMATS)), times.parse_clf_time(t))
        if year is not None:
            ts = ts.when(fmt == "syslog", times.parse_syslog_time(t, year))
        return F.struct(*[value[n].alias(n) for n in FIELDS], ts.alias("ts"), record.alias("record"))     # apache_error: no time format

    return let(F.split(rewritten, _SEP), on_parts)


def parse_by_format(line, fmt_col, year=None, formats=tuple(FORMATS) + ("json",)) -> Column:
    """Parser chosen per record by a format column; unknown format or no
    match -> struct of NULLs (the line itself is kept by the caller). One regex
    run per line."""
    line, fmt = _c(line), _c(fmt_col)
    obj = F.when(fmt == "json", _json_object(line)) if "json" in formats else F.lit(None).cast("variant")
    out = F.when(F.lit(False), line)
    for f in formats:
        if f == "json":
            at = FIELDS.index("time")
            t = F.try_variant_get(obj, "$.time", "string")
            new = F.when(t.isNotNull(), F.concat(F.lit(_MARK + _SEP * (at + 1)), _escaped(t), F.lit(_SEP * (len(FIELDS) - at - 1)))).otherwise(F.lit(""))
        else:
            new = _rewritten(line, f)
        out = out.when(fmt == f, new)
    return _fields(out, fmt, _c(year) if year is not None else None, obj)


def parse_format(line, fmt: str, year=None) -> Column:
    """Struct of all FIELDS (strings) + `ts` for one format; every field NULL
    when the line does not match. For `json` (T5) the record is kept as VARIANT."""
    return parse_by_format(line, F.lit(fmt), year, (fmt,))


def parse_lines(df: DataFrame, fmt: str, line_col: str = "value", year=None) -> DataFrame:
    """DataFrame-level T1-T7: the line's fields as top-level columns."""
    p = parse_format(line_col, fmt, year)
    return df.withColumn("_parsed", p).select("*", "_parsed.*").drop("_parsed")


def parse_docker(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Container JSON lines -> `log`, `stream`, `time` (kept as text),
    `ts` (parsed) and `n` (order value in ns). A line that is not such a record
    keeps its text as `log`, without a time."""
    rec = F.from_json(_c(line_col), "log string, stream string, time string")
    return (df.withColumn("_r", rec)
            .select("*", F.when(F.col("_r.log").isNull() & F.col("_r.time").isNull(), _c(line_col)).otherwise(F.col("_r.log")).alias("log"),
                    F.col("_r.stream").alias("stream"), F.col("_r.time").alias("time"),
                    times.parse_timestamp(F.col("_r.time")).alias("ts"), times.text_nanos(F.col("_r.time")).alias("n"))
            .drop("_r"))
