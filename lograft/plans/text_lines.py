"""Text log lines derived from `events`, one line per event in a given
format, carrying `event_id` as the line key and the year of the line (the
year a syslog line omits, as known from its file's date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from . import event_lines as L

FORMAT_CYCLE = ["apache", "apache2", "apache_error", "nginx", "syslog", "json", "none"]


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _fields():
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    s = lambda c: c.cast("string")
    return {
        "host": L.address_of(uid, eid),
        "user": F.when(eid % 6 == 0, F.lit("-")).otherwise(F.concat(F.lit("u"), s(uid))),
        "method": _pick(["GET", "POST", "PUT", "DELETE"], eid % 4),
        "path": F.when(eid % 10 == 1, F.concat(F.lit("/"), et, F.lit(" x/"), s(eid)))
                 .otherwise(F.concat(F.lit("/"), et, F.lit("/"), s(eid), F.lit("?u="), s(uid))),
        "path2": F.concat(F.lit("/"), et, F.lit("/"), s(eid)),
        "code": _pick(["200", "301", "404", "500"], uid % 4),
        "size": s(eid * 7 % 5000),
        "tail": F.when(eid % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit(' "http://example.com/'), et, F.lit('" "'), L.user_agent_of(uid), F.lit('"'))),
        "clf": times.clf_time(F.col("ts")),
        "vhost": F.concat(F.lit("svc"), s(uid % 5), F.lit(".example.com")),
        "level": _pick(["error", "warn", "notice", "info"], eid % 4),
        "pid": s(uid * 13 % 30000),
        "message": F.concat(et, F.lit(" by user "), s(uid)),
    }


def line_of(fmt: str) -> Column:
    f = _fields()
    eid = F.col("event_id")
    request = lambda path: F.concat(F.lit('"'), f["method"], F.lit(" "), path, F.lit(' HTTP/1.1" '),
                                    f["code"], F.lit(" "), f["size"], f["tail"])
    if fmt == "apache":
        return F.concat(f["host"], F.lit(" - "), f["user"], F.lit(" ["), f["clf"], F.lit("] "), request(f["path"]))
    if fmt == "apache2":
        return F.concat(f["host"], F.lit(" - "), f["user"], F.lit(" ["), f["clf"], F.lit("] "), request(f["path2"]))
    if fmt == "nginx":
        return F.concat(f["host"], F.lit(" "), f["vhost"], F.lit(" "), f["user"], F.lit(" ["), f["clf"], F.lit("] "),
                        request(f["path"]))
    if fmt == "apache_error":
        return F.concat(
            F.lit("["), F.date_format(times.as_instant("ts"), "EEE MMM dd HH:mm:ss yyyy"), F.lit("] ["),
            f["level"], F.lit("]"),
            F.when(eid % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" [pid "), f["pid"], F.lit("]"))),
            F.when(eid % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(" [client "), f["host"], F.lit("]"))),
            F.lit(" "), f["message"])
    if fmt == "syslog":
        return F.concat(
            F.lit("<"), (eid % 192).cast("string"), F.lit(">"), times.syslog_time("ts"), F.lit(" node"),
            (F.col("user_id") % 10).cast("string"), F.lit(" svc-"), F.col("event_type"),
            F.when(eid % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("["), f["pid"], F.lit("]"))),
            F.lit(": "), f["message"])
    if fmt == "json":
        head = F.to_json(F.struct(f["clf"].alias("time"), f["user"].alias("user"),
                                  F.col("event_type").alias("event")))
        return F.concat(F.substring_index(head, "}", 1), F.lit(', "props": '), F.col("props"), F.lit("}"))
    return F.concat(F.lit("unstructured line "), eid.cast("string"))


def events_to_text_lines(events: DataFrame, fmt: str) -> DataFrame:
    """(event_id, year, value) in one format; `fmt='mixed'` cycles through
    FORMAT_CYCLE by `event_id % 7` and adds the `format` column."""
    year = F.year(times.as_instant("ts"))
    if fmt != "mixed":
        return events.select("event_id", year.alias("year"), line_of(fmt).alias("value"))
    idx = F.col("event_id") % len(FORMAT_CYCLE)
    value = None
    for i, f in enumerate(FORMAT_CYCLE):
        value = F.when(idx == i, line_of(f)) if value is None else value.when(idx == i, line_of(f))
    return events.select("event_id", year.alias("year"), _pick(FORMAT_CYCLE, idx).alias("format"),
                         value.alias("value"))
