"""Timestamp text forms found in log records, both directions.

Parsing covers every form the producers write: epoch digits (unit named by
the caller, nanoseconds unless told; string or JSON number), ISO-8601 / RFC 3339 with fractions of any length and
`Z` or an offset, minute precision with an offset, and CLF / syslog text.
All built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mmXXX"
CLF_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
SYSLOG_FORMAT = "yyyy MMM d HH:mm:ss"
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_instant(c) -> Column:
    """TIMESTAMP (with the session zone, UTC) from TIMESTAMP or TIMESTAMP_NTZ."""
    return _c(c).cast("timestamp")


_LAST_MICROS = 253402300799999999     # 9999-12-31T23:59:59.999999Z


def epoch_to_timestamp(digits: Column, unit: str = "ns") -> Column:
    """Epoch digits in the unit the caller names (s, ms, us, ns) to a timestamp
    with µs precision. More than 19 digits, or a time past the year 9999: NULL."""
    v = F.when(digits.rlike("^[0-9]{1,19}$"), digits).try_cast("bigint")
    k = {"s": 1_000_000, "ms": 1_000, "us": 1}
    micros = F.call_function("div", v, F.lit(1000).cast("bigint")) if unit == "ns" else F.try_multiply(v, F.lit(k[unit]).cast("bigint"))
    return F.timestamp_micros(F.when(micros <= _LAST_MICROS, micros))


def parse_timestamp(c, unit: str = "ns") -> Column:
    """Any producer timestamp text (or number, in `unit`) to TIMESTAMP; NULL if
    none fits. Text needs a date part: a bare time of day is not a timestamp."""
    s = F.trim(_c(c).cast("string"))
    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("timestamp"))
        .when(s.rlike("^[0-9]+$"), epoch_to_timestamp(s, unit))
        .when(s.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), F.coalesce(
            s.try_cast("timestamp"),
            F.try_to_timestamp(s, F.lit(MINUTE_OFFSET_FORMAT)),
        ))
    )


def text_nanos(c) -> Column:
    """Order value of an ISO-8601 text in nanoseconds (bigint): the µs that a
    TIMESTAMP holds plus the three digits it cuts off. NULL if unparsed."""
    s = F.trim(_c(c).cast("string"))
    rest = F.substring(F.rpad(F.regexp_extract(s, r"\.([0-9]{1,9})", 1), 9, "0"), 7, 3).cast("bigint")
    return F.unix_micros(parse_timestamp(s)) * 1000 + rest


def parse_date(c) -> Column:
    """Date text, also with a trailing offset (`2023-06-23+02:00`)."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(s.try_cast("date"), F.substring(s, 1, 10).try_cast("date"))


def parse_clf_time(c) -> Column:
    """`10/Oct/2000:13:55:36 -0700` (apache, nginx, json parsers)."""
    return F.try_to_timestamp(_c(c), F.lit(CLF_FORMAT))


def parse_syslog_time(c, year) -> Column:
    """`Jan  5 12:00:01` has no year: the caller names it; spaces squeezed."""
    y = year if isinstance(year, Column) else F.lit(str(year))
    squeezed = F.regexp_replace(F.trim(_c(c)), " +", " ")
    return F.try_to_timestamp(F.concat_ws(" ", y.cast("string"), squeezed), F.lit(SYSLOG_FORMAT))


# --- writing -----------------------------------------------------------------

def epoch_nanos(c) -> Column:
    return F.unix_micros(as_instant(c)) * F.lit(1000)


def epoch_millis(c) -> Column:
    return F.unix_millis(as_instant(c))


def iso_millis_z(c) -> Column:
    """JavaScript `toISOString` / Go `2006-01-02T15:04:05.000Z`."""
    return F.date_format(as_instant(c), ISO_MILLIS_Z)


def _micros_of_second(c) -> Column:
    return F.pmod(F.unix_micros(as_instant(c)), F.lit(1000000))


def python_isoformat(c) -> Column:
    """`datetime.isoformat()` of an aware UTC value: fraction only when non-zero."""
    t = as_instant(c)
    return F.when(
        _micros_of_second(c) == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    ).otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def rfc3339_auto(c) -> Column:
    """RFC 3339 with the shortest of 0, 3 or 6 fraction digits and `+00:00`."""
    t = as_instant(c)
    us = _micros_of_second(c)
    return (
        F.when(us == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(F.pmod(us, F.lit(1000)) == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
    )


def minute_offset(c, offset_hours: int = -5) -> Column:
    """Minute precision in a fixed offset zone, e.g. `2023-06-22T11:28-05:00`."""
    sign = "-" if offset_hours < 0 else "+"
    off = f"{sign}{abs(offset_hours):02d}:00"
    local = as_instant(c) + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(offset_hours))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm"), F.lit(off))


def clf_time(c) -> Column:
    return F.date_format(as_instant(c), "dd/MMM/yyyy:HH:mm:ss '+0000'")


def syslog_time(c) -> Column:
    """`MMM d HH:mm:ss` with the day padded by a space to width 2 (RFC 3164)."""
    t = as_instant(c)
    day = F.dayofmonth(t)
    pad = F.when(day < 10, F.lit(" ")).otherwise(F.lit(""))
    return F.concat(F.date_format(t, "MMM"), F.lit(" "), pad, day.cast("string"),
                    F.lit(" "), F.date_format(t, "HH:mm:ss"))
