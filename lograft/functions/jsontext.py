"""JSON found in odd places of log records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_SUFFIX_REGEX = r"\{.*\}$"     # the JSON object at the end of a free-text message


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_suffix(msg) -> Column:
    """`some-string {...}` -> `{...}`; NULL when there is none."""
    m = _c(msg)
    return F.when(m.rlike(JSON_SUFFIX_REGEX), F.regexp_extract(m, JSON_SUFFIX_REGEX, 0))


def as_variant(text) -> Column:
    """JSON text -> VARIANT, NULL when not JSON."""
    return F.try_parse_json(_c(text))


def variant_field(v: Column, path: str, type_: str = "string") -> Column:
    return F.try_variant_get(v, path, type_)


def json_object_or_null(text) -> Column:
    """VARIANT of the text only when it is a JSON object (J2 keeps objects): text
    that opens none is not parsed."""
    return F.when(F.ltrim(_c(text), F.lit(" \t\r\n")).startswith("{"), as_variant(text))
