"""Names and paths built from document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Submit path layout `/submit/<namespace>/<type>/<version>/<id>`.
SUBMIT_PATH_REGEX = r"^/submit/([^/]+)/([^/]+)/([^/]+)/([^/?#]+)$"
# End of fixed values.


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def destination_name(namespace, doc_type, version) -> Column:
    """`${namespace}_live.${type}_v${version}`, hyphens to underscores."""
    return F.concat(
        F.translate(_c(namespace), "-", "_"), F.lit("_live."),
        F.translate(_c(doc_type), "-", "_"), F.lit("_v"), _c(version),
    )


def submit_path(namespace, doc_type, version, doc_id) -> Column:
    return F.concat_ws("/", F.lit("/submit"), _c(namespace), _c(doc_type), _c(version), _c(doc_id))


def parse_submit_path(path) -> Column:
    """P20: struct of the four document keys, NULL when the path does not fit."""
    p = _c(path)
    ok = p.rlike(SUBMIT_PATH_REGEX)
    g = lambda i: F.when(ok, F.regexp_extract(p, SUBMIT_PATH_REGEX, i))
    return F.struct(g(1).alias("document_namespace"), g(2).alias("document_type"),
                    g(3).alias("document_version"), g(4).alias("document_id"))


def int_or_default(text, default: int) -> Column:
    """Integer text, or `default` when it is not an integer."""
    return F.coalesce(_c(text).try_cast("int"), F.lit(default))


def prefixed(header, text) -> Column:
    """Header + text (a NULL header counts as empty)."""
    return F.concat(F.coalesce(_c(header), F.lit("")), _c(text))
