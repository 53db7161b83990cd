"""Batch path: raw log table -> decoder input table -> the same routing.

The raw log table is what a log sink writes: `timestamp` (receive time) and
`jsonPayload` with lower-case `type` / `fields` (the sink's spelling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import decode as D
from ..operators.joins import Lookup


def raw_log_table(lines: DataFrame, received_col: str, value_col: str = "value") -> DataFrame:
    """S7 shape from log lines: event-typed or not, every JSON record."""
    e = F.from_json(F.col(value_col), S.ENVELOPE)
    return lines.select(
        F.col(received_col).cast("timestamp").alias("timestamp"),
        F.struct(e.getField("Type").alias("type"), e.getField("Fields").alias("fields")).alias("jsonPayload"),
    ).filter(F.col("jsonPayload.type").isNotNull())


def prepare_decoder_input(raw: DataFrame, since: str, namespace_override: str | None = None) -> DataFrame:
    """Project, override the namespace, payload text -> bytes;
    time lower bound and type equality."""
    f = F.col("jsonPayload.fields")
    ns = F.lit(namespace_override) if namespace_override else f.getField("document_namespace")
    return (raw.filter((F.col("timestamp") >= F.lit(since).cast("timestamp"))
                       & (F.col("jsonPayload.type") == S.EVENT_LOG_TYPE))
            .select(F.col("timestamp").alias("submission_timestamp"),
                    f.getField("document_id").alias("document_id"),
                    ns.alias("document_namespace"),
                    f.getField("document_type").alias("document_type"),
                    f.getField("document_version").alias("document_version"),
                    f.getField("payload").cast("binary").alias("payload")))


def decode_input_table(inp: DataFrame, registry: DataFrame | Lookup) -> DataFrame:
    """Routed rows from the decoder input table (batch decoder). The payload
    bytes stay as they are; bytes that are not UTF-8 are `bad_json`."""
    text = F.col("payload").cast("string")
    df = inp.select(
        F.col("payload").alias("raw"),
        F.col("submission_timestamp").cast("string").alias("envelope_timestamp"),
        *[F.lit(None).cast(t).alias(c) for c, t in
          [("logger", "string"), ("log_type", "string"), ("severity", "bigint"), ("pid", "bigint"),
           ("env_version", "string")]],
        F.lit(False).alias("_no_fields"),
        *[F.nullif(F.col(k), F.lit("")).alias(k) for k in D.DOC_KEYS],
        F.nullif(F.col("document_id"), F.lit("")).alias("document_id"),
        F.lit(None).cast("string").alias("user_agent"), F.lit(None).cast("string").alias("ip_address"),
        F.when(F.is_valid_utf8(text), text).when(text.isNotNull(), F.lit("")).alias("payload"),
    )
    return D.route_documents(df, registry).withColumn("input_type", F.lit("table"))
