"""Declared schemas of the telemetry data model.

Log data is never schema-inferred: every JSON level is parsed with one of the
explicit types below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the producers' wire format.
# ---------------------------------------------------------------------------
EVENT_LOG_TYPE = "glean-server-event"
EVENT_LOG_TYPE_PATTERN = "glean-server-event*"
DEFAULT_LOGGER = "glean"
JS_LOGGER_SUFFIX = "-glean"
UNKNOWN = "Unknown"
SDK_BUILD = "glean_parser v15.0.2.dev17+g81fec69a"
DOCUMENT_VERSION = "1"
ENV_VERSION = "2.0"
INFO_SEVERITY = 6
# End of fixed values.

CORRUPT_COL = "_corrupt_record"

PING_FIELDS = T.StructType([
    T.StructField("document_namespace", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("document_version", T.StringType()),
    T.StructField("document_id", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("payload", T.StringType()),
])

# `Timestamp` is a string on purpose: it is an epoch-ns string, an epoch-ns
# number or ISO-8601 text depending on the writer; StringType keeps the raw
# token text of numbers as well.
ENVELOPE = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Logger", T.StringType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Severity", T.LongType()),
    T.StructField("Pid", T.LongType()),
    T.StructField("EnvVersion", T.StringType()),
    T.StructField("Fields", PING_FIELDS),
])

# Envelope with `Fields` left as text: used by the loose (regex) filter where
# the type may carry any body (nested dicts, prefixed messages).
LOOSE_ENVELOPE = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Logger", T.StringType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Fields", T.StringType()),
])

CLIENT_INFO = T.StructType([
    T.StructField("telemetry_sdk_build", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("first_run_date", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("os_version", T.StringType()),
    T.StructField("architecture", T.StringType()),
    T.StructField("locale", T.StringType()),
    T.StructField("app_build", T.StringType()),
    T.StructField("app_display_version", T.StringType()),
    T.StructField("app_channel", T.StringType()),
])

PING_INFO = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
])

EVENT = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

METRICS = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))

PAYLOAD = T.StructType([
    T.StructField("client_info", CLIENT_INFO),
    T.StructField("ping_info", PING_INFO),
    T.StructField("metrics", METRICS),
    T.StructField("events", T.ArrayType(EVENT)),
])

PAYLOAD_WITH_CORRUPT = T.StructType(PAYLOAD.fields + [T.StructField(CORRUPT_COL, T.StringType())])

# The error table's columns in the warehouse order (43 strings,
# `payload` bytes, `submission_timestamp` timestamp).
ERROR_COLUMNS = [
    "args", "client_id", "content_length", "date", "dnt", "document_namespace",
    "document_type", "document_version", "error_message", "error_type",
    "exception_class", "geo_city", "geo_country", "geo_subdivision1",
    "geo_subdivision2", "host", "input", "input_type", "job_name", "method",
    "payload", "protocol", "remote_addr", "stack_trace", "stack_trace_cause_1",
    "stack_trace_cause_2", "stack_trace_cause_3", "stack_trace_cause_4",
    "stack_trace_cause_5", "submission_timestamp", "uri", "user_agent",
    "user_agent_browser", "user_agent_os", "user_agent_version", "x_debug_id",
    "x_forwarded_for", "x_pingsender_version", "x_pipeline_proxy", "isp_name",
    "isp_organization", "x_source_tags", "x_telemetry_agent",
    "x_foxsec_ip_reputation", "x_lb_tags",
]
# End of fixed values.

ERROR_SCHEMA = T.StructType([
    T.StructField(
        c,
        T.BinaryType() if c == "payload"
        else T.TimestampType() if c == "submission_timestamp"
        else T.StringType(),
    )
    for c in ERROR_COLUMNS
])

QUEUE_MESSAGE = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("required_paths", T.ArrayType(T.StringType())),
])

# Paths every Glean server ping must carry (the producers mark them
# required; the values are the server defaults).
_REQUIRED_COMMON = [
    "client_info",
    "client_info.telemetry_sdk_build",
    "client_info.first_run_date",
    "client_info.os",
    "client_info.os_version",
    "client_info.architecture",
    "client_info.app_build",
    "client_info.app_display_version",
    "client_info.app_channel",
    "ping_info",
    "ping_info.seq",
    "ping_info.start_time",
    "ping_info.end_time",
]

DEFAULT_REGISTRY_ROWS = [
    ("accounts-frontend", "events", "1", _REQUIRED_COMMON),
    ("accounts-frontend", "accounts-events", "1", _REQUIRED_COMMON + ["metrics"]),
    ("accounts-backend", "events", "1", _REQUIRED_COMMON),
]


def registry(spark: SparkSession, rows: list | None = None) -> DataFrame:
    """Document-type registry: (namespace, type, version, required_paths)."""
    return spark.createDataFrame(rows or DEFAULT_REGISTRY_ROWS, REGISTRY_SCHEMA)


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """All struct paths of a schema, parents before children."""
    out = []
    for f in schema.fields:
        p = f"{prefix}{f.name}"
        if f.name == CORRUPT_COL:
            continue
        out.append(p)
        if isinstance(f.dataType, T.StructType):
            out.extend(schema_paths(f.dataType, p + "."))
    return out
