"""Decode event records out of mixed log output and route them.

`decode(lines)` is one declarative plan, usable on a batch DataFrame or a
streaming one:

1. cheap substring pre-filter on the raw text (before any JSON parsing, so
   the scan of non-event lines costs one `contains`),
2. parse the envelope once (`from_json`, declared schema),
3. keep records whose `Type` is the event tag (exact, or a regex),
4. look the document type up in the registry (broadcast equi-join, size
   checked),
5. parse the payload text (second `from_json`, corrupt-record column),
6. validate required paths, set `error_type` / `error_message`.

Every event-typed input line yields exactly one output row; `decoded()` and
`errors()` are two filters of it. Callers writing both outputs persist the
routed frame once (see `sinks.live`).

Error types and their precedence (first that applies):
`bad_envelope` > `unknown_schema` > `bad_json` > `missing_field`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import times
from ..functions.ip import IPV4_REGEX
from ..functions.paths import destination_name
from .joins import Lookup, prepare_lookup

# Error types in precedence order, and their exception classes.
ERROR_TYPES = ["bad_envelope", "unknown_schema", "bad_json", "missing_field"]
EXCEPTION_CLASS = {
    "bad_envelope": "InvalidEnvelopeException",
    "unknown_schema": "SchemaNotFoundException",
    "bad_json": "MalformedPayloadException",
    "missing_field": "ValidationException",
}

DOC_KEYS = ["document_namespace", "document_type", "document_version"]


def event_type_match(type_col: Column, pattern: str | None) -> Column:
    """F1 (exact tag) or F2 (unanchored regex search on the tag)."""
    if pattern is None:
        return type_col == F.lit(S.EVENT_LOG_TYPE)
    return type_col.rlike(pattern)


def _pre_filter_text(pattern: str | None) -> str:
    # The literal part every matching tag must contain. For the default regex
    # `glean-server-event*` the trailing `t*` may be empty.
    if pattern is None:
        return S.EVENT_LOG_TYPE
    if pattern == S.EVENT_LOG_TYPE_PATTERN:
        return S.EVENT_LOG_TYPE[:-1]
    return ""


def parse_envelope(lines: DataFrame, value_col: str = "value", pattern: str | None = None,
                   keep=()) -> DataFrame:
    """Steps 1-3: filter and parse the envelope. Non-JSON text, JSON without
    the tag and other tags never reach decoding and are not errors (F3). A line
    that opens an object and holds the exact tag but is cut off is an event
    that was damaged: it stays, without fields, and becomes `bad_envelope`."""
    v = F.col(value_col)
    pre = _pre_filter_text(pattern)
    df = lines.filter(v.contains(pre)) if pre else lines
    # a filter moves below a projection, with the parser in it, and each line is parsed
    # twice; it stays above one that holds a column which is not deterministic
    df = df.select(*keep, v.alias("raw"), F.from_json(v, S.ENVELOPE).alias("_e"), F.spark_partition_id().alias("_part"))
    cut_off = F.col("_e.Type").isNull() & F.col("raw").startswith("{") & F.col("raw").contains(f'"{S.EVENT_LOG_TYPE}"') \
        & F.try_parse_json(F.col("raw")).isNull()
    is_event = F.coalesce(event_type_match(F.col("_e.Type"), pattern), F.lit(False)) | cut_off
    return df.filter((F.col("_part") >= 0) & is_event).drop("_part")


def _missing_paths(p: Column) -> Column:
    """Every path of the declared payload schema that is NULL in `p`, in
    schema order (NULL for the others): one null test per path, all inside
    generated code."""
    checks = []
    for path in S.schema_paths(S.PAYLOAD):
        c = p
        for part in path.split("."):
            c = c.getField(part)
        checks.append(F.when(c.isNull(), F.lit(path)))
    return F.array(*checks)


def decode(lines: DataFrame, registry: DataFrame | Lookup, *, value_col: str = "value",
           pattern: str | None = None, keep=(), received_col: str | None = None) -> DataFrame:
    """Routed rows: decoded columns plus `error_type` / `error_message` /
    `exception_class` (NULL for good rows) and the original line `raw`."""
    df = parse_envelope(lines, value_col, pattern, keep=list(keep) + ([received_col] if received_col else []))
    f = F.col("_e.Fields")
    df = df.select(
        *keep,
        *([received_col] if received_col else []),
        "raw",
        F.col("_e.Timestamp").alias("envelope_timestamp"),
        F.col("_e.Logger").alias("logger"),
        F.col("_e.Type").alias("log_type"),
        F.col("_e.Severity").alias("severity"),
        F.col("_e.Pid").alias("pid"),
        F.col("_e.EnvVersion").alias("env_version"),
        f.isNull().alias("_no_fields"),
        *[F.nullif(f.getField(k), F.lit("")).alias(k) for k in DOC_KEYS],
        F.nullif(f.getField("document_id"), F.lit("")).alias("document_id"),
        F.nullif(f.getField("user_agent"), F.lit("")).alias("user_agent"),
        F.nullif(f.getField("ip_address"), F.lit("")).alias("ip_address"),
        f.getField("payload").alias("payload"),
    )

    return route_documents(df, registry, keep=keep, received_col=received_col)


ROUTE_INPUT = ["raw", "envelope_timestamp", "logger", "log_type", "severity", "pid", "env_version",
               "_no_fields", *DOC_KEYS, "document_id", "user_agent", "ip_address", "payload"]


def registry_lookup(registry: DataFrame | Lookup) -> Lookup:
    """The registry as the routing join needs it, its size measured once."""
    if isinstance(registry, Lookup):
        return registry
    return prepare_lookup(registry.select(
        F.col("namespace").alias("document_namespace"),
        F.col("type").alias("document_type"),
        F.col("version").alias("document_version"),
        F.array_compact("required_paths").alias("_required"),
    ))


def route_documents(df: DataFrame, registry: DataFrame | Lookup, *, keep=(), received_col: str | None = None) -> DataFrame:
    """Steps 4-6 on split document columns (ROUTE_INPUT): shared by log
    lines and the batch decoder-input table."""
    # The payload is parsed and checked *before* the registry join: a filter
    # on the routing result (which reads the registry side too) then stays
    # above the join and sees parsed columns, instead of being pushed down
    # with the parser inlined into every reference.
    p = F.from_json(F.col("payload"), S.PAYLOAD_WITH_CORRUPT,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COL})
    df = df.withColumn("_p", p).withColumn("_missing", _missing_paths(F.col("_p")))

    df = df.join(registry_lookup(registry).side, DOC_KEYS, "left")
    # Required paths (registry order) that are missing in this payload.
    df = df.withColumn("_failing", F.array_intersect(F.col("_required"), F.col("_missing")))

    bad_env = F.col("_no_fields") | F.col("document_namespace").isNull() | F.col("document_type").isNull() \
        | F.col("document_version").isNull() | F.col("document_id").isNull() | F.col("payload").isNull()
    unknown = F.col("_required").isNull()
    bad_json = F.col("_p").isNull() | F.col("_p").getField(S.CORRUPT_COL).isNotNull()
    missing = F.size(F.col("_failing")) > 0
    df = df.withColumn("error_type", F.when(bad_env, "bad_envelope").when(unknown, "unknown_schema")
                       .when(bad_json, "bad_json").when(missing, "missing_field"))
    et = F.col("error_type")
    error_message = (
        F.when(et == "bad_envelope", F.lit("envelope has no complete Fields"))
        .when(et == "unknown_schema", F.concat(F.lit("no schema for "), F.concat_ws("/", *[F.coalesce(F.col(k), F.lit("")) for k in DOC_KEYS])))
        .when(et == "bad_json", F.lit("payload is not a JSON object of the declared schema"))
        .when(et == "missing_field", F.concat(F.lit("missing required field: "), F.element_at(F.col("_failing"), 1)))
    )
    exc = F.create_map(*[x for k, v in EXCEPTION_CLASS.items() for x in (F.lit(k), F.lit(v))])

    pl = F.col("_p")
    ok = et.isNull()
    df = df.select(
        *keep,
        *([received_col] if received_col else []),
        "raw", "logger", "log_type", "severity", "pid", "env_version",
        *DOC_KEYS, "document_id", "user_agent", "ip_address", "payload",
        F.coalesce(
            *([F.col(received_col).cast("timestamp")] if received_col else []),
            times.parse_timestamp(F.col("envelope_timestamp")),
            times.parse_timestamp(pl.getField("ping_info").getField("end_time")),
        ).alias("submission_timestamp"),
        F.when(ok, pl.getField("client_info")).alias("client_info"),
        F.when(ok, pl.getField("ping_info")).alias("ping_info"),
        F.when(ok, pl.getField("metrics")).alias("metrics"),
        F.when(ok, pl.getField("events")).alias("events"),
        et,
        error_message.alias("error_message"),
    )
    return df.withColumn("exception_class", exc[F.col("error_type")]) \
             .withColumn("destination", destination_name(*DOC_KEYS))


SOURCE_COLUMNS = ["raw", "payload", "ip_address"]


def decoded(routed: DataFrame, keep_source: bool = False) -> DataFrame:
    """Good rows, with normalised ping times; error columns dropped, and the
    source text and address with them (J7) unless a caller still enriches."""
    return (routed.filter(F.col("error_type").isNull())
            .drop("error_type", "error_message", "exception_class", *([] if keep_source else SOURCE_COLUMNS))
            .withColumn("start_time", times.parse_timestamp(F.col("ping_info.start_time")))
            .withColumn("end_time", times.parse_timestamp(F.col("ping_info.end_time"))))


# the member's name leads: Java's regex finds a literal start by skipping
ADDRESS_MEMBER = r'"ip_address"(\s*:\s*")([^"\\]*+(?:\\.[^"\\]*+)*+)'
ADDRESS_NAME = '"ip_address"'
# an address in a text: not inside a longer number or address
V4_BORDERS = r"(?<![0-9])(?<![0-9]\.)", r"(?![0-9])(?!\.[0-9])"
V6_BORDERS = r"(?<![0-9A-Fa-f.])(?<![0-9A-Fa-f]:)(?<![0-9A-Fa-f]::)", r"(?![0-9A-Fa-f:.])"
V6_TEXT = r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*(\.?[0-9]+){0,4}$"


def scrub_text(text, raw, address) -> Column:
    """`text` without the row's address, which in rows whose envelope could
    not be read is found in the source line by its member name. The member is
    blanked; elsewhere only a value that is an address goes, and only where it
    stands by itself."""
    # text that is not UTF-8 is mended by the regex, as ever
    blanked = F.when(text.contains(ADDRESS_NAME) | ~F.is_valid_utf8(text), F.regexp_replace(text, ADDRESS_MEMBER, ADDRESS_NAME + "$1")).otherwise(text)
    known = F.coalesce(F.nullif(address, F.lit("")), F.regexp_extract(raw, ADDRESS_MEMBER, 2), F.lit(""))
    quoted = F.concat(F.lit("\\Q"), known, F.lit("\\E"))
    pattern = F.when(known.rlike(IPV4_REGEX), F.concat(F.lit(V4_BORDERS[0]), quoted, F.lit(V4_BORDERS[1]))) \
        .when(known.rlike(V6_TEXT), F.concat(F.lit(V6_BORDERS[0]), quoted, F.lit(V6_BORDERS[1])))
    # a pattern of the row's own is compiled for the row: only where the address is left
    return F.when((known != "") & blanked.contains(known) & pattern.isNotNull(), F.regexp_replace(blanked, pattern, F.lit(""))).otherwise(blanked)


def errors(routed: DataFrame) -> DataFrame:
    """Error rows as the 45-column error table (V5); the original line is kept
    as bytes in `payload`, less the client's address; unknown columns are NULL."""
    e = routed.filter(F.col("error_type").isNotNull())
    return to_error_table(e)


def to_error_table(e: DataFrame) -> DataFrame:
    have = set(e.columns)
    cols = []
    for fld in S.ERROR_SCHEMA.fields:
        name = fld.name
        if name == "payload":
            c = F.col("raw") if dict(e.dtypes)["raw"] == "binary" else scrub_text(F.col("raw"), F.col("raw"), F.col("ip_address")) if "ip_address" in have else F.col("raw")
        elif name == "input_type":
            c = F.col("input_type") if name in have else F.lit("log")
        elif name == "date":
            c = F.date_format(F.col("submission_timestamp"), "yyyy-MM-dd")
        elif name == "remote_addr":
            c = F.lit(None)           # addresses are scrubbed after enrichment
        elif name in have:
            c = F.col(name)
        else:
            c = F.lit(None)
        cols.append(c.cast(fld.dataType).alias(name))
    return e.select(*cols)


def filter_event_records(lines: DataFrame, pattern: str | None = S.EVENT_LOG_TYPE_PATTERN,
                         value_col: str = "value", keep=()) -> DataFrame:
    """records whose tag matches `pattern` (any body shape). The body is
    kept as JSON text (`fields`) for the nested and prefixed variants."""
    v = F.col(value_col)
    pre = _pre_filter_text(pattern)
    df = lines.filter(v.contains(pre)) if pre else lines
    e = F.from_json(v, S.LOOSE_ENVELOPE)
    return (df.select(*keep, v.alias("raw"), e.alias("_e"))
            .filter(event_type_match(F.col("_e.Type"), pattern))
            .select(*keep, "raw",
                    F.col("_e.Type").alias("log_type"),
                    F.col("_e.Logger").alias("logger"),
                    times.parse_timestamp(F.col("_e.Timestamp")).alias("envelope_timestamp"),
                    F.col("_e.Fields").alias("fields")))


def event_body(fields_text) -> Column:
    """P18 + P19: `{timestamp, event_name}` from a nested body (`-from-dict`)
    or from the JSON tail of a prefixed `msg` (`-with-prefix`)."""
    from ..functions.jsontext import as_variant, json_suffix, variant_field

    v = as_variant(fields_text)
    msg = variant_field(v, "$.msg")
    inner = as_variant(json_suffix(msg))
    src = F.when(msg.isNotNull(), inner).otherwise(v)
    return F.struct(
        times.parse_timestamp(variant_field(src, "$.timestamp")).alias("event_time"),
        variant_field(src, "$.event_name").alias("event_name"),
    )
