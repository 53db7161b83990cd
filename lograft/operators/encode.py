"""Producer side, as a table job: rows of events -> serialised log records.

Each producer writes one JSON line per call: an envelope whose `Fields` hold a
ping, whose `payload` is the JSON text of the telemetry payload (so it is
escaped inside the line). Here every row of a DataFrame becomes one such line,
built only from `struct` / `map` / `array` / `to_json`: no Python per row.

Dialects of the envelope (the `dialect` column or literal):

* ``js``     - the JSON envelope of the JavaScript server logger: Timestamp epoch-ns number, Logger `<app>-glean`,
               Severity, Pid, EnvVersion; ping times `toISOString`.
* ``python`` - Timestamp ISO-8601 (aware UTC), Logger `glean`.
* ``go``     - Timestamp epoch-ns string, Logger `glean`, empty user agent /
               address left out; ping times millis + `Z`.
* ``rust``   - no Timestamp and no Logger; empty user agent / address written
               as `""`; ping times RFC 3339.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import times

DIALECTS = ("js", "python", "go", "rust")


def _c(c) -> Column:
    if c is None:
        return F.lit(None).cast("string")
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def document_id_from_key(key) -> Column:
    """Repeatable UUID-shaped id (8-4-4-4-12 hex) from a key: md5 of its text."""
    h = F.md5(_c(key).cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def random_document_id() -> Column:
    return F.expr("uuid()")


def ping_time_text(ts, dialect) -> Column:
    """`ping_info` start/end time in the text form of each dialect."""
    d = _lit(dialect)
    return (
        F.when(d == "python", times.python_isoformat(ts))
        .when(d == "rust", times.rfc3339_auto(ts))
        .otherwise(times.iso_millis_z(ts))
    )


def glean_event(category, name, ts, extra: Column) -> Column:
    """One event: category, name, epoch-ms timestamp, string extras."""
    return F.struct(
        _lit(category).cast("string").alias("category"),
        _lit(name).cast("string").alias("name"),
        times.epoch_millis(ts).alias("timestamp"),
        extra.alias("extra"),
    )


def extras(**pairs) -> Column:
    """Extras map; values become text (P14), NULL values are left out."""
    kv = F.map_from_arrays(
        F.array(*[F.lit(k) for k in pairs]),
        F.array(*[_c(v).cast("string") for v in pairs.values()]),
    )
    return F.map_filter(kv, lambda k, v: v.isNotNull())


def object_update_event(ts, object_type, object_state, linking=None) -> Column:
    """`backend` / `object_update` event (E3). `linking` may be a boolean or
    text column; absent (None) leaves the key out."""
    pairs = {"object_type": object_type, "object_state": object_state}
    if linking is not None:
        pairs["linking"] = linking
    return glean_event("backend", "object_update", ts, extras(**pairs))


def client_info(app_version, channel, build: str = S.SDK_BUILD) -> Column:
    u = F.lit(S.UNKNOWN)
    return F.struct(
        F.lit(build).alias("telemetry_sdk_build"),
        u.alias("first_run_date"), u.alias("os"), u.alias("os_version"),
        u.alias("architecture"), u.alias("app_build"),
        _lit(app_version).cast("string").alias("app_display_version"),
        _lit(channel).cast("string").alias("app_channel"),
    )


def ping_info(ts, dialect, seq=0) -> Column:
    t = ping_time_text(ts, dialect)
    return F.struct(_lit(seq).cast("bigint").alias("seq"), t.alias("start_time"), t.alias("end_time"))


def payload_json(*, metrics: Column | None, events: Column | None, ts, dialect,
                 app_version, channel, include_client_info: Column | bool = True) -> Column:
    """Payload JSON text. `events=None` leaves the key out (accounts-events);
    `include_client_info` may be a boolean column (rows without it are the
    negative inputs of validation)."""
    parts = []
    if metrics is not None:
        parts.append(metrics.alias("metrics"))
    if events is not None:
        parts.append(events.alias("events"))
    parts.append(ping_info(ts, dialect).alias("ping_info"))
    ci = client_info(app_version, channel)
    if isinstance(include_client_info, Column):
        ci = F.when(include_client_info, ci)
    elif not include_client_info:
        ci = None
    if ci is not None:
        parts.append(ci.alias("client_info"))
    return F.to_json(F.struct(*parts))


def string_metrics(**named) -> Column:
    """`{"string": {"dotted.name": value, ...}}`; NULL values left out."""
    inner = F.map_from_arrays(F.array(*[F.lit(k) for k in named]),
                              F.array(*[_c(v).cast("string") for v in named.values()]))
    inner = F.map_filter(inner, lambda k, v: v.isNotNull())
    return F.create_map(F.lit("string"), inner)


def ping_fields(*, namespace, doc_type, doc_id, payload: Column, user_agent=None,
                ip_address=None, dialect="go", version: str = S.DOCUMENT_VERSION) -> Column:
    """`Fields` of the envelope. Go leaves empty request info out (NULL is
    dropped by `to_json`); Rust writes `""`; the others write what they got."""
    d = _lit(dialect)
    ua, ip = _c(user_agent), _c(ip_address)
    ua = F.when(d == "go", F.nullif(ua, F.lit(""))).when(d == "rust", F.coalesce(ua, F.lit(""))).otherwise(ua)
    ip = F.when(d == "go", F.nullif(ip, F.lit(""))).when(d == "rust", F.coalesce(ip, F.lit(""))).otherwise(ip)
    return F.struct(
        _lit(namespace).cast("string").alias("document_namespace"),
        _lit(doc_type).cast("string").alias("document_type"),
        _lit(version).cast("string").alias("document_version"),
        _c(doc_id).cast("string").alias("document_id"),
        ua.alias("user_agent"),
        ip.alias("ip_address"),
        payload.alias("payload"),
    )


def envelope_line(fields: Column, ts, dialect, *, app: str = "app", pid=1,
                  log_type=S.EVENT_LOG_TYPE) -> Column:
    """The serialised log record (E7), one dialect per row."""
    d = _lit(dialect)
    t = _lit(log_type)
    js = F.to_json(F.struct(
        times.epoch_nanos(ts).alias("Timestamp"),
        F.lit(app + S.JS_LOGGER_SUFFIX).alias("Logger"),
        t.alias("Type"),
        F.lit(S.INFO_SEVERITY).alias("Severity"),
        _lit(pid).cast("bigint").alias("Pid"),
        F.lit(S.ENV_VERSION).alias("EnvVersion"),
        fields.alias("Fields"),
    ))
    py = F.to_json(F.struct(times.python_isoformat(ts).alias("Timestamp"),
                            F.lit(S.DEFAULT_LOGGER).alias("Logger"), t.alias("Type"),
                            fields.alias("Fields")))
    go = F.to_json(F.struct(times.epoch_nanos(ts).cast("string").alias("Timestamp"),
                            F.lit(S.DEFAULT_LOGGER).alias("Logger"), t.alias("Type"),
                            fields.alias("Fields")))
    rs = F.to_json(F.struct(t.alias("Type"), fields.alias("Fields")))
    return F.when(d == "js", js).when(d == "python", py).when(d == "go", go).otherwise(rs)


def encode_events_ping(df: DataFrame, *, app_id: str, app_version: str, channel: str,
                       ts="ts", account_id=None, event: Column | None = None,
                       user_agent=None, ip_address=None, document_id=None,
                       dialect="go", keep: list[str] | tuple = ()) -> DataFrame:
    """One `events` ping per row, serialised as a log line `value`.

    `event=None` writes `events: []` (a ping without an event)."""
    evs = F.array(event) if event is not None else F.array().cast("array<" + S.EVENT.simpleString() + ">")
    payload = payload_json(metrics=string_metrics(**{"identifiers.fxa_account_id": account_id}),
                           events=evs, ts=ts, dialect=dialect, app_version=app_version, channel=channel)
    doc_id = _c(document_id) if document_id is not None else random_document_id()
    fields = ping_fields(namespace=app_id, doc_type="events", doc_id=doc_id, payload=payload,
                         user_agent=user_agent, ip_address=ip_address, dialect=dialect)
    return df.select(*keep, envelope_line(fields, ts, dialect, app=app_id).alias("value"))


def encode_accounts_events_ping(df: DataFrame, *, app_id: str, app_version: str, channel: str,
                                ts="ts", user_id=None, event_name=None, service=None,
                                user_agent=None, ip_address=None, document_id=None,
                                dialect="js", hash_user_id: bool = True,
                                keep: list[str] | tuple = ()) -> DataFrame:
    """`accounts-events` ping with three string metrics, no event array.
    The account id is hashed to hex SHA-256 (P21) unless already hashed."""
    uid = _c(user_id).cast("string")
    uid = F.sha2(uid, 256) if hash_user_id else uid
    metrics = string_metrics(**{
        "account.user_id_sha256": uid,
        "event.name": event_name,
        "relying_party.service": service,
    })
    payload = payload_json(metrics=metrics, events=None, ts=ts, dialect=dialect,
                           app_version=app_version, channel=channel)
    doc_id = _c(document_id) if document_id is not None else random_document_id()
    fields = ping_fields(namespace=app_id, doc_type="accounts-events", doc_id=doc_id,
                         payload=payload, user_agent=user_agent, ip_address=ip_address,
                         dialect=dialect)
    return df.select(*keep, envelope_line(fields, ts, dialect, app=app_id).alias("value"))
