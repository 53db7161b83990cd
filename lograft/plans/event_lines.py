"""Log output derived from an `events` table (event_id, ts, user_id,
event_type, value, props), used by the registered queries, tests and the
benchmark.

Mapping: `user_id` -> account id, `event_type` -> `object_type`, `props` ->
`object_state`, `ts` -> every time, `md5(event_id)` -> document id. The
writer dialect cycles with `event_id % 4` (0 js, 1 python, 2 go, 3 rust).
`linking` is absent for python, the text `undefined` for js when
`event_id % 7 = 0`, else `event_id % 3 = 0`. Address
`10.<user_id % 30>.<event_id div 256 % 256>.<event_id % 256>`.

Negative inputs are mixed in by `event_id % 50`: 0 ping without
`client_info`; 1 empty `Fields`; 2 plain text; 3 `-from-dict` body; 4
`-with-prefix` body; 5 truncated payload JSON; 6 unregistered version `99`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import times
from ..operators import encode as E

APP_ID = "accounts-frontend"
APP_VERSION = "0.0.1"
CHANNEL = "development"

# Sample user agents seen in the producers' demo traffic
# (the first two) and two common desktop agents.
SAMPLE_USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/115.0.0.0 Safari/537.36 Edg/115.0.1901.188",
    "Mozilla/5.0",
    "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.5 Safari/605.1.15",
]
# End of fixed values.


def dialect_of(event_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in E.DIALECTS]), (event_id % 4 + 1).cast("int"))


def linking_of(event_id: Column, dialect: Column) -> Column:
    return (F.when(dialect == "python", F.lit(None).cast("string"))
            .when((dialect == "js") & (event_id % 7 == 0), F.lit("undefined"))
            .otherwise((event_id % 3 == 0).cast("string")))


def address_of(user_id: Column, event_id: Column) -> Column:
    return F.concat_ws(".", F.lit("10"), (user_id % 30).cast("string"),
                       (F.floor(event_id / 256) % 256).cast("string"), (event_id % 256).cast("string"))


def user_agent_of(user_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(u) for u in SAMPLE_USER_AGENTS]), (user_id % 4 + 1).cast("int"))


def events_to_log_lines(events: DataFrame, *, with_faults: bool = True, keep=("event_id",)) -> DataFrame:
    """One log line per event row (`value`), faults mixed in by residue."""
    eid, ts = F.col("event_id"), F.col("ts")
    d = dialect_of(eid)
    r = eid % 50 if with_faults else F.lit(99)
    event = E.object_update_event(ts, F.col("event_type"), F.col("props"), linking_of(eid, d))
    payload_text = E.payload_json(
        metrics=E.string_metrics(**{"identifiers.fxa_account_id": F.col("user_id")}),
        events=F.array(event), ts=ts, dialect=d, app_version=APP_VERSION, channel=CHANNEL,
        include_client_info=(r != 0),
    )
    pt = F.col("_payload_text")
    payload = F.when(r == 5, F.expr("substring(_payload_text, 1, length(_payload_text) div 2)")).otherwise(pt)
    fields = E.ping_fields(
        namespace=APP_ID, doc_type="events", doc_id=E.document_id_from_key(eid),
        payload=payload, user_agent=user_agent_of(F.col("user_id")),
        ip_address=address_of(F.col("user_id"), eid), dialect=d,
        version=F.when(r == 6, F.lit("99")).otherwise(F.lit(S.DOCUMENT_VERSION)),
    )
    good = E.envelope_line(fields, ts, d, app=APP_ID)
    empty_fields = F.struct(*[F.lit(None).cast("string").alias(f.name) for f in S.PING_FIELDS.fields])
    empty = E.envelope_line(empty_fields, ts, d, app=APP_ID)
    body = F.struct(times.iso_millis_z(ts).alias("timestamp"), F.col("event_type").alias("event_name"))
    from_dict = E.envelope_line(body, ts, d, app=APP_ID, log_type=S.EVENT_LOG_TYPE + "-from-dict")
    prefixed = E.envelope_line(
        F.struct(F.concat(F.lit("some-string "), F.to_json(body)).alias("msg")), ts, d, app=APP_ID,
        log_type=S.EVENT_LOG_TYPE + "-with-prefix")
    plain = F.concat(F.lit("non-event log line "), eid.cast("string"))
    line = (F.when(r == 1, empty).when(r == 2, plain).when(r == 3, from_dict)
            .when(r == 4, prefixed).otherwise(good))
    return (events.withColumn("_payload_text", F.when((r != 1) & (r != 2) & (r != 3) & (r != 4), payload_text))
            .select(*keep, line.alias("value")))
