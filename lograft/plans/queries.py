"""Registered queries: each reads whole driver tables and runs one part of the
library on them. `(spark, sf_dir) -> DataFrame`; column names match the SQL
oracles in `oracles.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.docschema import failures_by_version
from ..functions.mask import mask_text
from ..functions import paths as PT
from ..operators import decode as D
from ..operators import encode as E
from ..operators import enrich as EN
from ..operators import flatten as FL
from ..operators import container as CT
from ..operators import pipeline as PL
from ..operators import recombine as RC
from ..operators.seen_ids import SeenIds
from ..sources import logs as SRC
from ..sources import textlogs as TL
from . import event_lines as L
from . import batch as B
from . import container_lines as C
from . import lookups as LK
from . import schema_docs as SD
from . import text_lines as T
from ..functions import times
from ..session import scratch_path
from ..sinks import live as LV
from ..sinks.files import land
from ..sources import queue as Q
from ..streaming import decode_stream as DS
from .tables import table


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` table written out as landed log lines (value, event_id)."""
    lines = L.events_to_log_lines(table(spark, sf_dir, "events", spread=True),
                                  keep=("event_id", F.col("ts").alias("received")))
    return land(lines, "log-lines")


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.decode(log_lines(spark, sf_dir), S.registry(spark))


def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good `events` pings, decoded."""
    d = D.decoded(_routed(spark, sf_dir))
    ev = F.element_at(F.col("events"), 1)
    extra = ev.getField("extra")
    return d.select(
        "document_id", "document_namespace", "document_type", "document_version",
        "submission_timestamp", "start_time",
        F.col("client_info.app_channel").alias("app_channel"),
        F.col("client_info.app_display_version").alias("app_display_version"),
        F.col("client_info.telemetry_sdk_build").alias("telemetry_sdk_build"),
        F.col("ping_info.seq").alias("seq"),
        F.col("metrics")["string"]["identifiers.fxa_account_id"].alias("fxa_account_id"),
        F.size("events").cast("bigint").alias("n_events"),
        ev.getField("category").alias("event_category"),
        ev.getField("name").alias("event_name"),
        ev.getField("timestamp").alias("event_timestamp"),
        extra["object_type"].alias("object_type"),
        extra["object_state"].alias("object_state"),
        extra["linking"].try_cast("boolean").alias("linking"),
        "destination",
    )


def decode_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error table (45 columns), projected."""
    e = D.errors(_routed(spark, sf_dir))
    return e.select(
        F.get_json_object(F.col("payload").cast("string"), "$.Fields.document_id").alias("document_id"),
        "error_type", "error_message", "exception_class", "document_namespace",
        "document_type", "document_version", "submission_timestamp", "date", "input_type",
    )


def event_regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every record whose tag matches `glean-server-event*`."""
    lines = log_lines(spark, sf_dir)
    r = D.filter_event_records(lines, S.EVENT_LOG_TYPE_PATTERN)
    return r.select("log_type", "logger", "envelope_timestamp")


def nested_and_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event bodies nested as objects or as JSON after a prefix."""
    lines = log_lines(spark, sf_dir)
    r = D.filter_event_records(lines, S.EVENT_LOG_TYPE_PATTERN)
    r = r.filter(F.col("log_type") != S.EVENT_LOG_TYPE)
    b = D.event_body(F.col("fields"))
    return r.select("log_type", b.getField("event_time").alias("event_time"),
                    b.getField("event_name").alias("event_name"))


# The four lines of the sensitive-data test logger.
LOGGER_LINES = [
    "error happened with social security number 111-22-3333",
    "Something happened..with social 222-33-4444",
    "Processing credit card 1234 5678 9012 3456",
    "Users email is john.doe@example.com",
]
# End of fixed values.


def mask_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M4 over every whole document text."""
    docs = table(spark, sf_dir, "documents", spread=True)
    return docs.select("doc_id", mask_text("text").alias("text"))


def mask_logger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M4 on test-logger lines: header (event type) + one of four lines."""
    ev = table(spark, sf_dir, "events", spread=True)
    line = F.concat(F.col("event_type"), F.lit(": "),
                    F.element_at(F.array(*[F.lit(x) for x in LOGGER_LINES]), (F.col("event_id") % 4 + 1).cast("int")))
    return ev.select("event_id", mask_text(line).alias("log"))


def _text_lines(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", spread=True)
    return land(T.events_to_text_lines(ev, fmt), f"text-{fmt}")


_HTTP_COLS = ["event_id", "host", "user", "time", "ts", "method", "path", "code", "size", "referer", "agent"]


def parse_apache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apache access lines (path may hold spaces)."""
    return TL.parse_lines(_text_lines(spark, sf_dir, "apache"), "apache").select(*_HTTP_COLS)


def parse_apache2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """apache2 access lines (path without spaces)."""
    return TL.parse_lines(_text_lines(spark, sf_dir, "apache2"), "apache2").select(*_HTTP_COLS)


def parse_nginx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: nginx access lines."""
    return TL.parse_lines(_text_lines(spark, sf_dir, "nginx"), "nginx").select("remote", *_HTTP_COLS)


def parse_apache_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apache error lines, optional pid and client."""
    return TL.parse_lines(_text_lines(spark, sf_dir, "apache_error"), "apache_error").select(
        "event_id", "time", "level", "pid", "client", "message")


def parse_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syslog lines; the year comes from the line's file date."""
    df = _text_lines(spark, sf_dir, "syslog")
    return TL.parse_lines(df, "syslog", year="year").select(
        "event_id", "pri", "time", "ts", "host", "ident", "pid", "message")


def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: JSON lines with a CLF `time`; fields read from the VARIANT record."""
    df = TL.parse_lines(_text_lines(spark, sf_dir, "json"), "json")
    return df.select("event_id", "time", "ts",
                     F.try_variant_get("record", "$.user", "string").alias("user"),
                     F.try_variant_get("record", "$.event", "string").alias("event"),
                     F.try_variant_get("record", "$.props.k", "bigint").alias("k"))


def parse_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parser chosen per record by its `format`; unmatched lines kept."""
    df = _text_lines(spark, sf_dir, "mixed")
    p = TL.parse_by_format(F.col("value"), F.col("format"), year=F.col("year"))
    return df.select("event_id", "format", p.getField("host").alias("host"),
                     p.getField("time").alias("time"), p.getField("ts").alias("ts"),
                     p.getField("message").alias("message"))


def recombine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Docker JSON lines of every whole document, rejoined in order of
    their nanosecond times; lines that are no record stay messages of their own."""
    docs = table(spark, sf_dir, "documents", spread=True)
    lines = land(C.documents_to_container_lines(docs), "container-lines")
    parsed = TL.parse_docker(lines)
    msgs = RC.recombine_lines(parsed, "file_path", "n", "log")
    return msgs.select(
        F.regexp_extract("file_path", r"/pod-([0-9]+)_", 1).cast("bigint").alias("doc_id"),
        F.timestamp_micros(F.call_function("div", "first_order", F.lit(1000).cast("bigint"))).alias("first_time"),
        "message", F.col("parts").cast("bigint").alias("parts"))


LINE_LIMIT = 4096      # of the query; the agent's own limit is logs.MAX_LINE_BYTES


def drop_long_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines longer than the byte limit are skipped (whole documents as lines)."""
    docs = table(spark, sf_dir, "documents", spread=True)
    kept = SRC.drop_long_lines(docs, LINE_LIMIT, "text")
    return kept.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"))


def submit_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: `/submit/<ns>/<type>/<version>/<id>` -> document keys; malformed
    paths (every 9th) give NULLs."""
    ev = table(spark, sf_dir, "events", spread=True)
    good = PT.submit_path(F.lit(L.APP_ID), F.lit("events"), F.lit("1"), E.document_id_from_key(F.col("event_id")))
    path = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("/submit/"), F.col("event_type"))).otherwise(good)
    p = PT.parse_submit_path(path)
    return ev.select("event_id", p.getField("document_namespace").alias("document_namespace"),
                     p.getField("document_type").alias("document_type"),
                     p.getField("document_version").alias("document_version"),
                     p.getField("document_id").alias("document_id"))


_SERVICES = ["sync", "monitor", "relay", "vpn"]


def _accounts_routed(spark: SparkSession, sf_dir: str, lines_only: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", spread=True)
    service = F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("string")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in _SERVICES]), (F.col("user_id") % 4 + 1).cast("int")))
    lines = E.encode_accounts_events_ping(
        ev, app_id=L.APP_ID, app_version=L.APP_VERSION, channel=L.CHANNEL, ts="ts",
        user_id="user_id", event_name=F.col("event_type"), service=service,
        user_agent=L.user_agent_of(F.col("user_id")), ip_address=L.address_of(F.col("user_id"), F.col("event_id")),
        document_id=E.document_id_from_key(F.col("event_id")), dialect="js", keep=["event_id"])
    lines = land(lines, "accounts-lines")
    return lines if lines_only else D.decode(lines, S.registry(spark))


def accounts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`accounts-events` pings, string metrics as columns."""
    d = D.decoded(_accounts_routed(spark, sf_dir))
    d = FL.flatten_metrics(d, {"string": ["account.user_id_sha256", "event.name", "relying_party.service"]})
    return d.select("document_id", "document_type", "destination", "account_user_id_sha256",
                    "event_name", "relying_party_service", F.col("events").isNotNull().alias("has_events"))


def metrics_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: metric lookup by dotted name, including a name never sent."""
    d = D.decoded(_accounts_routed(spark, sf_dir))
    return d.select("document_id",
                    FL.metric("metrics", "string", "event.name").alias("event_name"),
                    FL.metric("metrics", "string", "relying_party.service").alias("service"),
                    FL.metric("metrics", "string", "session.flow_id").alias("flow_id"),
                    F.size(F.map_keys(F.col("metrics")["string"])).alias("n_string_metrics"))


def explode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings with and without user info and with `events: []`,
    one row per event (one NULL row for an empty array)."""
    ev = table(spark, sf_dir, "events", spread=True)
    eid = F.col("event_id")
    no_user = eid % 3 == 0
    event = E.object_update_event(F.col("ts"), F.col("event_type"), F.col("props"), (eid % 2 == 0))
    evs = F.when(eid % 5 == 0, F.array().cast("array<" + S.EVENT.simpleString() + ">")).otherwise(F.array(event))
    payload = E.payload_json(metrics=E.string_metrics(**{"identifiers.fxa_account_id": F.col("user_id")}),
                             events=evs, ts=F.col("ts"), dialect=L.dialect_of(eid),
                             app_version=L.APP_VERSION, channel=L.CHANNEL)
    fields = E.ping_fields(namespace=L.APP_ID, doc_type="events", doc_id=E.document_id_from_key(eid),
                           payload=payload, user_agent=F.when(~no_user, L.user_agent_of(F.col("user_id"))),
                           ip_address=F.when(~no_user, L.address_of(F.col("user_id"), eid)),
                           dialect=L.dialect_of(eid))
    lines = ev.select("event_id", E.envelope_line(fields, F.col("ts"), L.dialect_of(eid), app=L.APP_ID).alias("value"))
    d = D.decoded(D.decode(land(lines, "explode-lines"), S.registry(spark)), keep_source=True)
    x = FL.explode_events(d.select("document_id", "user_agent", "ip_address", "events"),
                          extras=("object_type", "object_state", "linking"))
    return x


def geo_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range lookup of every event address (IPv4, IPv6, wide
    ranges, empty), city kept only when listed, address dropped after."""
    ev = table(spark, sf_dir, "events", spread=True)
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    x = ev.select("event_id", LK.geo_address(F.col("event_id"), F.col("user_id")).alias("ip_address"))
    x = EN.enrich_geo(x, LK.geo_ranges(nation, region), cities=LK.city_list(nation, region))
    return EN.scrub_address(x)


def isp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISP name and organisation by address range (supplier ranges)."""
    ev = table(spark, sf_dir, "events", spread=True)
    x = ev.select("event_id", L.address_of(F.col("user_id"), F.col("event_id")).alias("ip_address"))
    return EN.scrub_address(EN.enrich_isp(x, LK.isp_ranges(table(spark, sf_dir, "supplier"))))


def user_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Browser / os / version of each decoded ping's user agent."""
    d = D.decoded(_routed(spark, sf_dir))
    return EN.enrich_user_agent(d.select("document_id", "user_agent")).select(
        "document_id", "user_agent_browser", "user_agent_os", "user_agent_version")


CLUSTER_LABELS = {"k8s_cluster_name": "custom-fluentbit", "k8s_cluster_location": "us-east1-b"}


def pod_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container lines of events (every 13th from another input,
    so with another tag) -> tag route, pod metadata by file name (nation as
    pods), JSON logs merged, resource labels."""
    ev = table(spark, sf_dir, "events", spread=True)
    eid, uid = F.col("event_id"), F.col("user_id")
    file_path = F.concat(F.lit("/var/log/containers/pod-"), (uid % 30).cast("string"),
                         F.lit("_default_app-"), F.md5(eid.cast("string")), F.lit(".log"))
    log = F.when(eid % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("plain "), F.col("event_type")))
    line = F.to_json(F.struct(F.concat(log, F.lit("\n")).alias("log"), F.lit("stdout").alias("stream"),
                              F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time")))
    lines = land(ev.select("event_id", file_path.alias("file_path"), line.alias("value")), "pod-lines")
    x = TL.parse_docker(lines).withColumn("tag", F.when(F.col("event_id") % 13 == 0, F.lit("host.messages")).otherwise(EN.tag_of("file_path")))
    x = EN.route_by_tag(x, "kube.*")
    x = EN.enrich_pods(x, LK.pods_of(table(spark, sf_dir, "nation")))
    x = EN.merge_log(x, "log")
    x = EN.add_labels(x, CLUSTER_LABELS)
    return x.select("event_id", "pod_name", "namespace_name", "container_name",
                    F.col("pod_labels")["nation"].alias("nation_label"),
                    F.try_variant_get("log_processed", "$.k", "bigint").alias("k"),
                    "k8s_cluster_name")


def _accounts_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accounts_routed(spark, sf_dir, lines_only=True)


def live_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` and `accounts-events` pings routed once and
    written as day-partitioned live tables per destination plus the error
    table; the live tables read back whole."""
    lines = log_lines(spark, sf_dir).select("value").unionByName(_accounts_lines(spark, sf_dir).select("value"))
    routed = D.decode(lines, S.registry(spark))
    base = scratch_path(spark, "live")
    LV.write_routed(routed, f"{base}/decoded", f"{base}/error")
    live = LV.read_live(spark, f"{base}/decoded")
    return live.select("destination", F.col("date").cast("string").alias("date"), "document_id")


def live_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One destination, one day, from the written live table (the
    day filter prunes partitions)."""
    routed = D.decode(log_lines(spark, sf_dir), S.registry(spark))
    base = scratch_path(spark, "live")
    LV.write_routed(routed, f"{base}/decoded", f"{base}/error")
    live = LV.read_live(spark, f"{base}/decoded", "accounts_frontend_live.events_v1", "2024-01-15")
    return live.select("document_id", "submission_timestamp")


def compacted_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings written as four batches of a stream, packed, and the live
    table's rows and files per day and destination counted."""
    lines = log_lines(spark, sf_dir).select("event_id", "value")
    base = scratch_path(spark, "live")
    out = f"{base}/decoded"
    for k in range(4):
        routed = D.decode(lines.filter(F.col("event_id") % 4 == k), S.registry(spark))
        LV.write_routed(routed, out, f"{base}/error", batch=("stream", k))
    LV.compact(spark, out, f"{base}/error")
    live = LV.read_live(spark, out).withColumn("file", F.input_file_name())
    return live.groupBy("destination", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))


DECODER_INPUT_SINCE = "2024-01-15 00:00:00"


def decoder_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log table -> decoder input table."""
    path = scratch_path(spark, "raw-log") + "/raw"
    LV.replace_table(B.raw_log_table(log_lines(spark, sf_dir), "received"), path)
    inp = B.prepare_decoder_input(SRC.read_table(spark, path, "committed"), DECODER_INPUT_SINCE, namespace_override=L.APP_ID)
    text = F.decode(F.col("payload"), "UTF-8")
    return inp.select("submission_timestamp", "document_id", "document_namespace", "document_type",
                      "document_version", (F.octet_length("payload") > 0).alias("has_payload"),
                      F.get_json_object(text, "$.client_info.app_channel").alias("app_channel"))


def batch_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch decoder over the whole decoder input table: same routing as lines."""
    routed = B.decode_input_table(SRC.read_decoder_input(spark, _decoder_input_table(spark, sf_dir), fmt="committed"), S.registry(spark))
    return routed.select("document_id", "submission_timestamp", "error_type", "destination")


def _decoder_input_table(spark: SparkSession, sf_dir: str) -> str:
    """The decoder input written as a day-partitioned table."""
    raw = B.raw_log_table(log_lines(spark, sf_dir), "received")
    path = scratch_path(spark, "decoder-input") + "/input"
    rows = B.prepare_decoder_input(raw, "1970-01-01 00:00:00")
    LV.replace_table(LV.shard(rows.withColumn("date", F.to_date("submission_timestamp")), None, "date"), path, ["date"])
    return path


def decoder_input_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoder input of a day range narrower than the table (partitions
    pruned at planning)."""
    inp = SRC.read_decoder_input(spark, _decoder_input_table(spark, sf_dir), "2024-01-10", "2024-01-12", "committed")
    return inp.select("submission_timestamp", "document_id", F.col("payload").isNotNull().alias("has_payload"))


def _lookups(spark: SparkSession, sf_dir: str) -> PL.Lookups:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return PL.prepare(S.registry(spark), geo=LK.geo_ranges(nation, region), isp=LK.isp_ranges(table(spark, sf_dir, "supplier")),
                      cities=LK.city_list(nation, region))


def _pipeline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip queue messages (every 97th delivered twice) through the decoder."""
    m = _messages(spark, sf_dir, gzip_every=False).withColumn("data", Q.gzip_bytes("data"))
    again = m.filter(F.col("attributes")["event_id"].cast("bigint") % 97 == 0)
    lines = Q.read_messages(land(m.unionByName(again), "messages"))
    return PL.decode_pipeline(lines, _lookups(spark, sf_dir), received_col="received", good_source=False)


def _holds_address(df: DataFrame):
    """Is any address of the input (10.x.y.z) left in any column of the row?"""
    rows = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) if t == "binary" else F.col(c) for c, t in df.dtypes]))
    return rows.rlike(r"\b10\.[0-9]+\.[0-9]+\.[0-9]+\b")


_ENRICHED = ["geo_country", "geo_city", "geo_subdivision1", "isp_name", "isp_organization", "user_agent_browser", "user_agent_os", "user_agent_version"]


def decode_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoder in one pass (S5, W1, P5-P9, J3-J5, J7, J8, V4): good rows."""
    d = D.decoded(_pipeline_rows(spark, sf_dir))
    return d.select("document_id", "submission_timestamp", *_ENRICHED, "destination", _holds_address(d).alias("has_address"))


def decode_enriched_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pass: error table rows, enriched as far as the envelope goes."""
    e = D.errors(_pipeline_rows(spark, sf_dir))
    return e.select(F.get_json_object(F.col("payload").cast("string"), "$.Fields.document_id").alias("document_id"), "error_type",
                    "submission_timestamp", "date", *_ENRICHED, _holds_address(e).alias("has_address"))


def live_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8, V5, K6: the error table written by day and read back, whole."""
    routed = PL.decode_pipeline(log_lines(spark, sf_dir), PL.prepare(S.registry(spark)), received_col="received", good_source=False)
    base = scratch_path(spark, "live")
    LV.write_routed(routed, f"{base}/decoded", f"{base}/error")
    return LV.read_errors(spark, f"{base}/error").select(
        F.get_json_object(F.col("payload").cast("string"), "$.Fields.document_id").alias("document_id"),
        "error_type", "exception_class", "submission_timestamp", "date", "input_type", F.col("remote_addr").isNull().alias("no_address"))


def dirty_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip of two members and of none, bytes that are not UTF-8,
    38-digit and time-only timestamps, cut-off envelopes: rows, never a failure."""
    ev = table(spark, sf_dir, "events", spread=True)
    eid = F.col("event_id")
    first, second = F.concat(F.lit("a"), eid.cast("string")).cast("binary"), F.concat(F.lit("b"), eid.cast("string")).cast("binary")
    one = ev.select("event_id", "ts", Q.gzip_bytes(first).alias("m1"), Q.gzip_bytes(second).alias("m2"))
    data = F.when(eid % 3 == 0, F.col("m1")).when(eid % 3 == 1, F.concat("m1", "m2")).otherwise(first)
    time = F.when(eid % 4 == 0, F.repeat(F.lit("9"), 38)).when(eid % 4 == 1, F.lit("12:30:00")) \
        .when(eid % 4 == 2, times.epoch_nanos("ts").cast("string")).otherwise(times.iso_millis_z("ts"))
    fine = E.payload_json(metrics=E.string_metrics(**{"n": eid}), events=F.array().cast("array<" + S.EVENT.simpleString() + ">"),
                          ts=F.col("ts"), dialect=F.lit("go"), app_version=L.APP_VERSION, channel=L.CHANNEL)
    rows = land(one.select(
        "event_id", data.alias("data"), time.alias("time"), times.as_instant("ts").alias("submission_timestamp"),
        E.document_id_from_key(eid).alias("document_id"), F.lit(L.APP_ID).alias("document_namespace"),
        F.lit("events").alias("document_type"), F.lit("1").alias("document_version"),
        F.when(eid % 5 == 0, F.unhex(F.lit("7BFF22"))).otherwise(fine.cast("binary")).alias("payload")), "dirty")
    routed = B.decode_input_table(rows, S.registry(spark)).select("document_id", "error_type", F.hex(F.substring("raw", 1, 3)).alias("bytes"))
    cut = land(rows.select(F.concat(F.lit('{"Type":"glean-server-event","Fields":{"document_id":"'), "document_id").alias("value")), "cut-off")
    damaged = D.decode(cut, S.registry(spark)).select(F.regexp_extract("raw", r'"document_id":"([^"]+)', 1).alias("document_id"),
                                                      F.col("error_type").alias("cut_off_type"))
    return rows.join(routed, "document_id").join(damaged, "document_id", "left").select(
        "event_id", Q.gunzip_text("data").alias("text"), times.parse_timestamp("time").alias("parsed"), "error_type",
        F.when(F.col("error_type").isNotNull(), F.col("bytes")).alias("bytes"), "cut_off_type")


def container_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S4, F4, M4, J1, J2, J9 end to end: container files of all documents
    (lines that are no record among them) and of JSON event logs with personal data, written,
    read back and processed."""
    docs = C.documents_to_container_lines(table(spark, sf_dir, "documents", spread=True))
    ev = table(spark, sf_dir, "events", spread=True)
    eid = F.col("event_id")
    path = F.concat(F.lit("/var/log/containers/pod-"), (F.col("user_id") % 30).cast("string"), F.lit("_default_app-"), F.md5(eid.cast("string")), F.lit(".log"))
    log = F.to_json(F.struct(eid.alias("id"), F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("mail")))
    line = F.to_json(F.struct(F.concat(log, F.lit("\n")).alias("log"), F.lit("stdout").alias("stream"), times.iso_millis_z("ts").alias("time")))
    lines = land(docs.unionByName(ev.select(path.alias("file_path"), line.alias("value"))), "container-files")
    x = CT.container_logs(lines, LK.pods_of(table(spark, sf_dir, "nation")), labels=CLUSTER_LABELS)
    return x.select(F.regexp_extract("pod_name", r"([0-9]+)$", 1).cast("bigint").alias("pod"), F.col("namespace_name").alias("namespace"),
                    "log", F.try_variant_get("log_processed", "$.mail", "string").alias("mail"),
                    F.try_variant_get("log_processed", "$.id", "bigint").alias("event_id"),
                    F.col("pod_labels")["nation"].alias("nation_label"), "k8s_cluster_name")


def ping_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as pings, written as text files, read back
    with their path and decoded; each row as one JSON record."""
    ev = table(spark, sf_dir, "events", spread=True)
    eid = F.col("event_id")
    pings = E.encode_events_ping(ev, app_id=L.APP_ID, app_version=L.APP_VERSION, channel=L.CHANNEL, account_id="user_id",
                                 event=E.object_update_event(F.col("ts"), F.col("event_type"), F.col("props")),
                                 document_id=E.document_id_from_key(eid), dialect="go")
    path = scratch_path(spark, "ping-lines")
    LV.write_lines(pings, path)
    d = D.decoded(D.decode(SRC.read_logs(spark, f"{path}/*.txt"), S.registry(spark)))
    rec = LV.json_records(d.select("document_id", F.col("metrics")["string"]["identifiers.fxa_account_id"].alias("account"), "destination"))
    v = F.from_json("value", "document_id string, account string, destination string")
    return rec.select(v.alias("v")).select("v.*")


def random_document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings encoded without a given id get a random UUID each."""
    ev = table(spark, sf_dir, "events", spread=True)
    pings = land(E.encode_events_ping(ev, app_id=L.APP_ID, app_version=L.APP_VERSION, channel=L.CHANNEL, account_id="user_id", dialect="rust"), "random-ids")
    d = D.decoded(D.decode(pings, S.registry(spark)))
    form = F.col("document_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return d.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("document_id").alias("n_distinct"), F.count(F.when(form, 1)).alias("n_uuid"))


def table_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, K5: an empty table with the schema of `events`, then filled."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-like") + "/events"
    empty = LV.create_table_like(spark, ev, path)
    before = empty.count()
    LV.append_table(ev, path)
    return LV.read_table(spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users")) \
        .withColumn("n_before", F.lit(before).cast("bigint"))


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings per destination and one-minute window."""
    return DS.count_windows(D.decoded(_routed(spark, sf_dir)))


def _messages(spark: SparkSession, sf_dir: str, gzip_every: bool) -> DataFrame:
    lines = log_lines(spark, sf_dir)
    data = F.col("value").cast("binary")
    if gzip_every:
        data = F.when(F.col("event_id") % 10 != 0, Q.gzip_bytes(data)).otherwise(data)
    return lines.select(E.document_id_from_key(F.col("event_id")).alias("message_id"),
                        F.col("received").cast("timestamp").alias("publish_time"), data.alias("data"),
                        F.create_map(F.lit("event_id"), F.col("event_id").cast("string"),
                                     F.lit("document_type"), F.lit("events")).alias("attributes"))


def dedup_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 (batch form): every 97th message delivered twice, one kept."""
    m = _messages(spark, sf_dir, gzip_every=False)
    again = m.filter(F.col("attributes")["event_id"].cast("bigint") % 97 == 0) \
             .withColumn("publish_time", F.col("publish_time") + F.expr("INTERVAL 1 SECOND"))
    d = Q.dedup_messages(m.unionByName(again), "message_id")
    return d.select("message_id", Q.attribute("attributes", "event_id").alias("event_id"))


def gunzip_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip message bodies decoded to text (every 10th is not gzip:
    NULL text, row kept); the document id read from the text."""
    m = land(_messages(spark, sf_dir, gzip_every=True), "messages")
    t = Q.decode_messages(m)
    return t.select("message_id", Q.attribute("attributes", "document_type").alias("document_type"),
                    F.col("value").isNotNull().alias("is_text"),
                    F.get_json_object("value", "$.Fields.document_id").alias("document_id"))


def pull_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pull of at most 10 messages. Any 10 will do, so the query
    states what holds for each pull: how many, distinct, known."""
    m = _messages(spark, sf_dir, gzip_every=False).select("message_id")
    got = land(Q.pull(m, Q.PULL_MAX), "pulled")
    known = got.join(m.withColumn("known", F.lit(1)).distinct(), "message_id", "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("message_id").alias("n_distinct"), F.count("known").alias("n_known"))


def minute_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-minute tumbling window of each decoded ping."""
    d = D.decoded(_routed(spark, sf_dir))
    w = F.window("submission_timestamp", "1 minute")
    return d.select("document_id", w.getField("start").alias("window_start"), w.getField("end").alias("window_end"))


def timestamp_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every producer text form of `ts`, parsed back."""
    ev = table(spark, sf_dir, "events", spread=True)
    ts = F.col("ts")
    forms = ev.select(
        "event_id",
        times.iso_millis_z(ts).alias("js"), times.python_isoformat(ts).alias("py"),
        times.epoch_nanos(ts).cast("string").alias("ns"), times.rfc3339_auto(ts).alias("rs"),
        times.minute_offset(ts, -5).alias("minute"),
        F.concat(F.date_format(times.as_instant(ts), "yyyy-MM-dd"), F.lit("+02:00")).alias("day"),
        F.lit("Unknown").alias("unknown"))
    forms = land(forms, "time-forms")
    return forms.select("event_id", *[times.parse_timestamp(c).alias(f"{c}_ts") for c in
                                      ("js", "py", "ns", "rs", "minute", "unknown")],
                        times.parse_date("day").alias("day_date"))


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 beyond the horizon: two thirds of the events as messages, then all of
    them a day later by another stream; what was taken, and by which."""
    ev = table(spark, sf_dir, "events", spread=True)
    messages = ev.select(F.md5(F.col("event_id").cast("string")).alias("message_id"), F.col("ts").alias("publish_time"), "event_id")
    index = SeenIds(spark, scratch_path(spark, "seen"))
    index.take(messages.filter("event_id % 3 != 0").withColumn("stream", F.lit("first")), ("first", 0))
    index.take(messages.withColumn("publish_time", F.expr("publish_time + INTERVAL 1 DAY")).withColumn("stream", F.lit("second")), ("second", 0))
    return index.read().select("event_id", "message_id", "stream", "publish_time")


def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all events checked against the schema of their
    version; one row each, failures as sorted `path rule`."""
    docs = land(SD.events_to_documents(table(spark, sf_dir, "events", spread=True)), "schema-docs")
    found = docs.select("event_id", "version", failures_by_version(F.col("text"), F.col("version"), SD.archive()).alias("f"))
    names = F.array_sort(F.transform("f", lambda x: F.concat_ws(" ", x["path"], x["rule"])))
    return found.select("event_id", "version", F.size("f").cast("bigint").alias("n_failures"), F.array_join(names, "; ").alias("failures"))


def logger_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test logger's interval setting (integer text or a
    default of 2) and its header-prefixed line, masked."""
    ev = table(spark, sf_dir, "events", spread=True)
    eid = F.col("event_id")
    setting = (F.when(eid % 3 == 0, (F.col("user_id") % 10).cast("string"))
               .when(eid % 3 == 1, F.lit("abc")).otherwise(F.lit(None).cast("string")))
    stmt = F.element_at(F.array(*[F.lit(x) for x in LOGGER_LINES]), (eid % 4 + 1).cast("int"))
    header = F.when(eid % 5 != 0, F.concat(F.col("event_type"), F.lit(" ")))
    return ev.select("event_id", PT.int_or_default(setting, 2).alias("interval_s"),
                     mask_text(PT.prefixed(header, stmt)).alias("log"))


REGISTRY = {
    "decode_events": decode_events,
    "decode_errors": decode_errors,
    "event_regex_filter": event_regex_filter,
    "nested_and_prefixed": nested_and_prefixed,
    "mask_documents": mask_documents,
    "mask_logger_lines": mask_logger_lines,
    "parse_apache": parse_apache,
    "parse_apache2": parse_apache2,
    "parse_apache_error": parse_apache_error,
    "parse_nginx": parse_nginx,
    "parse_syslog": parse_syslog,
    "parse_json": parse_json,
    "parse_mixed": parse_mixed,
    "recombine_lines": recombine_lines,
    "drop_long_lines": drop_long_lines,
    "submit_path": submit_path,
    "accounts_events": accounts_events,
    "metrics_lookup": metrics_lookup,
    "explode_events": explode_events,
    "geo_country": geo_country,
    "isp": isp,
    "user_agent": user_agent,
    "pod_metadata": pod_metadata,
    "live_destination": live_destination,
    "live_day": live_day,
    "compacted_live": compacted_live,
    "decoder_input": decoder_input,
    "batch_decode": batch_decode,
    "dedup_messages": dedup_messages,
    "gunzip_payload": gunzip_payload,
    "pull_messages": pull_messages,
    "minute_windows": minute_windows,
    "timestamp_forms": timestamp_forms,
    "logger_settings": logger_settings,
    "schema_errors": schema_errors,
    "redelivered": redelivered,
    "decode_enriched": decode_enriched,
    "decode_enriched_errors": decode_enriched_errors,
    "live_errors": live_errors,
    "decoder_input_days": decoder_input_days,
    "dirty_input": dirty_input,
    "container_logs": container_logs,
    "ping_lines": ping_lines,
    "table_like": table_like,
    "random_document_ids": random_document_ids,
    "window_counts": window_counts,
}
