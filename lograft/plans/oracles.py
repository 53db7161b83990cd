"""DuckDB SQL stating the expected rows of each registered query directly from
the driver tables, without the JSON round trip under test."""

from __future__ import annotations

from .. import schemas as S
from ..functions.mask import CARD_MASK, CARD_PATTERN, EMAIL_MASK, EMAIL_PATTERN, SSN_MASK, SSN_PATTERN
from .event_lines import SAMPLE_USER_AGENTS

# DuckDB expression: md5 of the event id in 8-4-4-4-12 form.
DOC_ID = ("(substr(md5(cast(event_id as varchar)),1,8) || '-' || substr(md5(cast(event_id as varchar)),9,4)"
          " || '-' || substr(md5(cast(event_id as varchar)),13,4) || '-' || substr(md5(cast(event_id as varchar)),17,4)"
          " || '-' || substr(md5(cast(event_id as varchar)),21,12))")

SDK = S.SDK_BUILD
LOGGER = (f"CASE event_id % 4 WHEN 0 THEN 'accounts-frontend{S.JS_LOGGER_SUFFIX}' WHEN 3 THEN NULL "
          f"ELSE '{S.DEFAULT_LOGGER}' END")

LINKING = ("CASE WHEN event_id % 4 = 1 THEN NULL WHEN event_id % 4 = 0 AND event_id % 7 = 0 THEN NULL "
           "ELSE event_id % 3 = 0 END")

ORACLES: dict[str, str] = {}

ORACLES["decode_events"] = f"""
SELECT {DOC_ID} AS document_id,
       'accounts-frontend' AS document_namespace, 'events' AS document_type, '1' AS document_version,
       ts AS submission_timestamp,
       CASE WHEN event_id % 4 IN (0, 2) THEN date_trunc('millisecond', ts) ELSE ts END AS start_time,
       'development' AS app_channel, '0.0.1' AS app_display_version,
       '{SDK}' AS telemetry_sdk_build, CAST(0 AS BIGINT) AS seq,
       CAST(user_id AS VARCHAR) AS fxa_account_id, CAST(1 AS BIGINT) AS n_events,
       'backend' AS event_category, 'object_update' AS event_name,
       epoch_us(ts) // 1000 AS event_timestamp, event_type AS object_type, props AS object_state,
       {LINKING} AS linking,
       'accounts_frontend_live.events_v1' AS destination
FROM events WHERE event_id % 50 >= 7
"""

ORACLES["decode_errors"] = f"""
SELECT CASE WHEN event_id % 50 = 1 THEN NULL ELSE {DOC_ID} END AS document_id,
       CASE event_id % 50 WHEN 0 THEN 'missing_field' WHEN 1 THEN 'bad_envelope'
            WHEN 5 THEN 'bad_json' ELSE 'unknown_schema' END AS error_type,
       CASE event_id % 50 WHEN 0 THEN 'missing required field: client_info'
            WHEN 1 THEN 'envelope has no complete Fields'
            WHEN 5 THEN 'payload is not a JSON object of the declared schema'
            ELSE 'no schema for accounts-frontend/events/99' END AS error_message,
       CASE event_id % 50 WHEN 0 THEN 'ValidationException' WHEN 1 THEN 'InvalidEnvelopeException'
            WHEN 5 THEN 'MalformedPayloadException' ELSE 'SchemaNotFoundException' END AS exception_class,
       CASE WHEN event_id % 50 = 1 THEN NULL ELSE 'accounts-frontend' END AS document_namespace,
       CASE WHEN event_id % 50 = 1 THEN NULL ELSE 'events' END AS document_type,
       CASE event_id % 50 WHEN 1 THEN NULL WHEN 6 THEN '99' ELSE '1' END AS document_version,
       CASE WHEN event_id % 4 = 3 AND event_id % 50 IN (1, 5) THEN NULL ELSE ts END AS submission_timestamp,
       CASE WHEN event_id % 4 = 3 AND event_id % 50 IN (1, 5) THEN NULL
            ELSE strftime(ts, '%Y-%m-%d') END AS date,
       'log' AS input_type
FROM events WHERE event_id % 50 IN (0, 1, 5, 6)
"""

ORACLES["event_regex_filter"] = f"""
SELECT log_type, logger, envelope_timestamp FROM (
  SELECT CASE event_id % 50 WHEN 3 THEN 'glean-server-event-from-dict'
              WHEN 4 THEN 'glean-server-event-with-prefix' ELSE 'glean-server-event' END AS log_type,
         {LOGGER} AS logger,
         CASE WHEN event_id % 4 = 3 THEN NULL ELSE ts END AS envelope_timestamp
  FROM events WHERE event_id % 50 <> 2)
WHERE regexp_matches(log_type, 'glean-server-event*')
"""

ORACLES["nested_and_prefixed"] = """
SELECT CASE event_id % 50 WHEN 3 THEN 'glean-server-event-from-dict'
            ELSE 'glean-server-event-with-prefix' END AS log_type,
       date_trunc('millisecond', ts) AS event_time, event_type AS event_name
FROM events WHERE event_id % 50 IN (3, 4)
"""



def _masked(text: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace({text}, '{SSN_PATTERN}', '{SSN_MASK}', 'g'),"
            f" '{CARD_PATTERN}', '{CARD_MASK}', 'g'), '{EMAIL_PATTERN}', '{EMAIL_MASK}', 'g')")


ORACLES["mask_documents"] = f"SELECT doc_id, {_masked('text')} AS text FROM documents"

# The four lines of the sensitive-data test logger, masked.
_MASKED_LINES = f"""CASE event_id % 4
         WHEN 0 THEN 'error happened with social security number {SSN_MASK}'
         WHEN 1 THEN 'Something happened..with social {SSN_MASK}'
         WHEN 2 THEN 'Processing credit card {CARD_MASK}'
         ELSE 'Users email is {EMAIL_MASK}' END"""
# End of fixed values.

ORACLES["mask_logger_lines"] = f"SELECT event_id, event_type || ': ' || {_MASKED_LINES} AS log FROM events"

# --- text log formats --------------------------------------------------------
_UA = "[" + ", ".join(f"'{u}'" for u in SAMPLE_USER_AGENTS) + "]"
_ADDR = "('10.' || (user_id % 30) || '.' || ((event_id // 256) % 256) || '.' || (event_id % 256))"
_USER = "(CASE WHEN event_id % 6 = 0 THEN '-' ELSE 'u' || user_id END)"
_CLF = "(strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000')"
_METHOD = "(['GET','POST','PUT','DELETE'][event_id % 4 + 1])"
_PATH = ("(CASE WHEN event_id % 10 = 1 THEN '/' || event_type || ' x/' || event_id "
         "ELSE '/' || event_type || '/' || event_id || '?u=' || user_id END)")
_PATH2 = "('/' || event_type || '/' || event_id)"
_CODE = "(['200','301','404','500'][user_id % 4 + 1])"
_SIZE = "CAST(event_id * 7 % 5000 AS VARCHAR)"
_REF = "(CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'http://example.com/' || event_type END)"
_AGENT = f"(CASE WHEN event_id % 5 = 0 THEN NULL ELSE {_UA}[user_id % 4 + 1] END)"
_VHOST = "('svc' || (user_id % 5) || '.example.com')"
_PID = "(CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id * 13 % 30000 AS VARCHAR) END)"
_MSG = "(event_type || ' by user ' || user_id)"
_SYSTIME = "(strftime(ts, '%b') || ' ' || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || ' ' || strftime(ts, '%H:%M:%S'))"
_ERRTIME = "strftime(ts, '%b %d %H:%M:%S %Y')"


def _http(path: str, extra: str = "") -> str:
    return (f"SELECT event_id, {extra}{_ADDR} AS host, {_USER} AS user, {_CLF} AS time, "
            f"date_trunc('second', ts) AS ts, {_METHOD} AS method, {path} AS path, {_CODE} AS code, "
            f"{_SIZE} AS size, {_REF} AS referer, {_AGENT} AS agent FROM events")


ORACLES["parse_apache"] = _http(_PATH)
ORACLES["parse_apache2"] = _http(_PATH2)
ORACLES["parse_nginx"] = (f"SELECT event_id, {_ADDR} AS remote, {_VHOST} AS host, {_USER} AS user, {_CLF} AS time, "
                          f"date_trunc('second', ts) AS ts, {_METHOD} AS method, {_PATH} AS path, {_CODE} AS code, "
                          f"{_SIZE} AS size, {_REF} AS referer, {_AGENT} AS agent FROM events")
ORACLES["parse_apache_error"] = (
    f"SELECT event_id, {_ERRTIME} AS time, (['error','warn','notice','info'][event_id % 4 + 1]) AS level, "
    f"{_PID} AS pid, CASE WHEN event_id % 5 = 0 THEN NULL ELSE {_ADDR} END AS client, {_MSG} AS message FROM events")
ORACLES["parse_syslog"] = (
    f"SELECT event_id, CAST(event_id % 192 AS VARCHAR) AS pri, {_SYSTIME} AS time, date_trunc('second', ts) AS ts, "
    f"'node' || (user_id % 10) AS host, 'svc-' || event_type AS ident, {_PID} AS pid, {_MSG} AS message FROM events")
ORACLES["parse_json"] = (
    f"SELECT event_id, {_CLF} AS time, date_trunc('second', ts) AS ts, {_USER} AS user, event_type AS event, "
    f"CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
ORACLES["parse_mixed"] = f"""
SELECT event_id, fmt AS format,
  CASE fmt WHEN 'apache' THEN {_ADDR} WHEN 'apache2' THEN {_ADDR} WHEN 'nginx' THEN {_VHOST}
           WHEN 'syslog' THEN 'node' || (user_id % 10) END AS host,
  CASE fmt WHEN 'apache_error' THEN {_ERRTIME} WHEN 'syslog' THEN {_SYSTIME} WHEN 'none' THEN NULL
           ELSE {_CLF} END AS time,
  CASE WHEN fmt IN ('apache_error', 'none') THEN NULL ELSE date_trunc('second', ts) END AS ts,
  CASE WHEN fmt IN ('apache_error', 'syslog') THEN {_MSG} END AS message
FROM (SELECT *, (['apache','apache2','apache_error','nginx','syslog','json','none'][event_id % 7 + 1]) AS fmt FROM events)
"""

ORACLES["recombine_lines"] = """
SELECT doc_id, to_timestamp(1704067200 + doc_id * 60) AT TIME ZONE 'UTC' AS first_time,
       replace(text, chr(10), ' ') || chr(10) AS message,
       CAST(greatest(ceil(length(replace(text, chr(10), ' ')) / 100), 1) AS BIGINT) AS parts
FROM documents
UNION ALL SELECT doc_id, NULL, 'no record ' || doc_id, 1 FROM documents WHERE doc_id % 10 = 0
"""

ORACLES["drop_long_lines"] = """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes
FROM documents WHERE octet_length(encode(text)) <= 4096
"""

ORACLES["submit_path"] = f"""
SELECT event_id,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'accounts-frontend' END AS document_namespace,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'events' END AS document_type,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE '1' END AS document_version,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE {DOC_ID} END AS document_id
FROM events
"""

_SERVICE = "(CASE WHEN user_id % 5 = 0 THEN NULL ELSE (['sync','monitor','relay','vpn'][user_id % 4 + 1]) END)"

ORACLES["accounts_events"] = f"""
SELECT {DOC_ID} AS document_id, 'accounts-events' AS document_type,
       'accounts_frontend_live.accounts_events_v1' AS destination,
       sha256(CAST(user_id AS VARCHAR)) AS account_user_id_sha256,
       event_type AS event_name, {_SERVICE} AS relying_party_service, false AS has_events
FROM events
"""

ORACLES["metrics_lookup"] = f"""
SELECT {DOC_ID} AS document_id, event_type AS event_name, {_SERVICE} AS service,
       CAST(NULL AS VARCHAR) AS flow_id,
       CAST(CASE WHEN user_id % 5 = 0 THEN 2 ELSE 3 END AS INTEGER) AS n_string_metrics
FROM events
"""

ORACLES["explode_events"] = f"""
SELECT {DOC_ID} AS document_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE {_UA}[user_id % 4 + 1] END AS user_agent,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE {_ADDR} END AS ip_address,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'backend' END AS event_category,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'object_update' END AS event_name,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS event_timestamp,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS object_type,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS object_state,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 2 = 0 AS VARCHAR) END AS linking
FROM events
"""

ORACLES["geo_country"] = """
WITH e AS (
  SELECT event_id, user_id,
         CASE WHEN event_id % 17 = 0 THEN 'empty' WHEN event_id % 11 = 0 THEN 'v6'
              WHEN event_id % 13 = 0 THEN 'wide' ELSE 'v4' END AS kind
  FROM events)
SELECT e.event_id,
       CASE e.kind WHEN 'v4' THEN coalesce(n.n_name, 'TEN') WHEN 'v6' THEN coalesce(r6.r_name, 'SIX')
                   WHEN 'wide' THEN rw.r_name || ' WIDE' END AS geo_country,
       CASE e.kind WHEN 'v4' THEN CASE WHEN n.n_nationkey % 2 = 0 THEN n.n_name || ' CITY' END
                   WHEN 'v6' THEN r6.r_name || ' CITY' END AS geo_city,
       CASE WHEN e.kind = 'v4' THEN rn.r_name END AS geo_subdivision1,
       CAST(NULL AS VARCHAR) AS geo_subdivision2
FROM e
LEFT JOIN nation n ON e.kind = 'v4' AND n.n_nationkey = e.user_id % 30
LEFT JOIN region rn ON rn.r_regionkey = n.n_regionkey
LEFT JOIN region r6 ON e.kind = 'v6' AND r6.r_regionkey = e.user_id % 7
LEFT JOIN region rw ON e.kind = 'wide' AND rw.r_regionkey = (e.user_id % 12) // 2
"""

# the /20 network of an address, then the /28 inside it
_ISP = """LEFT JOIN supplier s ON s.s_suppkey < 480 AND s.s_suppkey % 30 = e.user_id % 30 AND s.s_suppkey // 30 = ((e.event_id // 256) % 256) // 16
LEFT JOIN supplier t ON t.s_suppkey >= 480 AND t.s_suppkey < 480 + 480 * 256 AND (t.s_suppkey % 480) % 30 = e.user_id % 30
     AND (t.s_suppkey % 480) // 30 = ((e.event_id // 256) % 256) // 16
     AND (((t.s_suppkey - 480) // 480) * 37) % 256 = (((e.event_id // 256) % 256) % 16) * 16 + (e.event_id % 256) // 16"""
_ISP_NAME = "coalesce(t.s_name, s.s_name) AS isp_name, 'org-' || coalesce(t.s_nationkey, s.s_nationkey) AS isp_organization"

ORACLES["isp"] = f"""
SELECT e.event_id, {_ISP_NAME}
FROM events e {_ISP}
"""

ORACLES["user_agent"] = f"""
SELECT {DOC_ID} AS document_id,
       (['Edge', NULL, 'Firefox', 'Safari'][user_id % 4 + 1]) AS user_agent_browser,
       (['Windows', NULL, 'Linux', 'Macintosh'][user_id % 4 + 1]) AS user_agent_os,
       (['115.0.1901.188', NULL, '115.0', '16.5'][user_id % 4 + 1]) AS user_agent_version
FROM events WHERE event_id % 50 >= 7
"""

ORACLES["pod_metadata"] = """
SELECT e.event_id, 'pod-' || (e.user_id % 30) AS pod_name, 'default' AS namespace_name, 'app' AS container_name,
       n.n_name AS nation_label,
       CASE WHEN e.event_id % 2 = 0 THEN CAST(json_extract(e.props, '$.k') AS BIGINT) END AS k,
       'custom-fluentbit' AS k8s_cluster_name
FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 30 WHERE e.event_id % 13 <> 0
"""

ORACLES["live_destination"] = f"""
SELECT 'accounts_frontend_live.events_v1' AS destination, strftime(ts, '%Y-%m-%d') AS date, {DOC_ID} AS document_id
FROM events WHERE event_id % 50 >= 7
UNION ALL
SELECT 'accounts_frontend_live.accounts_events_v1', strftime(ts, '%Y-%m-%d'), {DOC_ID} FROM events
"""

ORACLES["compacted_live"] = """
SELECT 'accounts_frontend_live.events_v1' AS destination, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, 1::BIGINT AS files
FROM events WHERE event_id % 50 >= 7 GROUP BY 2
"""

ORACLES["live_day"] = f"""
SELECT {DOC_ID} AS document_id, ts AS submission_timestamp
FROM events WHERE event_id % 50 >= 7 AND CAST(ts AS DATE) = DATE '2024-01-15'
"""

ORACLES["decoder_input"] = f"""
SELECT ts AS submission_timestamp,
       CASE WHEN event_id % 50 = 1 THEN NULL ELSE {DOC_ID} END AS document_id,
       'accounts-frontend' AS document_namespace,
       CASE WHEN event_id % 50 = 1 THEN NULL ELSE 'events' END AS document_type,
       CASE event_id % 50 WHEN 1 THEN NULL WHEN 6 THEN '99' ELSE '1' END AS document_version,
       CASE WHEN event_id % 50 = 1 THEN NULL ELSE true END AS has_payload,
       CASE WHEN event_id % 50 IN (0, 1, 5) THEN NULL ELSE 'development' END AS app_channel
FROM events WHERE event_id % 50 NOT IN (2, 3, 4) AND ts >= TIMESTAMP '2024-01-15 00:00:00'
"""

ORACLES["batch_decode"] = f"""
SELECT CASE WHEN event_id % 50 = 1 THEN NULL ELSE {DOC_ID} END AS document_id,
       ts AS submission_timestamp,
       CASE event_id % 50 WHEN 0 THEN 'missing_field' WHEN 1 THEN 'bad_envelope' WHEN 5 THEN 'bad_json'
            WHEN 6 THEN 'unknown_schema' END AS error_type,
       CASE WHEN event_id % 50 = 1 THEN NULL
            ELSE 'accounts_frontend_live.events_v' || CASE WHEN event_id % 50 = 6 THEN '99' ELSE '1' END
       END AS destination
FROM events WHERE event_id % 50 NOT IN (2, 3, 4)
"""

ORACLES["dedup_messages"] = f"""
SELECT {DOC_ID} AS message_id, CAST(event_id AS VARCHAR) AS event_id FROM events
"""

ORACLES["gunzip_payload"] = f"""
SELECT {DOC_ID} AS message_id, 'events' AS document_type, event_id % 10 <> 0 AS is_text,
       CASE WHEN event_id % 10 = 0 OR event_id % 50 IN (1, 2, 3, 4) THEN NULL ELSE {DOC_ID} END AS document_id
FROM events
"""

ORACLES["minute_windows"] = f"""
SELECT {DOC_ID} AS document_id, date_trunc('minute', ts) AS window_start,
       date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end
FROM events WHERE event_id % 50 >= 7
"""

ORACLES["timestamp_forms"] = """
SELECT event_id, date_trunc('millisecond', ts) AS js_ts, ts AS py_ts, ts AS ns_ts, ts AS rs_ts,
       date_trunc('minute', ts) AS minute_ts, CAST(NULL AS TIMESTAMP) AS unknown_ts,
       CAST(ts AS DATE) AS day_date
FROM events
"""

ORACLES["logger_settings"] = f"""
SELECT event_id,
       CAST(CASE WHEN event_id % 3 = 0 THEN user_id % 10 ELSE 2 END AS INTEGER) AS interval_s,
       CASE WHEN event_id % 5 <> 0 THEN event_type || ' ' ELSE '' END || {_MASKED_LINES} AS log
FROM events
"""

_ENRICHED = f"""n.n_name AS geo_country, CASE WHEN n.n_nationkey % 2 = 0 THEN n.n_name || ' CITY' END AS geo_city, r.r_name AS geo_subdivision1,
       {_ISP_NAME},
       (['Edge', NULL, 'Firefox', 'Safari'][user_id % 4 + 1]) AS user_agent_browser,
       (['Windows', NULL, 'Linux', 'Macintosh'][user_id % 4 + 1]) AS user_agent_os,
       (['115.0.1901.188', NULL, '115.0', '16.5'][user_id % 4 + 1]) AS user_agent_version"""
_ENRICHMENT = f"""LEFT JOIN nation n ON n.n_nationkey = e.user_id % 30 LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
{_ISP}"""

_COUNTRY = "coalesce(n.n_name, 'TEN') AS geo_country"

ORACLES["decode_enriched"] = f"""
SELECT {DOC_ID} AS document_id, ts AS submission_timestamp, {_ENRICHED.replace('n.n_name AS geo_country', _COUNTRY)},
       'accounts_frontend_live.events_v1' AS destination, false AS has_address
FROM events e {_ENRICHMENT} WHERE event_id % 50 >= 7
"""

ORACLES["decode_enriched_errors"] = f"""
WITH x AS (
  SELECT event_id, ts, {_ENRICHED.replace('n.n_name AS geo_country', _COUNTRY)} FROM events e {_ENRICHMENT} WHERE event_id % 50 IN (0, 5, 6)
  UNION ALL SELECT event_id, ts, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 50 = 1)
SELECT CASE WHEN event_id % 50 = 1 THEN NULL ELSE {DOC_ID} END AS document_id,
       CASE event_id % 50 WHEN 0 THEN 'missing_field' WHEN 1 THEN 'bad_envelope' WHEN 5 THEN 'bad_json' ELSE 'unknown_schema' END AS error_type,
       ts AS submission_timestamp, strftime(ts, '%Y-%m-%d') AS date,
       geo_country, geo_city, geo_subdivision1, isp_name, isp_organization, user_agent_browser, user_agent_os, user_agent_version, false AS has_address
FROM x
"""

ORACLES["live_errors"] = f"""
SELECT CASE WHEN event_id % 50 = 1 THEN NULL ELSE {DOC_ID} END AS document_id,
       CASE event_id % 50 WHEN 0 THEN 'missing_field' WHEN 1 THEN 'bad_envelope' WHEN 5 THEN 'bad_json' ELSE 'unknown_schema' END AS error_type,
       CASE event_id % 50 WHEN 0 THEN 'ValidationException' WHEN 1 THEN 'InvalidEnvelopeException'
            WHEN 5 THEN 'MalformedPayloadException' ELSE 'SchemaNotFoundException' END AS exception_class,
       ts AS submission_timestamp, strftime(ts, '%Y-%m-%d') AS date, 'log' AS input_type, true AS no_address
FROM events WHERE event_id % 50 IN (0, 1, 5, 6)
"""

ORACLES["decoder_input_days"] = f"""
SELECT ts AS submission_timestamp, CASE WHEN event_id % 50 = 1 THEN NULL ELSE {DOC_ID} END AS document_id,
       event_id % 50 <> 1 AS has_payload
FROM events WHERE event_id % 50 NOT IN (2, 3, 4) AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
"""

ORACLES["dirty_input"] = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' || event_id WHEN 1 THEN 'a' || event_id || 'b' || event_id END AS text,
       CASE event_id % 4 WHEN 2 THEN ts WHEN 3 THEN date_trunc('millisecond', ts) END AS parsed,
       CASE WHEN event_id % 5 = 0 THEN 'bad_json' END AS error_type, CASE WHEN event_id % 5 = 0 THEN '7BFF22' END AS bytes,
       'bad_envelope' AS cut_off_type
FROM events
"""

ORACLES["container_logs"] = f"""
SELECT doc_id AS pod, 'ns-' || (doc_id % 5) AS namespace, {_masked("replace(text, chr(10), ' ')")} || chr(10) AS log,
       CAST(NULL AS VARCHAR) AS mail, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS nation_label, 'custom-fluentbit' AS k8s_cluster_name
FROM documents
UNION ALL
SELECT doc_id, 'ns-' || (doc_id % 5), {_masked("'no record ' || doc_id")}, NULL, NULL, NULL, 'custom-fluentbit' FROM documents WHERE doc_id % 10 = 0
UNION ALL
SELECT user_id % 30, 'default', '{{"id":' || event_id || ',"mail":"{EMAIL_MASK}"}}' || chr(10), '{EMAIL_MASK}', event_id, n.n_name, 'custom-fluentbit'
FROM events LEFT JOIN nation n ON n.n_nationkey = user_id % 30
"""

ORACLES["ping_lines"] = f"""
SELECT {DOC_ID} AS document_id, CAST(user_id AS VARCHAR) AS account, 'accounts_frontend_live.events_v1' AS destination FROM events
"""

ORACLES["table_like"] = """
SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, CAST(0 AS BIGINT) AS n_before FROM events GROUP BY 1
"""

ORACLES["random_document_ids"] = "SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_uuid FROM events"

ORACLES["window_counts"] = """
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
       'accounts_frontend_live.events_v1' AS destination, count(*) AS n
FROM events WHERE event_id % 50 >= 7 GROUP BY 1, 2
"""

ORACLES["pull_messages"] = """
SELECT least(10, count(*)) AS n, least(10, count(*)) AS n_distinct, least(10, count(*)) AS n_known FROM events
"""

ORACLES["schema_errors"] = """
WITH d AS (
  SELECT event_id, CASE WHEN event_id % 20 = 9 THEN '3' ELSE CAST(event_id // 20 % 2 + 1 AS VARCHAR) END AS version,
         event_id % 20 AS r, event_id // 40 % 2 = 0 AS has_seq FROM events),
f AS (
  SELECT event_id, version, CASE
    WHEN r = 8 THEN ['$ json']
    WHEN r = 9 THEN ['$ schema']
    ELSE list_sort(list_concat(
      CASE WHEN version = '2' AND NOT has_seq THEN ['$.seq required'] ELSE [] END,
      CASE r WHEN 0 THEN ['$.id type'] WHEN 1 THEN ['$.kind required'] WHEN 2 THEN ['$.kind pattern']
             WHEN 3 THEN ['$.user minimum'] WHEN 4 THEN ['$ additionalProperties'] WHEN 5 THEN ['$.tags minItems']
             WHEN 6 THEN ['$.tags maxItems'] WHEN 7 THEN ['$.tags[] type'] WHEN 10 THEN ['$.channel enum']
             WHEN 11 THEN ['$.name minLength'] WHEN 12 THEN ['$.ratio exclusiveMaximum'] WHEN 13 THEN ['$.labels{} type']
             WHEN 14 THEN ['$.kind required', '$.user minimum', '$.user type'] WHEN 15 THEN ['$.form const']
             WHEN 17 THEN ['$.name maxLength'] ELSE [] END)) END AS failures
  FROM d)
SELECT event_id, version, CAST(len(failures) AS BIGINT) AS n_failures, array_to_string(failures, '; ') AS failures FROM f
"""

ORACLES["redelivered"] = """
SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS message_id, CASE WHEN event_id % 3 = 0 THEN 'second' ELSE 'first' END AS stream,
       CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS publish_time
FROM events
"""
