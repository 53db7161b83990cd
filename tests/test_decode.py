import json

from pyspark.sql import functions as F

from lograft import schemas as S
from lograft.operators import decode as D
from lograft.operators import pipeline as PL

GOOD_PAYLOAD = json.dumps({
    "client_info": {"telemetry_sdk_build": "b", "first_run_date": "Unknown", "os": "Unknown",
                    "os_version": "Unknown", "architecture": "Unknown", "app_build": "Unknown",
                    "app_display_version": "0.0.1", "app_channel": "development"},
    "ping_info": {"seq": 0, "start_time": "2024-03-05T07:08:09.010Z", "end_time": "2024-03-05T07:08:09.010Z"},
    "metrics": {"string": {"identifiers.fxa_account_id": "abc"}},
    "events": [{"category": "backend", "name": "object_update", "timestamp": 1709622489010,
                "extra": {"object_type": "unknown", "object_state": "great", "linking": "undefined"}}],
})


ADDRESS = "203.0.113.77"


def test_no_address_in_any_output(spark):
    fields = {"document_namespace": "accounts-frontend", "document_type": "events", "document_version": "1", "document_id": "d",
              "ip_address": ADDRESS, "user_agent": f"agent of {ADDRESS}", "payload": GOOD_PAYLOAD}
    bad = {**fields, "payload": f"not json, sent from {ADDRESS}"}
    geo = spark.createDataFrame([("203.0.113.0", "203.0.113.255", "Land", "Town", None, None)], "lo string, hi string, country string, city string, subdivision1 string, subdivision2 string")
    isp = spark.createDataFrame([("203.0.0.0", "203.255.255.255", "Net", "Org")], "lo string, hi string, name string, organization string")
    routed = PL.decode_pipeline(lines(spark, [envelope(None, fields=fields), envelope(None, fields=bad), envelope(None, fields=fields)[:-3]]),
                                PL.prepare(S.registry(spark), geo, isp))
    good, err = D.decoded(routed), D.errors(routed)
    assert good.first().geo_country == "Land" and good.first().isp_name == "Net"
    got = {r.error_type: r for r in err.collect()}
    assert got["bad_json"].geo_city == "Town" and got["bad_json"].isp_organization == "Org"
    assert ADDRESS.encode() not in bytes(got["bad_json"].payload) and b"not json, sent from" in bytes(got["bad_json"].payload)
    assert ADDRESS.encode() not in bytes(got["bad_envelope"].payload)
    assert ADDRESS not in str(good.collect())


def envelope(payload, version="1", fields=None, typ="glean-server-event"):
    f = fields if fields is not None else {
        "document_namespace": "accounts-frontend", "document_type": "events", "document_version": version,
        "document_id": "00000000-1111-2222-3333-444444444444", "payload": payload}
    return json.dumps({"Timestamp": 1709622489016000000, "Logger": "demo-app-glean", "Type": typ,
                       "Severity": 6, "Pid": 1, "EnvVersion": "2.0", "Fields": f})


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_routing_fixtures(spark):
    no_client = json.loads(GOOD_PAYLOAD)
    del no_client["client_info"]
    vals = [
        "non-event log line",
        "test py logger",
        '{"Type":"glean-server-event","Fields":{}}',
        envelope(json.dumps(no_client)),
        json.dumps({"Type": "glean-server-event-from-dict", "Fields": {"timestamp": "x", "event_name": "test"}}),
        "",
        '{"Type":"glean-server-event","Fields":"x"}',
        envelope(GOOD_PAYLOAD[: len(GOOD_PAYLOAD) // 2]),
        envelope(GOOD_PAYLOAD, version="99"),
        envelope(GOOD_PAYLOAD),
        envelope(GOOD_PAYLOAD)[:130],                      # cut off inside the envelope, tag still there
        '{"note": "about \\"glean-server-event\\" records"}',
    ]
    assert '"glean-server-event"' in vals[-2]
    routed = D.decode(lines(spark, vals), S.registry(spark))
    got = sorted((r.error_type or "ok") for r in routed.collect())
    assert got == sorted(["bad_envelope", "missing_field", "bad_envelope", "bad_json", "unknown_schema", "ok", "bad_envelope"])
    e = D.errors(routed)
    assert len(e.columns) == 45
    assert e.filter(F.col("error_type") == "missing_field").first().error_message == "missing required field: client_info"
    # original bytes are kept
    assert all(bytes(r.payload).decode().startswith("{") for r in e.collect())


def test_good_row_decodes(spark):
    d = D.decoded(D.decode(lines(spark, [envelope(GOOD_PAYLOAD)]), S.registry(spark))).first()
    assert d.metrics["string"]["identifiers.fxa_account_id"] == "abc"
    assert d.events[0].extra["linking"] == "undefined"
    assert d.destination == "accounts_frontend_live.events_v1"
    assert str(d.submission_timestamp) == "2024-03-05 07:08:09.016000"


def test_regex_filter_keeps_variants(spark):
    vals = [json.dumps({"Type": t, "Fields": {}}) for t in
            ["glean-server-event", "glean-server-event-from-dict", "glean-server-event-with-prefix",
             "glean-server-even", "other"]]
    r = D.filter_event_records(lines(spark, vals), S.EVENT_LOG_TYPE_PATTERN)
    assert r.count() == 4
    assert D.parse_envelope(lines(spark, vals)).count() == 1


def test_decoded_plus_errors_equals_event_typed(spark):
    from lograft.plans.event_lines import events_to_log_lines

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ls = events_to_log_lines(ev)
    routed = D.decode(ls, S.registry(spark)).cache()
    typed = D.parse_envelope(ls).count()
    assert D.decoded(routed).count() + D.errors(routed).count() == typed == routed.count()
    routed.unpersist()


def test_encode_decode_round_trip(spark):
    from lograft.plans.event_lines import events_to_log_lines

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    d = D.decoded(D.decode(events_to_log_lines(ev, with_faults=False), S.registry(spark)))
    got = d.select(F.col("metrics")["string"]["identifiers.fxa_account_id"].alias("uid"),
                   F.element_at("events", 1).getField("extra")["object_type"].alias("t"),
                   F.element_at("events", 1).getField("extra")["object_state"].alias("p"),
                   F.col("submission_timestamp").cast("timestamp_ntz").alias("ts"))
    want = ev.select(F.col("user_id").cast("string").alias("uid"), F.col("event_type").alias("t"),
                     F.col("props").alias("p"), "ts")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_only_addresses_are_scrubbed(spark):
    """A value that is no address is blanked where it stands as the member and
    nowhere else; an address goes where it stands by itself."""
    rows = [
        ('{"Type":"glean","ip_address":"e","x":"eve"}', "e", '{"Type":"glean","ip_address":"","x":"eve"}'),
        ('{"ip_address":"1.1.1.1","a":"11.1.1.1 1.1.1.11 1.1.1.1.1 1.1.1.1, 1.1.1.1:80 x1.1.1.1."}', "1.1.1.1",
         '{"ip_address":"","a":"11.1.1.1 1.1.1.11 1.1.1.1.1 , :80 x."}'),
        ('{"ip_address" : "::1","a":"fe80::1 [::1]:80 ::11 ::1"}', "::1", '{"ip_address" : "","a":"fe80::1 []:80 ::11 "}'),
        ('{"ip_address":"2001:db8::7","a":"2001:db8::7 2001:db8::77 12001:db8::7"}', "2001:db8::7", '{"ip_address":"","a":" 2001:db8::77 12001:db8::7"}'),
        ('{"ip_address":"a\\"b","c":"a"}', None, '{"ip_address":"","c":"a"}'),
        ('{"ip_address":"9.9.9.9","c":"9.9.9.9"} broken', None, '{"ip_address":"","c":""} broken'),
        ('{"a":"no member, \\\\E$1"}', "$1", '{"a":"no member, \\\\E$1"}'),
        ('{"a":"7.7.7.7"}', "7.7.7.7", '{"a":""}'),
        (None, "1.1.1.1", None),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "raw string, ip string").select(D.scrub_text(F.col("raw"), F.col("raw"), F.col("ip")).alias("t"))
    assert [r.t for r in df.collect()] == [r[2] for r in rows]
