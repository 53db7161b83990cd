"""What the write paths read, parse and land, beside their results."""

import tempfile

from pyspark.sql import functions as F

from lograft import schemas as S
from lograft.operators import decode as D
from lograft.operators import pipeline as PL
from lograft.plans.event_lines import events_to_log_lines
from lograft.sinks import live as LV


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, n=100):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7200)
    return spark.range(n).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 40).alias("user_id"),
                                 F.lit("view").alias("event_type"), F.lit('{"k": 1}').alias("props"))


def landed_by_write(spark, routed, monkeypatch):
    """(columns, good rows with source text) of what write_routed lands, if any, and its two tables."""
    base, seen, removed = tempfile.mkdtemp(prefix="lograft-cost-"), [], LV.remove

    def look(spark, path):
        df = spark.read.parquet(path)
        seen.append((set(df.columns), df.filter("error_type is null and raw is not null").count()))
        removed(spark, path)

    monkeypatch.setattr(LV, "remove", look)
    LV.write_routed(routed, f"{base}/decoded", f"{base}/error")
    return seen, LV.read_live(spark, f"{base}/decoded"), LV.read_errors(spark, f"{base}/error")


def test_pipeline_rows_are_not_landed_again(spark, monkeypatch):
    lines = events_to_log_lines(events(spark))
    want = D.decode(lines, S.registry(spark))
    routed = PL.decode_pipeline(lines, PL.prepare(S.registry(spark)))
    seen, live, errors = landed_by_write(spark, routed, monkeypatch)
    assert len(seen) == 1 and "payload" not in seen[0][0]          # the pipeline's own, without the parsed text
    assert live.count() == D.decoded(want).count() > 80
    assert errors.select(F.col("payload").cast("string")).exceptAll(D.errors(want).select(F.col("payload").cast("string"))).count() == 0
    assert errors.count() == D.errors(want).count() == 8


def test_good_rows_are_landed_without_their_source(spark, monkeypatch):
    routed = D.decode(events_to_log_lines(events(spark)), S.registry(spark))
    seen, live, errors = landed_by_write(spark, routed, monkeypatch)
    assert len(seen) == 1 and "payload" not in seen[0][0] and seen[0][1] == 0
    assert live.count() == D.decoded(routed).count()
    assert sorted(r[0] for r in errors.select("payload").collect()) == sorted(r[0] for r in D.errors(routed).select("payload").collect())


def test_each_text_is_parsed_once(spark):
    p = plan(D.decode(events_to_log_lines(events(spark)).localCheckpoint(), S.registry(spark)))
    assert p.count("from_json(") == 2          # envelope and payload


def test_routing_steps_are_generated_code(spark):
    p = plan(D.decode(events_to_log_lines(events(spark)).localCheckpoint(), S.registry(spark)))
    # each would copy the row, source text included; the one lambda left is the registry's
    assert "Generate" not in p and p.count("lambdafunction(") == 1


def test_null_among_required_paths_is_no_path(spark):
    rows = [("accounts-frontend", "events", "1", ["client_info", None, "ping_info"])]
    out = D.decode(events_to_log_lines(events(spark, 50)), S.registry(spark, rows))
    assert {(r.error_type, r.error_message, r["count"]) for r in out.filter("error_type is null or error_type = 'missing_field'").groupBy("error_type", "error_message").count().collect()} \
        == {(None, None, 43), ("missing_field", "missing required field: client_info", 1)}


def test_pipeline_lands_good_rows_without_source(spark):
    lines = events_to_log_lines(events(spark))
    # a good row without an address has it in no column, but its source text may
    lines = lines.unionByName(lines.filter("event_id = 8").selectExpr("event_id", "replace(value, '\"ip_address\":', '\"no_address\":') as value"))
    lookups = PL.prepare(S.registry(spark))
    whole, slim = PL.decode_pipeline(lines, lookups), PL.decode_pipeline(lines, lookups, good_source=False)
    good = [spark.read.parquet(x._made_from[0]._landed).filter("error_type is null and raw is not null").count() for x in (whole, slim)]
    assert good == [D.decoded(whole).count(), 1] and good[0] > 80
    for part in (D.decoded, D.errors):
        a, b = [sorted(str(r) for r in part(x).collect()) for x in (whole, slim)]
        assert a == b and a


def test_scrubbing_cases(spark):
    rows = [('{"ip_address" : "10.1.2.3", "t": "at 10.1.2.3, 110.1.2.3 and 10.1.2.3.4"}', "10.1.2.3", '{"ip_address" : "", "t": "at , 110.1.2.3 and 10.1.2.3.4"}'),
            ('{"ip_address":"a\\"b\\\\","x":"a"}', "a", '{"ip_address":"","x":"a"}'),
            ('{"ip_address":"2a02::1","x":"2a02::1 2a02::12"}', None, '{"ip_address":"","x":" 2a02::12"}'),
            ('{"ip_address":"10.0.0.9","x":"10.0.0.9"}', "", '{"ip_address":"","x":""}'),
            ("no member 10.0.0.7", "10.0.0.7", "no member "), ("nothing", None, "nothing"), (None, "10.0.0.7", None)]
    df = spark.createDataFrame([r[:2] for r in rows], "raw string, ip string")
    out = df.select(D.scrub_text(F.col("raw"), F.col("raw"), F.col("ip")).alias("t"))
    assert [r.t for r in out.collect()] == [r[2] for r in rows]
    assert "lambda" not in plan(df.localCheckpoint().select(D.scrub_text(F.col("raw"), F.col("raw"), F.col("ip"))))
