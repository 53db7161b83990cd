import pytest
from pyspark.sql import functions as F

from lograft import session as SE
from lograft.operators import enrich as EN
from lograft.operators import joins as J
from lograft.operators.container import container_logs
from lograft.sources import textlogs as TL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_follows_bytes_not_rows(spark):
    few_wide = spark.range(3).select("id", F.repeat(F.lit("x"), 10_000).alias("t"), F.array_repeat(F.lit("label"), 500).alias("a"))
    many_thin = spark.range(3000)
    assert J.measured_bytes(few_wide) > J.measured_bytes(many_thin.limit(10)) * 100
    assert not J.prepare_lookup(few_wide, 20_000).small and J.prepare_lookup(many_thin, 200_000).small
    big = spark.range(10)
    assert "BroadcastHashJoin" in plan(J.lookup_join(big, J.Lookup(many_thin, True), "id"))


def test_checkpoint_folder_must_be_shared_off_local(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        SE.checkpoint_dir(Session())


def test_each_line_is_matched_once(spark):
    df = spark.createDataFrame([("x", "apache")], "value string, format string")
    p = plan(df.select(TL.parse_by_format(F.col("value"), F.col("format"), year=F.lit(2024)).alias("p")).select("p.host", "p.time", "p.ts"))
    assert "RLIKE" not in p and "regexp_extract" not in p
    # one branch a format over the escaped line, one taken a line
    assert p.count("regexp_replace(replace(replace(value") == len(TL.FORMATS)


def test_routing_by_tag_leaves_other_inputs_out(spark):
    df = spark.createDataFrame([("kube.var.log.a",), ("host.messages",), ("kubex",)], "tag string")
    assert [r.tag for r in EN.route_by_tag(df, "kube.*").collect()] == ["kube.var.log.a"]


def test_container_path_holds_no_clear_value(spark):
    t = "2024-01-01T00:00:0{}Z"
    path = "/var/log/containers/web-1_shop_app-" + "a" * 64 + ".log"
    frag = lambda i, text: (path, '{"log":"%s","stream":"stdout","time":"%s"}' % (text, t.format(i)))
    rows = [frag(1, '{\\"mail\\": \\"jo@exa'), frag(2, 'mple.org\\", \\"ssn\\": \\"999-88-7777\\"}\\n'), frag(3, "plain a@b.io\\n"), (path, "x" * 300)]
    lines = spark.createDataFrame(rows, "file_path string, value string")
    pods = spark.createDataFrame([("web-1", "shop", "app", {"team": "t"})], "pod string, namespace string, container string, labels map<string,string>")
    got = container_logs(lines, pods, labels={"region": "r"}, max_bytes=200).select("log", F.to_json("log_processed").alias("parsed"), "pod_labels", "region", "parts").collect()
    got = {r.parts: r for r in got}
    assert len(got) == 2 and "jo@" not in str(got) and "a@b.io" not in str(got) and "999-88" not in str(got)
    assert "user@email.tld" in got[2].parsed and got[2].pod_labels == {"team": "t"} and got[1].region == "r"
