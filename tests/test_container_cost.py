"""Container records are parsed once, and recombined in one order."""

from pyspark.sql import functions as F

from lograft.functions.jsontext import json_object_or_null
from lograft.operators.container import container_logs
from lograft.operators.recombine import recombine_lines, unterminated


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_objects_only_and_no_parse_of_other_text(spark):
    rows = ['{"a":1}', ' \t\r\n{"a":2}', "{}", "[1]", "3", "{cut", "plain", '"{"', "", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = df.select(F.to_json(json_object_or_null(F.col("t"))).alias("j")).collect()
    assert [r.j for r in got] == ['{"a":1}', '{"a":2}', "{}"] + [None] * 7
    assert "schema_of_variant" not in plan(df.localCheckpoint().select(json_object_or_null(F.col("t"))))


def test_container_records_are_parsed_once(spark):
    path = "/var/log/containers/web-1_shop_app-" + "a" * 64 + ".log"
    lines = spark.createDataFrame([(path, '{"log":"a\\\\n","stream":"stdout","time":"2024-01-01T00:00:01Z"}')], "file_path string, value string")
    pods = spark.createDataFrame([("web-1", "shop", "app", {"team": "t"})], "pod string, namespace string, container string, labels map<string,string>")
    assert "from_json" not in plan(container_logs(lines, pods))


def test_messages_over_many_chunks(spark):
    """Against a plain pass, with equal times and chunks without a terminator."""
    rows, want = [], []
    for f in ("a", "b"):
        message = []
        for i in range(120):
            text = f"{i:03d}" + ("\n" if (i * i) % 17 == (3 if f == "a" else 5) else "")
            rows.append((f, i // 3 * 3, text))
            message.append(text)
            if text.endswith("\n"):
                want.append((f, "".join(message)))
                message = []
        rest = message
        want.append((f, "".join(rest)))
    df = spark.createDataFrame(rows[::-1], "file string, n long, log string")
    got = recombine_lines(df, "file", "n", "log", chunk_width=7)
    assert sorted((r.file, r.message) for r in got.collect()) == sorted(want)
    assert sorted(r.log for r in unterminated(df, "file", "n", "log", chunk_width=7).filter("file = 'b'").collect()) == rest
