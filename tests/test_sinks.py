import json
import tempfile

from pyspark.sql import functions as F

from lograft.sinks import live as LV


def test_table_helpers(spark):
    base = tempfile.mkdtemp(prefix="lograft-sinks-")
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id int, s string, n string")
    LV.replace_table(df, f"{base}/t")                                   # K3
    LV.replace_table(df.filter("id = 1"), f"{base}/t")                  # replaced, not appended
    assert LV.read_table(spark, f"{base}/t").count() == 1
    empty = LV.create_table_like(spark, df, f"{base}/like")             # K4
    assert empty.count() == 0 and empty.schema == LV.read_table(spark, f"{base}/t").schema
    recs = [json.loads(r.value) for r in LV.json_records(df).collect()]  # K7: NULLs left out
    assert recs == [{"id": 1, "s": "a"}, {"id": 2, "s": "b", "n": "x"}]
    LV.write_lines(LV.json_records(df), f"{base}/lines")                # K9
    assert spark.read.text(f"{base}/lines").count() == 2
    assert LV.shard(df, 3).rdd.getNumPartitions() == 3                  # W3
    assert LV.with_day(df.withColumn("submission_timestamp", F.lit("2024-01-02 03:04:05").cast("timestamp"))).first().date == "2024-01-02"
    assert LV.with_day(df.withColumn("submission_timestamp", F.lit(None).cast("timestamp"))).filter("date is null").count() == 0
