"""Inputs spread by their rows; tables written by day."""

import tempfile

from pyspark.sql import functions as F

from lograft.operators.partitioning import ensure_parallelism
from lograft.plans import queries as QS
from lograft.sinks import live as LV


def events(spark, n=100):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7200)
    return spark.range(n).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 40).alias("user_id"),
                                 F.lit("view").alias("event_type"), F.lit('{"k": 1}').alias("props"))


def test_inputs_are_spread_by_their_rows(spark):
    path = tempfile.mkdtemp(prefix="lograft-spread-") + "/t"
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert ensure_parallelism(df, 2, rows=100).rdd.getNumPartitions() == 10
    assert ensure_parallelism(df, 2).rdd.getNumPartitions() == 2 and ensure_parallelism(df, 1).rdd.getNumPartitions() == 1
    assert ensure_parallelism(df, 2, rows=100).count() == 1000


def test_decoder_input_has_a_file_a_day(spark):
    base = tempfile.mkdtemp(prefix="lograft-days-")
    events(spark, 200).repartition(6).write.parquet(f"{base}/events.parquet")
    df = LV.read_table(spark, QS._decoder_input_table(spark, base))
    files = df.select("date", F.input_file_name().alias("f")).distinct().count()
    assert files == df.select("date").distinct().count() > 10
