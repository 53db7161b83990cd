import os
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lograft import schemas as S
from lograft.operators import decode as D
from lograft.operators import pipeline as PL
from lograft.operators.recombine import recombine_lines
from lograft.plans.event_lines import events_to_log_lines
from lograft.session import checkpoint_dir
from lograft.sinks import live as LV
from lograft.sources import logs as SRC
from lograft.sources import queue as Q
from lograft.streaming.decode_stream import start_decoder
from lograft.streaming.recombine_stream import start_recombine


def event_lines(spark):
    return events_to_log_lines(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))


def run(spark, source, base, checkpoint, **kw):
    q = start_decoder(spark, source, f"{base}/out", checkpoint, available_now=True, decoded_shards=2, error_shards=1, **kw)
    q.awaitTermination(300)


def same(a, b):
    """All columns, both ways (maps and structs as text)."""
    text = lambda df: df.select(*[F.to_json(F.struct(c)).alias(c) if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in sorted(df.dtypes)])
    a, b = text(a), text(b)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def outputs(spark, base):
    return LV.read_live(spark, f"{base}/out/decoded"), LV.read_errors(spark, f"{base}/out/error")


def test_stream_equals_batch_and_streams_add_up(spark):
    base = tempfile.mkdtemp(prefix="lograft-stream-")
    event_lines(spark).select("value").repartition(3).write.text(f"{base}/in")
    run(spark, f"{base}/in/*.txt", base, f"{base}/ck1", max_files_per_trigger=1)
    routed = PL.decode_pipeline(SRC.read_logs(spark, f"{base}/in/*.txt"), PL.prepare(S.registry(spark)), received_col="received")
    dec, err = outputs(spark, base)
    want = LV.with_day(D.decoded(routed)).withColumn("date", F.to_date("date"))
    same(dec.withColumn("date", F.to_date("date")), want)
    same(err, D.errors(routed))
    # the same checkpoint goes on where it was, a new one adds its own rows
    n = dec.count()
    run(spark, f"{base}/in/*.txt", base, f"{base}/ck1")
    assert outputs(spark, base)[0].count() == n
    run(spark, f"{base}/in/*.txt", base, f"{base}/ck2")
    assert outputs(spark, base)[0].count() == 2 * n


def test_replayed_batch_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="lograft-replay-")
    routed = D.decode(event_lines(spark), S.registry(spark))
    for batch in (("s", 0), ("s", 1), ("s", 1)):
        LV.write_routed(routed, f"{base}/out/decoded", f"{base}/out/error", batch=batch, decoded_shards=1, error_shards=1)
    assert outputs(spark, base)[0].count() == 2 * D.decoded(routed).count()
    assert outputs(spark, base)[1].count() == 2 * D.errors(routed).count()


def test_batch_write_is_compact_and_day_read_prunes(spark):
    base = tempfile.mkdtemp(prefix="lograft-live-")
    routed = D.decode(event_lines(spark).repartition(8), S.registry(spark))
    LV.write_routed(routed, f"{base}/d", f"{base}/e")
    days = LV.read_live(spark, f"{base}/d").select("date", "destination").distinct().count()
    assert len(list(Path(f"{base}/d").rglob("*.parquet"))) <= 2 * days
    day = LV.read_live(spark, f"{base}/d", "accounts_frontend_live.events_v1", "2024-01-15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    want = D.decoded(routed).filter(F.to_date("submission_timestamp") == "2024-01-15").count()
    assert day.count() == want
    assert not [p for p in Path(f"{base}/e").iterdir() if "HIVE_DEFAULT" in p.name]


def messages(spark):
    lines = event_lines(spark).select("event_id", "value")
    m = lines.select(F.col("event_id").cast("string").alias("message_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("event_id")).alias("publish_time"),
                     F.when(F.col("event_id") % 10 != 0, Q.gzip_bytes(F.col("value").cast("binary"))).otherwise(F.col("value").cast("binary")).alias("data"),
                     F.create_map(F.lit("k"), F.lit("v")).alias("attributes"))
    return m.unionByName(m.filter("cast(message_id as int) % 7 = 0"))


def test_queue_messages_decode_once(spark):
    base = tempfile.mkdtemp(prefix="lograft-queue-")
    m = messages(spark)
    landed = lambda: {p for p in Path(checkpoint_dir(spark).removeprefix("file:")).parent.rglob("routed-*")}
    held = landed()
    m.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(S.QUEUE_MESSAGE).parquet(f"{base}/in")
    run(spark, stream, base, f"{base}/ck")
    assert landed() == held          # nothing of a batch stays behind
    routed = PL.decode_pipeline(Q.read_messages(m), PL.prepare(S.registry(spark)), received_col="received")
    dec, err = outputs(spark, base)
    same(dec.drop("date"), D.decoded(routed))
    same(err, D.errors(routed))
    assert dec.filter("submission_timestamp is null").count() == 0


def test_streaming_dedup_within_watermark(spark):
    base = tempfile.mkdtemp(prefix="lograft-dedup-")
    rows = [("m1", "2024-01-01 00:00:00"), ("m1", "2024-01-01 00:00:05"), ("m2", "2024-01-01 00:00:06")]
    spark.createDataFrame(rows, "message_id string, t string").write.mode("overwrite").json(f"{base}/in")
    s = spark.readStream.schema("message_id string, t string").json(f"{base}/in") \
        .withColumn("publish_time", F.col("t").cast("timestamp"))
    q = Q.dedup_messages(s, "message_id", "publish_time").writeStream.format("memory") \
        .queryName("dedup_t").option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.message_id for r in spark.table("dedup_t").collect()) == ["m1", "m2"]


@pytest.mark.parametrize("flush_after,tail", [("1 hour", False), ("1 second", True)])
def test_recombine_stream(spark, flush_after, tail):
    base = tempfile.mkdtemp(prefix="lograft-recombine-")
    parts = [("a", 1, "one ", 0), ("b", 1, "x\n", 0), ("a", 2, "two ", 1), ("c", 1, "old", 0), ("a", 3, "three\n", 2), ("b", 2, "y", 2), ("b", 3, "z\n", 2)]
    schema = "file_path string, n long, log string, received timestamp"
    for k in range(3):
        spark.createDataFrame([(f, n, t, k) for f, n, t, b in parts if b == k], "file_path string, n long, log string, k long") \
            .withColumn("received", F.timestamp_seconds(F.lit(1704067200) + F.col("k") * 10)).drop("k").coalesce(1).write.mode("append").json(f"{base}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{base}/in")
    start_recombine(stream, base, f"{base}/ck", flush_after=flush_after, available_now=True).awaitTermination(300)
    got = sorted((r.file, r.message) for r in spark.read.parquet(f"{base}/messages").collect())
    if tail:        # tails older than the timeout are flushed
        assert ("c", "old") in got and "".join(m for f, m in got if f == "b") == "x\nyz\n"
    else:
        rows = spark.createDataFrame([p[:3] for p in parts], "file string, n long, text string")
        want = sorted((r.file, r.message) for r in recombine_lines(rows, "file", "n", "text").collect() if r.message.endswith("\n"))
        assert got == want


def test_recombine_streams_share_a_folder(spark):
    """Two checkpoints on one folder keep their rows, equal fragments stay apart, and nothing landed is left behind."""
    base = tempfile.mkdtemp(prefix="lograft-recombine-two-")
    schema = "file_path string, n long, log string, received timestamp"
    landed = lambda: [f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith(("fragments-", "tail-"))]
    before = landed()
    for name, rows in (("one", [("a", 1, "fir"), ("a", 2, "st\n"), ("b", 1, "x"), ("b", 1, "x"), ("b", 2, "\n")]), ("two", [("a", 1, "second\n")])):
        spark.createDataFrame([(*r, None) for r in rows], schema).coalesce(1).withColumn("received", F.lit("2024-01-01").cast("timestamp")).write.json(f"{base}/{name}")
        stream = spark.readStream.schema(schema).json(f"{base}/{name}")
        start_recombine(stream, base, f"{base}/ck-{name}", available_now=True).awaitTermination(300)
    assert sorted((r.file, r.message) for r in spark.read.parquet(f"{base}/messages").collect()) == [("a", "first\n"), ("a", "second\n"), ("b", "xx\n")]
    assert sorted(landed()) == sorted(before)
