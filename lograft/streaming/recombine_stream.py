"""S4 in streaming: rejoin split container lines across micro-batches.

Each micro-batch is recombined together with the fragments that earlier ones
left without a terminator. Finished messages go to `<out>/messages`, the new
tail to `<out>/tails`, both under the stream's name and the batch's number: a
replayed batch reads the same earlier tail and replaces its own output, and
streams with checkpoints of their own share a folder without touching each
other's rows. A tail whose youngest fragment was received longer than
`flush_after` before the batch's youngest line is emitted as it is (the agent's
flush), so the tail stays bounded in time. Nothing landed outlives its batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.recombine import recombine_lines, unterminated
from ..sinks.files import drop, land, remove

TAIL_SCHEMA = "file string, n long, text string, received timestamp"


def stream_name(checkpoint_location: str) -> str:
    """A stream is its checkpoint: the same one resumes, another is another stream."""
    return hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:16]


def start_recombine(lines: DataFrame, out_base: str, checkpoint_location: str, *, file_col: str = "file_path", order_col: str = "n",
                    text_col: str = "log", received_col: str = "received", flush_after: str = "10 seconds",
                    available_now: bool = False, trigger_interval: str | None = None) -> StreamingQuery:
    """Start the stream; `order_col` is a bigint (nanoseconds)."""
    spark = lines.sparkSession
    x = lines.select(F.col(file_col).alias("file"), F.col(order_col).cast("long").alias("n"),
                     F.col(text_col).alias("text"), F.col(received_col).cast("timestamp").alias("received"))
    name = stream_name(checkpoint_location)

    def at(kind: str, batch_id: int) -> str:
        return f"{out_base}/{kind}/stream={name}/batch={batch_id}"

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch_id > 0:
            batch = batch.unionByName(spark.read.schema(TAIL_SCHEMA).parquet(at("tails", batch_id - 1)))
        # rows get a key of their own, so that equal fragments stay apart
        rows = land(batch.withColumn("row", F.monotonically_increasing_id()), "fragments")
        try:
            last = unterminated(rows, "file", "n", "text")
            now = rows.agg(F.max("received")).first()[0]
            young = last.groupBy("file").agg(F.max("received").alias("at")).filter(F.col("at") >= F.lit(now) - F.expr(f"INTERVAL {flush_after}"))
            tail = land(last.join(young.select("file"), "file", "left_semi").select("file", "n", "text", "received", "row"), "tail")
            try:
                # by key: the text of finished messages is not shuffled to find the rest
                done = rows.join(tail.select("row"), "row", "left_anti").select("file", "n", "text")
                recombine_lines(done, "file", "n", "text").write.mode("overwrite").parquet(at("messages", batch_id))
                tail.drop("row").write.mode("overwrite").parquet(at("tails", batch_id))
            finally:
                drop(tail)
        finally:
            drop(rows)
        if batch_id > 1:
            remove(spark, at("tails", batch_id - 2))

    w = x.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_interval:
        w = w.trigger(processingTime=trigger_interval)
    return w.start()
