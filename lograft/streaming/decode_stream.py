"""Structured Streaming decoder.

Each micro-batch runs the same `decode_pipeline` as the batch path inside
`foreachBatch`; both outputs become visible in one commit that bears the stream's
name and the batch's number, so a batch replayed after a failure adds nothing
twice, and the checkpoint advances only after it (acknowledge after processing).
Files are rebalanced on day and destination and, every so many batches, packed.
Lookup tables are prepared once per stream.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators.pipeline import Lookups, decode_pipeline, prepare
from ..sinks import live as LV
from ..sources import logs as SRC
from ..sources import queue as Q

# Window (output pacing) of the streaming decoder.
WINDOW = "1 minute"
# End of fixed values.


def stream_name(checkpoint_location: str) -> str:
    """A stream is its checkpoint: the name survives restarts, a new checkpoint
    gets a new one."""
    return hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:12]


def start_decoder(spark: SparkSession, source: str | DataFrame, out_base: str, checkpoint_location: str, *,
                  lookups: Lookups | None = None, trigger_interval: str | None = WINDOW,
                  available_now: bool = False, max_files_per_trigger: int | None = None,
                  decoded_shards: int | None = None, error_shards: int | None = None, compact_every: int | None = None,
                  horizon: str = Q.HORIZON) -> StreamingQuery:
    """Decode a stream into live and error outputs, batch by batch.

    `source` is a glob of landed log files, or a stream of queue messages
    (message_id, publish_time, data, attributes), which are deduplicated within
    the watermark horizon and gunzipped. The receive time (file time or publish
    time) becomes `submission_timestamp`. `compact_every`: pack the small files
    of both outputs after every so many batches.
    """
    if isinstance(source, str):
        lines = SRC.read_logs(spark, source, streaming=True, max_files_per_trigger=max_files_per_trigger)
    else:
        lines = Q.read_messages(source, horizon)
    tables = lookups or prepare(S.registry(spark))
    name = stream_name(checkpoint_location)

    def each(batch: DataFrame, batch_id: int) -> None:
        routed = decode_pipeline(batch, tables, received_col="received")
        LV.write_routed(routed, f"{out_base}/decoded", f"{out_base}/error", batch=(name, batch_id),
                        decoded_shards=decoded_shards, error_shards=error_shards)
        if compact_every and (batch_id + 1) % compact_every == 0:
            LV.compact(spark, f"{out_base}/decoded", f"{out_base}/error")

    w = lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_interval:
        w = w.trigger(processingTime=trigger_interval)
    return w.start()


def count_windows(rows: DataFrame, time_col: str = "submission_timestamp", window: str = WINDOW, delay: str = "10 minutes") -> DataFrame:
    """Rows per destination and tumbling window (streaming: with a
    watermark, so windows close)."""
    x = rows.withWatermark(time_col, delay) if rows.isStreaming else rows
    w = F.window(time_col, window)
    return x.groupBy(w.alias("w"), "destination").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "destination", "n")
