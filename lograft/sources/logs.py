"""Reading log lines from files.

Batch: `spark.read.text` over a glob, each line with its file path from the
`_metadata` column. Streaming: the same with `readStream`; the file source
takes each *file* once, so this is for rotated or landed files (`sources.growing`
follows appends), and offsets live in the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.store import Store

# Agent defaults of the tail input.
MAX_LINE_BYTES = 10240 * 1024
# End of fixed values.


def read_logs(spark: SparkSession, path_glob: str, *, streaming: bool = False,
              max_files_per_trigger: int | None = None) -> DataFrame:
    """`(value, file_path, received)` for every line of the matching files;
    a line is received when its file was last written."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path_glob)
    else:
        df = spark.read.format("text").load(path_glob)
    return df.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("received"))


def drop_long_lines(df: DataFrame, max_bytes: int = MAX_LINE_BYTES, col: str = "value") -> DataFrame:
    """Skip lines longer than `max_bytes` (UTF-8 bytes)."""
    return df.filter(F.octet_length(F.col(col)) <= max_bytes)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The raw log table, in a Spark format or, as "committed", of a store."""
    if fmt == "committed":
        store, table = Store.of_table(spark, path)
        return store.read(table)
    return spark.read.format(fmt).load(path)


def read_decoder_input(spark: SparkSession, path: str, start_date: str | None = None,
                       end_date: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The decoder input table, optionally a day range (partition column
    `date` when the table is day-partitioned, else the timestamp)."""
    df = read_table(spark, path, fmt)
    if start_date or end_date:
        day = F.col("date") if "date" in df.columns else F.to_date("submission_timestamp")
        if start_date:
            df = df.filter(day >= F.lit(start_date).cast("date"))
        if end_date:
            df = df.filter(day <= F.lit(end_date).cast("date"))
    return df
