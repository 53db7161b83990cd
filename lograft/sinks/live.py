"""Live (per document type) tables and the error table.

Decoded rows go to one table partitioned by `date` and `destination` (one live
table per document type, day partitions, clustered by `submission_timestamp`
inside files); error rows go to the 45-column error table partitioned by `date`.
Routing is evaluated once for the two writes: the routed rows are landed as a
table under `spark.checkpoint.dir` (durable, survives executor loss), by the
pipeline or else here, and removed after both writes.

Both tables belong to one store (`sinks.store`) and become visible in one commit.
A write that fails leaves the old contents, and its landed input for another try;
a streaming batch, named by stream and number, is committed once however often it
is replayed.

Rows are rebalanced on the partition columns before a write, so a day of a
destination is one file or, if large, several of AQE's size; `compact` packs the
files of many small batches. A row without any time gets the day of the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import decode as D
from ..session import scratch_path
from .files import remove
from .store import TARGET, Store

# Output shards of a decoder that writes a fixed number of files.
DECODED_SHARDS = 200
ERROR_SHARDS = 60
# End of fixed values.
LIVE_PARTS, ERROR_PARTS, TIME = ["date", "destination"], ["date"], "submission_timestamp"


def with_day(df: DataFrame, ts_col: str = "submission_timestamp") -> DataFrame:
    """The day a row is stored under; a row without a time: today."""
    return df.withColumn("date", F.date_format(F.coalesce(F.to_date(F.col(ts_col)), F.current_date()), "yyyy-MM-dd"))


def shard(df: DataFrame, n: int | None, *cols: str) -> DataFrame:
    """A fixed number of output shards; None: rebalanced on `cols`."""
    if n:
        return df.repartition(n)
    return df.hint("rebalance", *cols) if cols else df


def write_routed(routed: DataFrame, decoded_path: str, error_path: str, *,
                 decoded_shards: int | None = None, error_shards: int | None = None,
                 batch: tuple[str, int] | None = None) -> None:
    """V4 + K5 + K6 + K8: both outputs of one routing pass, in one commit.
    `batch` names a streaming batch (stream, number), which is written once."""
    spark = routed.sparkSession
    (store, decoded), (other, error) = Store.of_table(spark, decoded_path), Store.of_table(spark, error_path)
    if store.base != other.base:
        raise ValueError("both outputs must be tables of one store (folders beside each other)")
    if not (batch and store.done(*batch)):
        # landed already, and each row is in one of the outputs: what was made of it since is computed once
        path = None if hasattr(routed, "_made_from") else scratch_path(spark, "routed")
        if path:
            # good rows leave without their source text, error rows keep theirs in `raw`
            source = F.when(F.col("error_type").isNotNull(), F.col("raw"))
            routed.withColumn("raw", source).drop("payload").write.parquet(path)
        try:
            rows = spark.read.parquet(path) if path else routed
            dec, err = with_day(D.decoded(rows)), with_day(D.errors(rows))
            dec = shard(dec, decoded_shards, *LIVE_PARTS).sortWithinPartitions(*LIVE_PARTS, TIME)
            err = shard(err, error_shards, *ERROR_PARTS).sortWithinPartitions(*ERROR_PARTS, TIME)
            store.put({decoded: (dec, LIVE_PARTS), error: (err, ERROR_PARTS)}, stream=batch)
        finally:
            if path:
                remove(spark, path)
    for made in getattr(routed, "_made_from", []):      # a failed write keeps its input
        remove(spark, made._landed)


def read_live(spark: SparkSession, path: str, destination: str | None = None, day: str | None = None) -> DataFrame:
    """K2 + F6: `SELECT *` of a live table, with day equality on the partition
    column; files of other days and destinations are not even listed."""
    store, table = Store.of_table(spark, path)
    parts = {k: v for k, v in (("date", day), ("destination", destination)) if v is not None}
    df = store.read(table, **parts)
    if day is not None:
        df = df.filter(F.col("date") == day)
    if destination is not None:
        df = df.filter(F.col("destination") == destination)
    return df.withColumn("date", F.col("date").cast("date"))


def read_errors(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """K8: the error table with its declared schema (`date` is a string)."""
    store, table = Store.of_table(spark, path)
    df = store.read(table, **({"date": day} if day is not None else {}))
    if day is not None:
        df = df.filter(F.col("date") == day)
    return df.select(*S.ERROR_COLUMNS)


def compact(spark: SparkSession, *paths: str, target: int = TARGET, day: str | None = None) -> int:
    """K5: pack the small files of live and error tables (of a day) to `target`
    bytes, ordered by time; the number of files replaced."""
    n = 0
    for path in paths:
        store, table = Store.of_table(spark, path)
        n += store.compact(table, TIME, target, **({"date": day} if day is not None else {}))
    return n


def create_table_like(spark: SparkSession, like: DataFrame, path: str) -> DataFrame:
    """K4: an empty table with the schema of another."""
    replace_table(spark.createDataFrame([], like.schema), path)
    return read_table(spark, path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K3: create or replace a table from a query. The new contents are there
    with the commit; until then, and if the write fails, the old ones are."""
    store, table = Store.of_table(df.sparkSession, path)
    store.put({table: (df, partition_by or [])}, replace=True)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K5: add rows to a table."""
    store, table = Store.of_table(df.sparkSession, path)
    store.put({table: (df, partition_by or [])})


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of a table."""
    store, table = Store.of_table(spark, path)
    return store.read(table)


def json_records(df: DataFrame) -> DataFrame:
    """K7: every row as one JSON record (`value`), for a topic or files."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_lines(df: DataFrame, path: str, col: str = "value") -> None:
    """K9: text lines out."""
    df.select(col).write.mode("overwrite").text(path)
