"""Landing intermediate data as files in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def land(df: DataFrame, name: str = "landed", fmt: str = "parquet") -> DataFrame:
    """Write `df` to a fresh folder under `spark.checkpoint.dir` and read it
    back: the lineage is cut at a durable table (survives executor loss) and
    downstream filters cannot inline the producing expressions."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    out = spark.read.format(fmt).load(path)
    out._landed = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the folder of a landed DataFrame that nothing reads any more."""
    remove(df.sparkSession, df._landed)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a landed folder once nothing reads it any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
