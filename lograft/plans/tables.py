"""Reading the driver tables (whole tables, declared by name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.partitioning import ensure_parallelism
from ..session import prepare


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. `spread=True` for fact inputs of row-parallel work:
    see `ensure_parallelism`."""
    prepare(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df
