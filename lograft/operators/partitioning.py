"""Partition-count guards for row-parallel work."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS = 100_000      # of a task: a row grows to a kilobyte or more of text on its way



def ensure_parallelism(df: DataFrame, min_partitions: int | None = None, rows: int = ROWS) -> DataFrame:
    """Spread a batch input over at least `min_partitions` (default: the
    session's default parallelism) and, if larger, over so many that none holds
    more than about `rows`, when its scan yields fewer.

    Per-row JSON and regex work is CPU bound; a single-row-group file would
    otherwise run in one task. Files say little about it: a split of 128 MB may
    hold millions of narrow rows, which a task that sorts or writes what they
    become would keep in memory. Rows are counted from the files' footers.
    Inputs of enough partitions are returned unchanged, and so are streams.
    """
    if df.isStreaming:
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    want = max(want, -(-df.count() // rows))
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
