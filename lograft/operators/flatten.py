"""Metrics map -> columns (P10, P11) and events array -> rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric(metrics_col, metric_type: str, name: str) -> Column:
    """P10: lookup by dotted name; dots stay part of the key."""
    m = F.col(metrics_col) if isinstance(metrics_col, str) else metrics_col
    return m[metric_type][name]


def flat_name(name: str) -> str:
    return name.replace(".", "_").replace("-", "_")


def flatten_metrics(df: DataFrame, wanted: dict[str, list[str]], metrics_col: str = "metrics",
                    prefix: str = "") -> DataFrame:
    """One column per requested `(type, dotted name)`. Dotted names can
    collide once flattened (`a.b_c` / `a.b.c`): that raises instead of
    silently keeping one of them."""
    seen: dict[str, str] = {}
    cols = []
    for mtype, names in wanted.items():
        for name in names:
            col_name = prefix + flat_name(name)
            if col_name in seen or col_name in df.columns:
                raise ValueError(f"metric {mtype}/{name} flattens to {col_name!r}, "
                                 f"already used by {seen.get(col_name, 'an input column')}")
            seen[col_name] = f"{mtype}/{name}"
            cols.append(metric(metrics_col, mtype, name).alias(col_name))
    return df.select("*", *cols)


def explode_events(df: DataFrame, events_col: str = "events", extras: tuple = ()) -> DataFrame:
    """One row per event; a ping with no events (`[]` or missing) keeps
    one row with NULL event columns. Named extras become columns."""
    e = F.col("_event")
    out = df.withColumn("_event", F.explode_outer(events_col)).drop(events_col)
    return out.select(
        "*",
        e.getField("category").alias("event_category"),
        e.getField("name").alias("event_name"),
        e.getField("timestamp").alias("event_timestamp"),
        *[e.getField("extra")[k].alias(k) for k in extras],
    ).drop("_event")
