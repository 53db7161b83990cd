"""Lookup joins with a checked broadcast.

A lookup side is broadcast only after its bytes are measured; beyond the limit
the same join runs as a shuffle join, with AQE's skew handling splitting hot
keys on the big side. `prepare_lookup` measures once for many joins (streaming
batches).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _bytes(fld: T.StructField) -> Column:
    """Bytes of a value in memory, an upper estimate: text and binary as long as
    they are, nested values as twice their JSON text."""
    c, t = F.col(f"`{fld.name}`"), fld.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 24
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2 + 64
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    row = F.lit(16).cast("bigint")
    for fld in df.schema.fields:
        row = row + _bytes(fld)
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


@dataclass(frozen=True)
class Lookup:
    """A lookup side and whether its measured size allows a broadcast."""

    df: DataFrame
    small: bool

    @property
    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.small else self.df


def prepare_lookup(df: DataFrame | Lookup, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> Lookup:
    return df if isinstance(df, Lookup) else Lookup(df, measured_bytes(df) <= max_bytes)


def checked_broadcast(small: DataFrame | Lookup, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return `(side, broadcasted)`: the side hinted for broadcast when its
    measured size is within `max_bytes`, else unchanged (shuffle join)."""
    got = prepare_lookup(small, max_bytes)
    return got.side, got.small


def lookup_join(big: DataFrame, small: DataFrame | Lookup, on, how: str = "left",
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return big.join(checked_broadcast(small, max_bytes)[0], on, how)
