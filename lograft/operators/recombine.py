"""Rejoin messages split over several container log lines.

Rule: a message ends at a fragment whose text ends with a newline; the
fragments before it (same file, in order) belong to it. A file's trailing
fragments without a newline form one unterminated message.

Order is a bigint in nanoseconds (or any unit); fragments that tie are ordered
by `tie_cols`, then by text. Lines without an order value (their time did not
parse) cannot take part: each is passed on as a message of its own.

To keep one very large file from landing in one task, the order axis is cut
into chunks. Inside a chunk, fragments are numbered and the terminators before
each one counted, in one order (linear). Fragments whose message ends in a later
chunk take the first message of the next chunk with a terminator from a table of
one row per chunk, which is an aggregate of its own: land what is dear to parse.
Concatenation runs per (message, chunk, run of MAX_PARTS fragments), then joins
runs up to MAX_BYTES: a file that never ends a line comes out as several pieces
(`piece` 0, 1, ...), with every fragment in one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PARTS = 10_000
MAX_BYTES = 64 << 20


def _order_as_long(df: DataFrame, order_col: str):
    dt = df.schema[order_col].dataType
    c = F.col(order_col)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("bigint")


def _with_end(df: DataFrame, file_col: str, order_col: str, text_col: str, tie_cols, chunk_width: int, *keep: str) -> DataFrame:
    """Ordered fragments with `_pos` in their chunk and `_end`, the chunk in which
    their message ends and its number there (NULL: unterminated)."""
    x = df.select(F.col(file_col).alias("_file"), F.col(order_col).alias("_order"), _order_as_long(df, order_col).alias("_n"),
                  F.col(text_col).alias("_text"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_cols)], *keep).filter("_n is not null")
    x = x.withColumn("_chunk", F.floor(F.col("_n") / F.lit(chunk_width)))
    order = ["_n", *[f"_tie{i}" for i in range(len(tie_cols))], "_text"]
    part = Window.partitionBy("_file", "_chunk")
    is_end = F.coalesce(F.col("_text").endswith("\n"), F.lit(False)).cast("int")
    # a message is named by how many terminators of its chunk come before it, so the first one is 0
    # in every chunk, and chunks are summed up without their windows
    chunks = x.groupBy("_file", "_chunk").agg(F.max(is_end).alias("_ends"))
    later = Window.partitionBy("_file").orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_file", "_chunk", F.last(F.when(F.col("_ends") == 1, F.col("_chunk")), ignorenulls=True).over(later).alias("_next")) \
        .filter("_next is not null").select("_file", "_chunk", F.struct(F.col("_next").alias("c"), F.lit(0).cast("bigint").alias("p")).alias("_later"))
    before = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumns({"_pos": F.row_number().over(part.orderBy(*order)), "_before": F.coalesce(F.sum(is_end).over(before), F.lit(0).cast("bigint")),
                       "_all": F.sum(is_end).over(part)})
    here = F.when(F.col("_before") < F.col("_all"), F.struct(F.col("_chunk").alias("c"), F.col("_before").alias("p")))
    return x.join(chunks, ["_file", "_chunk"], "left").withColumn("_end", F.coalesce(here, "_later"))


def recombine_lines(df: DataFrame, file_col: str, order_col: str, text_col: str = "log", chunk_width: int = 60_000_000_000,
                    tie_cols=(), max_parts: int = MAX_PARTS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """-> (file, first_order, message, parts, piece). `chunk_width` is in order
    units (60 s of nanoseconds). NULL text counts as empty."""
    x = _with_end(df, file_col, order_col, text_col, tie_cols, chunk_width)
    pieces = (x.withColumn("_run", F.floor((F.col("_pos") - 1) / max_parts))
              .groupBy("_file", "_end", "_chunk", "_run")
              .agg(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("_text", F.lit("")).alias("t")))).alias("_p"),
                   F.min(F.struct("_pos", "_order")).getField("_order").alias("_first"))
              .select("_file", "_end", "_chunk", "_run", "_first", F.size("_p").alias("_cnt"),
                      F.array_join(F.transform("_p", lambda p: p.getField("t")), "").alias("_piece")))
    whole = Window.partitionBy("_file", "_end").orderBy("_chunk", "_run").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("_piece").cast("bigint")).over(whole), F.lit(0))
    msgs = (pieces.withColumn("_bin", F.floor(before / max_bytes).cast("int"))
            .groupBy("_file", "_end", "_bin")
            .agg(F.array_sort(F.collect_list(F.struct("_chunk", "_run", "_piece"))).alias("_ps"),
                 F.min(F.struct("_chunk", "_run", "_first")).getField("_first").alias("first_order"),
                 F.sum("_cnt").alias("parts")))
    out = msgs.select(F.col("_file").alias(file_col), "first_order",
                      F.array_join(F.transform("_ps", lambda p: p.getField("_piece")), "").alias("message"),
                      F.col("parts").cast("int").alias("parts"), F.col("_bin").alias("piece"))
    return out.unionByName(unordered_lines(df, file_col, order_col, text_col))


def unordered_lines(df: DataFrame, file_col: str, order_col: str, text_col: str = "log") -> DataFrame:
    """Lines whose order value is NULL, each a message of its own."""
    x = df.filter(_order_as_long(df, order_col).isNull())
    return x.select(F.col(file_col), F.lit(None).cast(df.schema[order_col].dataType).alias("first_order"),
                    F.col(text_col).alias("message"), F.lit(1).alias("parts"), F.lit(0).alias("piece"))


def unterminated(df: DataFrame, file_col: str, order_col: str, text_col: str = "log", chunk_width: int = 60_000_000_000) -> DataFrame:
    """Rows of `df` after the last terminator of their file."""
    rest = [c for c in df.columns if c not in (file_col, order_col, text_col)]
    x = _with_end(df, file_col, order_col, text_col, (), chunk_width, *rest).filter("_end is null")
    return x.select(F.col("_file").alias(file_col), F.col("_order").alias(order_col), F.col("_text").alias(text_col), *rest)
