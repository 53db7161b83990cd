"""Container log output derived from `documents`: each whole text, with its
newlines turned into spaces, is written as 100-character fragments in
docker JSON lines (`log`, `stream`, `time`), the last fragment ending in a
newline. One file per document; fragment times 1 ms apart for even documents,
7 ns apart for odd ones. Every tenth document's file also holds a line that is
no record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times

PIECE = 100
CONTAINER_DIR = "/var/log/containers/"


def file_path_of(doc_id) -> F.Column:
    """`<pod>_<namespace>_<container>-<id>.log`, the kubelet file name form."""
    d = doc_id.cast("string")
    return F.concat(F.lit(CONTAINER_DIR), F.lit("pod-"), d, F.lit("_ns-"), (doc_id % 5).cast("string"),
                    F.lit("_app-"), d, F.lit("-"), F.md5(d), F.lit(".log"))


def documents_to_container_lines(docs: DataFrame) -> DataFrame:
    text = F.regexp_replace(F.col("text"), "\n", " ")
    n_pieces = F.greatest(F.ceil(F.length(text) / PIECE), F.lit(1)).cast("int")
    x = docs.select("doc_id", text.alias("_t"), n_pieces.alias("_k"))
    x = x.select("doc_id", "_t", "_k", F.posexplode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_i", "_j"))
    piece = F.substring(F.col("_t"), F.col("_i") * PIECE + 1, PIECE)
    log = F.when(F.col("_i") == F.col("_k") - 1, F.concat(piece, F.lit("\n"))).otherwise(piece)
    base = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    ns = F.col("_i").cast("bigint") * F.when(F.col("doc_id") % 2 == 0, F.lit(1_000_000)).otherwise(F.lit(7))
    t = F.timestamp_micros(F.unix_micros(base) + F.call_function("div", ns, F.lit(1000).cast("bigint")))
    text = F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lpad((ns % 1000).cast("string"), 3, "0"), F.lit("Z"))
    line = F.to_json(F.struct(log.alias("log"), F.lit("stdout").alias("stream"), text.alias("time")))
    out = x.select(file_path_of(F.col("doc_id")).alias("file_path"), line.alias("value"))
    odd = docs.filter("doc_id % 10 = 0").select(file_path_of(F.col("doc_id")).alias("file_path"),
                                                F.concat(F.lit("no record "), F.col("doc_id").cast("string")).alias("value"))
    return out.unionByName(odd)
